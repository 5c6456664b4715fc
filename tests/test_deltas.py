"""Merge on read: loads as deltas, the latest row of each key, compaction."""

import os
import random

from strata.operators import deltas, tables
from strata.session import local_path
from pyspark.sql import types as T

KEYS = ["k", "j"]
SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("j", T.IntegerType()), T.StructField("v", T.IntegerType()),
                       T.StructField("day", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def read(spark, path):
    return sorted((tuple(r) for r in deltas.read_merged(spark, path, SCHEMA, KEYS, "day").collect()), key=str)


def files_below(path):
    found = []
    for folder, _, names in os.walk(local_path(path)):
        found += [os.path.join(folder, n) for n in names if n.endswith(".parquet")]
    return set(found)


def test_loads_in_any_mixture_equal_a_dictionary(spark, workdir):
    rng, want = random.Random(4), {}
    for seq in range(1, 9):
        rows = {}
        for _ in range(rng.randrange(0, 25)):
            k, j = rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None])
            rows[(k, j)] = (k, j, rng.randrange(1000), None if j is None else f"d{j}")
        deltas.append_delta(spark, workdir, frame(spark, list(rows.values())), "day", seq)
        want.update(rows)
        assert read(spark, workdir) == sorted(want.values(), key=str)
        if seq in (1, 4, 5):
            deltas.compact(spark, workdir, SCHEMA, KEYS, "day")
            assert deltas.delta_numbers(spark, workdir) == [] and read(spark, workdir) == sorted(want.values(), key=str)


def test_a_late_row_writes_one_row_and_reads_none(spark, workdir):
    rows = [(f"k{i}", i % 5, i, f"d{i % 5}") for i in range(500)]
    deltas.append_delta(spark, workdir, frame(spark, rows), "day", 1)
    deltas.compact(spark, workdir, SCHEMA, KEYS, "day")
    before = files_below(workdir)
    deltas.append_delta(spark, workdir, frame(spark, [("k7", 2, -1, "d2")]), "day", 2)
    written = files_below(workdir) - before
    assert before <= files_below(workdir) and len(written) == 1
    assert spark.read.parquet("file://" + written.pop()).count() == 1
    assert [r for r in read(spark, workdir) if r[0] == "k7"] == [("k7", 2, -1, "d2")] and len(read(spark, workdir)) == 500
    # compaction rewrites that day only
    deltas.compact(spark, workdir, SCHEMA, KEYS, "day")
    after = files_below(workdir)
    assert {f for f in before if "day=d2" not in f} <= after and not any("day=d2" in f for f in before & after)
    assert len(read(spark, workdir)) == 500


def test_a_repeated_load_replaces_itself_and_a_late_one_of_a_lower_number_loses(spark, workdir):
    deltas.append_delta(spark, workdir, frame(spark, [("a", 1, 1, "d1"), ("b", 1, 1, "d1")]), "day", 5)
    deltas.append_delta(spark, workdir, frame(spark, [("a", 1, 2, "d1")]), "day", 5)
    deltas.append_delta(spark, workdir, frame(spark, [("a", 1, 9, "d1"), ("c", 2, 9, "d2")]), "day", 3)
    assert read(spark, workdir) == [("a", 1, 2, "d1"), ("c", 2, 9, "d2")]


def test_a_crash_between_the_steps_of_a_compaction_loses_nothing(spark, workdir, monkeypatch):
    deltas.append_delta(spark, workdir, frame(spark, [("a", 1, 1, "d1"), ("b", 2, 1, "d2")]), "day", 1)
    deltas.compact(spark, workdir, SCHEMA, KEYS, "day")
    deltas.append_delta(spark, workdir, frame(spark, [("a", 1, 2, "d1")]), "day", 2)
    with monkeypatch.context() as m:
        m.setattr(tables, "delete_path", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        try:
            deltas.compact(spark, workdir, SCHEMA, KEYS, "day")
        except OSError:
            pass
    assert deltas.delta_numbers(spark, workdir) == [2]
    want = [("a", 1, 2, "d1"), ("b", 2, 1, "d2")]
    assert read(spark, workdir) == want
    deltas.compact(spark, workdir, SCHEMA, KEYS, "day")
    assert read(spark, workdir) == want and deltas.delta_numbers(spark, workdir) == []


def test_empty_tables_and_loads(spark, workdir):
    assert read(spark, workdir) == []
    assert deltas.compact(spark, workdir, SCHEMA, KEYS, "day") == []
    deltas.append_delta(spark, workdir, frame(spark, []), "day", 1)
    assert read(spark, workdir) == []
    deltas.compact(spark, workdir, SCHEMA, KEYS, "day")
    assert read(spark, workdir) == []


def test_untouched_partitions_are_not_joined(spark, workdir):
    rows = [(f"k{i}", i % 3, i, f"d{i % 3}") for i in range(30)]
    deltas.append_delta(spark, workdir, frame(spark, rows), "day", 1)
    deltas.compact(spark, workdir, SCHEMA, KEYS, "day")
    assert "Join" not in deltas.read_merged(spark, workdir, SCHEMA, KEYS, "day")._jdf.queryExecution().optimizedPlan().toString()
    deltas.append_delta(spark, workdir, frame(spark, [("k1", 1, 0, "d1")]), "day", 2)
    plan = deltas.read_merged(spark, workdir, SCHEMA, KEYS, "day")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "PartitionFilters" in plan and "IN (d1)" in plan.replace("day#", "").replace("= d1", "IN (d1)")
