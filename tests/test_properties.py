"""Property tests: operators against brute-force Python on random small frames
with NULLs and duplicates."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.clean import dedup
from strata.operators.joins import anti_join
from strata.operators.ordinal import ordinal

SCHEMA = "a string, b int, v int"
rows_st = st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, None]),
                             st.integers(0, 3)), min_size=0, max_size=25)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def key(r):
    return tuple((0, 0) if x is None else (1, x) for x in r)


@SETTINGS
@given(rows=rows_st)
def test_dedup_matches_brute_force(spark, rows):
    got = sorted(key(tuple(r)) for r in dedup(spark.createDataFrame(rows, SCHEMA), keys=["a", "b"]).collect())
    best = {}
    for r in rows:
        k = (r[0], r[1])
        best[k] = min(best.get(k, r), r, key=lambda x: (-1 if x[2] is None else x[2]))
    assert got == sorted(key(r) for r in best.values())


@SETTINGS
@given(rows=rows_st)
def test_ordinal_matches_brute_force(spark, rows):
    got = Counter(key(tuple(r)) for r in ordinal(spark.createDataFrame(rows, SCHEMA), ["a", "b"], ["v"]).collect())
    want = Counter()
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[1]), []).append(r)
    for g in groups.values():
        for i, r in enumerate(sorted(g, key=lambda x: x[2]), start=1):
            want[key(r + (i,))] += 1
    assert got == want


@SETTINGS
@given(left=rows_st, right=rows_st)
def test_anti_join_matches_brute_force(spark, left, right):
    lk = spark.createDataFrame(left, SCHEMA)
    rk = spark.createDataFrame(right, SCHEMA)
    got = Counter(key(tuple(r)) for r in anti_join(lk, rk, ["a", "b"]).collect())
    rkeys = {(r[0], r[1]) for r in right if r[0] is not None and r[1] is not None}
    want = Counter(key(r) for r in left if r[0] is None or r[1] is None or (r[0], r[1]) not in rkeys)
    assert got == want


batch_st = st.dictionaries(
    st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, 3])),
    st.integers(0, 9), max_size=6)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(b1=batch_st, b2=batch_st)
def test_upsert_matches_dictionary_merge(spark, b1, b2):
    import datetime as dt
    from strata.operators import tables
    from strata.session import work_path
    path = work_path(spark, "prop-upsert")
    day = lambda t: dt.date(2024, 1, t)   # noqa: E731  (partition derived from a key part)
    merged = {}
    for batch in (b1, b2):
        rows = [(k[0], k[1], v, day(k[1])) for k, v in batch.items()]
        tables.upsert(spark, path, spark.createDataFrame(rows, "a string, t int, v int, d date"), ["a", "t"], "d")
        merged.update(batch)
    stored = tables.read_table(spark, path, spark.createDataFrame([], "a string, t int, v int, d date").schema)
    got = sorted(key((r.a, r.t, r.v)) for r in stored.collect())
    assert got == sorted(key((k[0], k[1], v)) for k, v in merged.items())


loads_st = st.lists(st.tuples(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 9)), max_size=6),
                              st.lists(st.integers(1, 4), max_size=3)), min_size=1, max_size=3)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(loads=loads_st)
def test_replace_partitions_matches_day_model(spark, loads):
    """Each load replaces the days it writes plus the days it owns (owned days
    it has no rows for are emptied); other days are untouched."""
    import datetime as dt
    from strata.operators import tables
    from strata.session import work_path
    path = work_path(spark, "prop-replace")
    schema = "v int, d date"
    model: dict[int, list[int]] = {}
    for rows, owned in loads:
        df = spark.createDataFrame([(v, dt.date(2024, 1, d)) for d, v in rows], schema)
        tables.replace_partitions(spark, path, df, "d", owned=[dt.date(2024, 1, d) for d in owned])
        new: dict[int, list[int]] = {}
        for d, v in rows:
            new.setdefault(d, []).append(v)
        for d in set(owned) | set(new):
            model[d] = new.get(d, [])
    stored = tables.read_table(spark, path, spark.createDataFrame([], schema).schema) \
        if tables.table_exists(spark, path) else None
    got = sorted((r.d.day, r.v) for r in stored.collect()) if stored is not None else []
    assert got == sorted((d, v) for d, vs in model.items() for v in vs)
