"""The registered queries against their SQL, and the pipeline's stages against their rules."""

import os
import re
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from check_oracle import digest  # noqa: E402
from strata.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(columns) == sorted(df.columns) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(columns, want)[0]


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert set(queries.QUERIES) <= names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_columns_of_the_queries(spark):
    want = {
        "op1_": ["doc_id", "held_out", "score", "predicted"],
        "op3_": ["page_id", "url", "text", "n_chars"],
        "op4_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        "op8_": ["doc_id", "size", "source_size", "target", "taken"],
        "op11_": ["doc_id", "n_words", "n_removed", "kept_sha256"],
        "op12_": ["word", "form", "root", "n", "n_near", "form_n"],
        "op13_": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
        "op10_": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    }
    for start, columns in want.items():
        name = next(n for n in queries.QUERIES if n.startswith(start))
        assert queries.QUERIES[name](spark, SF).columns == columns


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "MinHash near-dedup", "mixing sources", "best-fit packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"file://{tmp_path}/{k}"
        stage(spark, tables[-1], SF).write.parquet(path)
        tables.append(spark.read.parquet(path))
    start, good, exact, near, mixed, packed = tables
    assert all(t.dtypes == start.dtypes for t in (good, exact, near, mixed))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert sum(d in kept for d, q in labels.items() if q == 1) >= 0.95 * sum(labels.values())
    assert not any(d in kept for d, q in labels.items() if q == 0)
    squeezed = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    texts = {squeezed(r.text) for r in good.collect()}
    assert exact.count() == len(texts) and {squeezed(r.text) for r in exact.collect()} == texts
    from test_near import brute_near
    rows = [(r.doc_id, r.text) for r in exact.collect()]
    assert {r.doc_id for r in near.collect()} == {d for d, (_, _, keep) in brute_near(rows, 5, 80).items() if keep}
    words = lambda t: sum(len(WORD.findall(r.text or "")) for r in t.collect())
    assert abs(words(mixed) - words(near)) <= 0.02 * words(near) + 500
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in mixed.collect()}
    assert packed.filter("piece = 0").count() == mixed.count()
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_stages_decide_on_rows_of_null_and_repeated_ids(spark, make_docs):
    from pyspark.sql import functions as F

    import corpus_pipeline
    from strata.llm import minhash_bayes
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marked = docs.join(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality"), "doc_id")
    good = corpus_pipeline.quality(spark, docs, SF).select("doc_id")
    clean = marked.filter("quality = 1").join(good, "doc_id", "left_semi").drop("quality").limit(6)
    bad = marked.filter("quality = 0").join(good, "doc_id", "left_anti").drop("quality").limit(2)
    for shared in (None, -7):
        rows = clean.unionByName(bad).withColumn("doc_id", F.lit(shared).cast("long")).select(docs.columns)
        left = sorted(r.text for r in corpus_pipeline.quality(spark, docs.unionByName(rows), SF)
                      .filter(F.col("doc_id").eqNullSafe(F.lit(shared).cast("long"))).collect())
        assert left == sorted(r.text for r in clean.collect())

    a, b, c, d = ("".join(f"{k}{i} " for i in range(60)) for k in "abcd")
    rows = [(None, a), (None, a + "end"), (None, b), (3, b), (None, c), (None, c), (5, d), (5, d), (5, d + "end"), (5, "other words"),
            (None, ""), (None, ""), (6, None)]
    got = [(r.doc_id, r.text) for r in minhash_bayes.deduplicate(make_docs(*rows)).collect()]
    count = lambda *texts: [i for i, t in got if t in texts]
    assert count(a, a + "end") == [None] and count(b) == [3] and count(c) == [None] and count(d, d + "end") == [5]
    assert count("other words") == [5] and count("") == [None, None] and count(None) == [6] and len(got) == 8


CLASHES = ("_id", "_text", "_sha", "_rejected", "id", "row", "i", "s", "z", "node", "size", "key", "place", "uid", "label", "quality", "n", "a.b", "score")


def odd_documents(spark):
    """Clean, repeated, null, empty and very long rows with columns of the operators' own names."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = " ".join(r.text for r in docs.filter("length(text) > 400").orderBy("doc_id").limit(60).collect())
    rows = docs.limit(40).unionByName(docs.limit(5))
    rows = rows.unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    rows = rows.unionByName(docs.limit(2).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 5000))
    rows = rows.unionByName(docs.limit(1).withColumn("text", F.lit(long * 12)).withColumn("doc_id", F.lit(7000).cast("long")))
    rows = rows.unionByName(docs.limit(2).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 8000))
    rows = rows.unionByName(docs.limit(2).withColumn("text", F.lit("")).withColumn("doc_id", F.col("doc_id") + 9000))
    for name in CLASHES:
        rows = rows.withColumn(name, F.lit("clash"))
    return rows.withColumn("when", F.current_timestamp()).withColumn("list", F.array(F.lit(1), F.lit(2)))


def test_stages_carry_odd_rows_and_columns(spark, tmp_path):
    import corpus_pipeline
    docs = odd_documents(spark)
    docs.write.parquet(f"file://{tmp_path}/in")
    docs = start = spark.read.parquet(f"file://{tmp_path}/in")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"file://{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"file://{tmp_path}/{k}")
        assert 0 < docs.count()
        if k < 4:
            assert docs.dtypes == start.dtypes, name
            assert docs.filter("`a.b` <> 'clash' or size(list) <> 2").count() == 0
        if k < 3:
            assert docs.exceptAll(before).count() == 0, name  # rows of the stage before, none made anew
    assert max(r.length for r in docs.collect()) <= 4096


def test_stages_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline
    docs = start = odd_documents(spark).limit(0)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        assert docs.count() == 0 and (k == 4 or docs.dtypes == start.dtypes), name


def test_null_ids_cost_what_ids_cost(spark):
    import time

    from pyspark.sql import functions as F

    from strata.llm import minhash_bayes
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[(i * 7 + j * j * (i % 13 + 1)) % 400] for j in range(60))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    took = []
    for df in (docs, docs, docs.withColumn("doc_id", F.lit(None).cast("long"))):
        start = time.time()
        got = minhash_bayes.near_duplicates(df, shingle_words=5).collect()
        took.append(time.time() - start)
        assert len(got) == 1500
    assert took[2] <= 2 * took[1] + 5
