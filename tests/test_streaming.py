"""Structured Streaming: incremental pick-up of newly published Bronze days
with a checkpoint, and watermark dedup equal to the batch dedup."""

from pyspark.sql import functions as F

from strata import catalog
from strata.operators.clean import dedup, clean, parse
from strata.plans import daily
from strata.sources import bronze as bronze_src
from strata.streaming import silver_stream

SF = "/root/testdata/sf0.001"


def test_stream_picks_up_only_new_days(spark, workdir):
    L = catalog.Layers(spark, SF)
    P = daily.Paths(workdir)
    bronze_src.stage_by_day(L.raw.withColumn("file_year", F.lit("2024")), P.staging)
    schema = bronze_src.staged_schema(L.raw.schema)
    days = bronze_src.staged_days(spark, P.staging)
    first, second = days[:15], days[15:]
    for d in first:
        bronze_src.publish_day(spark, P.staging, P.bronze, d, schema)
    def files(ds):
        import glob
        from strata.session import local_path
        return sum(len(glob.glob(local_path(P.bronze) + f"/year={d[:4]}/month={d[5:7]}/day={d[8:10]}/*.parquet"))
                   for d in ds)

    def data_batches(q):
        # numInputRows counts every action on the micro-batch (quarantine and
        # Silver jobs), so count batches that read data instead
        return sum(1 for p in q.recentProgress if p["numInputRows"] > 0)

    q1 = silver_stream.stream_silver(spark, P.bronze, P, L.crm, schema, P.ckpt, max_files_per_trigger=5,
                                     timeout_s=600)
    for d in second:
        bronze_src.publish_day(spark, P.staging, P.bronze, d, schema)
    q2 = silver_stream.stream_silver(spark, P.bronze, P, L.crm, schema, P.ckpt, max_files_per_trigger=5,
                                     timeout_s=600)
    assert data_batches(q1) == -(-files(first) // 5)
    assert data_batches(q2) == -(-files(second) // 5)      # only the new days were read
    got = sorted(tuple(r) for r in daily.read_silver(spark, P).collect())
    want = sorted(tuple(r) for r in L.silver.select(*daily.read_silver(spark, P).columns).collect())
    assert got == want


def test_stream_dedup_equals_batch_dedup(spark, workdir):
    L = catalog.Layers(spark, SF)
    P = daily.Paths(workdir)
    bronze_src.stage_by_day(L.raw.withColumn("file_year", F.lit("2024")), P.staging)
    schema = bronze_src.staged_schema(L.raw.schema)
    # day files of several tasks: later batches bring earlier events
    (spark.read.schema(schema).parquet(P.staging).repartition(4, F.xxhash64("event_id")).write
     .partitionBy(*bronze_src.PARTS).parquet(P.bronze))
    silver_stream.stream_dedup(spark, P.bronze, P.dedup, schema, P.ckpt, max_files_per_trigger=40, timeout_s=600)
    got = spark.read.parquet(P.dedup)
    raw = spark.read.schema(schema).parquet(P.staging).drop("year", "month", "day")
    want = dedup(clean(parse(raw)), order_by=["event_id"])
    cols = sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())


def test_stream_quarantine_keeps_a_day_of_many_batches(spark, workdir):
    L = catalog.Layers(spark, SF)
    P = daily.Paths(workdir)
    schema = bronze_src.staged_schema(L.raw.schema)
    rows = bronze_src.staged(L.raw.withColumn("file_year", F.lit("2024")))
    rows.repartition(3, F.xxhash64("event_id")).write.partitionBy(*bronze_src.PARTS).parquet(P.bronze)
    silver_stream.stream_silver(spark, P.bronze, P, L.crm, schema, P.ckpt, max_files_per_trigger=25, timeout_s=600)
    from strata.plans import silver as silver_plan
    want = silver_plan.quarantined(rows.drop(*bronze_src.PARTS)).count()
    stored = spark.read.parquet(P.quarantine_stream)
    assert stored.count() == want > 10 and stored.select("batch_id").distinct().count() > 1
    # a replayed batch replaces its own rows
    last = stored.selectExpr("max(batch_id)").first()[0]
    batch = rows.where("event_id % 97 = 0")
    for _ in range(2):
        daily.bronze_to_silver(spark, P, L.crm, batch, observe=False, batch_id=last + 1)
    more = silver_plan.quarantined(batch.drop(*bronze_src.PARTS)).count()
    assert spark.read.parquet(P.quarantine_stream).count() == want + more
