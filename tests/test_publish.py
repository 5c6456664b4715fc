"""Write, audit, publish; contracts in the jobs; statements and ranges for a database."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata import catalog, jobs, schemas
from strata.operators import quality, tables
from strata.plans import checks, daily, gold, publish
from strata.sources import crm as crm_src
from strata.sources import jdbc

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def lake(spark, workdir):
    L = catalog.Layers(spark, SF)
    P = daily.Paths(workdir)
    tables.write_table(L.serving.drop("event_id").withColumn("event_date", F.to_date("event_time")), P.serving, "event_date")
    tables.write_table(schemas.enforced(L.crm, schemas.CRM, schemas.CRM_LENGTHS), P.crm)
    return P, tables.read_table(spark, P.crm), publish.GoldStore(spark, P.gold)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def serving_until(spark, P, day):
    return daily.read_serving(spark, P, with_id=False).where(F.col("event_date") <= F.lit(day).cast("date")).drop("event_date")


def test_a_failing_check_leaves_the_published_gold_readable(spark, lake):
    P, crm, store = lake
    assert store.current() is None and store.read("fact_sales").count() == 0
    first = jobs.publish_gold(spark, P, crm)
    before = {n: rows(store.read(n)) for n in publish.CONTRACTS}
    assert store.current() == first and len(before["fact_sales"]) > 50
    assert before["dim_users"] == rows(gold.dim_users(serving_until(spark, P, "2024-12-31")))
    broken = crm.withColumn("user_id", F.when(F.col("user_id") > 3, F.col("user_id")).otherwise(F.lit(3)))
    with pytest.raises(AssertionError):
        jobs.publish_gold(spark, P, broken)
    assert store.current() == first and store.versions() == [first]
    assert {n: rows(store.read(n)) for n in publish.CONTRACTS} == before
    # the draft that failed is removed, the published version isn't
    assert store.vacuum() != [] and {n: rows(store.read(n)) for n in publish.CONTRACTS} == before


def test_incremental_versions_equal_the_loads_in_place_and_share_old_days(spark, lake):
    P, crm, store = lake
    for last in ("2024-01-12", "2024-01-20", "2024-01-31"):
        serving = serving_until(spark, P, last)
        publish.build(store, serving, crm).publish()
        daily.fact_sales_incremental(spark, P.fact_sales, serving)
        daily.fact_cart_abandonment_incremental(spark, P.fact_carts, serving)
        assert rows(store.read("fact_sales")) == rows(daily.read_fact(spark, P.fact_sales, "sale_date"))
        assert rows(store.read("fact_cart_abandonment")) == rows(daily.read_fact(spark, P.fact_carts, "cart_date"))
    versions = store.versions()
    held = store.manifest(versions[-1])["fact_sales"]
    assert set(held.values()) == set(versions)  # days of every version
    assert max(d for d, v in held.items() if v != versions[-1]) < min(d for d, v in held.items() if v == versions[-1])
    # the days a version brought are all it wrote
    written = tables.list_partitions(spark, store.folder("fact_sales", versions[-1]), "sale_date")
    assert sorted(d for d, v in held.items() if v == versions[-1]) == written
    # older versions can be read until they are removed
    assert store.read("fact_sales", versions[0]).count() < store.read("fact_sales").count()
    now = rows(store.read("fact_sales"))
    store.vacuum(keep=1)
    assert store.versions() == versions[-1:] and rows(store.read("fact_sales")) == now
    publish.build(store, serving_until(spark, P, "2024-01-31"), crm, full_refresh=True).publish()
    assert rows(store.read("fact_cart_abandonment")) == rows(gold.fact_cart_abandonment(serving_until(spark, P, "2024-01-31")))


def test_a_draft_of_an_old_base_is_refused(spark, lake):
    P, crm, store = lake
    serving = serving_until(spark, P, "2024-01-05")
    one, two = publish.build(store, serving, crm), publish.build(store, serving, crm)
    version = one.publish()
    with pytest.raises(RuntimeError):
        two.publish()
    assert store.current() == version and store.versions() == [version]


def test_reading_a_version_prunes_columns_and_folders(spark, lake):
    P, crm, store = lake
    jobs.publish_gold(spark, P, crm)
    plan = store.read("fact_sales").select("price")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<price:double>" in plan
    day = sorted(store.manifest(store.current())["fact_sales"])[3]
    one = store.read_entries("fact_sales", store.manifest(store.current())["fact_sales"], {day})
    assert len({f.split("sale_date=")[1][:10] for f in one.inputFiles()}) == 1


def test_serving_job_fails_on_rows_that_break_the_contract(spark, workdir):
    L = catalog.Layers(spark, SF)
    P = daily.Paths(workdir)
    silver = L.silver.drop("event_id")
    tables.write_table(silver, P.silver, "event_date")
    days = ["--date", "2024-01-10", "--date", "2024-01-11"]
    assert jobs.run(["serving", "--root", workdir, *days], spark=spark) == 0
    good = rows(daily.read_serving(spark, P, with_id=False))
    faults = {"category": F.lit("x" * 101), "user_id": F.lit(None).cast("int"), "price": F.lit(None).cast("double")}
    for column, value in faults.items():
        wrong = F.when((F.col("event_date") == F.lit("2024-01-11").cast("date")) & (F.col("event_type") == "cart"), value).otherwise(F.col(column))
        tables.write_table(silver.withColumn(column, wrong), P.silver, "event_date")
        assert jobs.run(["serving", "--root", workdir, *days], spark=spark) == 1
        assert rows(daily.read_serving(spark, P, with_id=False)) == good


def test_silver_job_fails_on_a_crm_that_breaks_its_contract(spark, workdir):
    L = catalog.Layers(spark, SF)
    from strata.sources import bronze as bronze_src
    bronze_src.stage_by_day(L.raw.drop("event_id").withColumn("file_year", F.lit("2024")), workdir + "/bronze")
    for name, value in (("null", F.lit(None).cast("string")), ("long", F.lit("y" * 21))):
        L.crm.withColumn("loyalty_tier", value).write.parquet(f"{workdir}/{name}")
        argv = ["silver", "--root", workdir, "--date", "2024-01-10", "--crm-path", f"{workdir}/{name}"]
        assert jobs.run(argv, spark=spark) == 1
    L.crm.write.parquet(f"{workdir}/crm")
    argv = ["silver", "--root", workdir, "--crm-path", f"{workdir}/crm"]
    assert jobs.run([*argv, "--date", "2024-01-10", "--date", "2024-01-11", "--delta", "1"], spark=spark) == 0
    assert jobs.run(["compact", "--root", workdir], spark=spark) == 0
    assert jobs.run([*argv, "--date", "2024-01-11", "--delta", "2"], spark=spark) == 0
    P = daily.Paths(workdir)
    want = L.silver.where("event_date IN (DATE'2024-01-10', DATE'2024-01-11')").drop("event_id")
    assert rows(daily.read_silver(spark, P, with_id=False)) == rows(want)


# ---------------------------------------------------------------- database statements


def test_statements_of_a_day_reload(spark, monkeypatch):
    said, loaded = [], []
    monkeypatch.setattr(jdbc, "write_jdbc", lambda df, url, table, *a: loaded.append((table, df.count())))
    day = lambda d, n: [(1, "cart", 2, "a", "b", "c", 1.0, "s", dt.datetime(2024, 1, d, 5), "VIP", "Google")] * n
    df = spark.createDataFrame(day(1, 2) + day(2, 3) + day(3, 4), schemas.SERVING)
    jdbc.load_days_jdbc(df, "jdbc:x:", "silver.events", ["2024-01-01", "2024-01-03", "2024-01-09"], schemas.SERVING,
                        schemas.SERVING_LENGTHS, run=lambda s, url, sql, p: said.extend(sql))
    assert said[0].startswith("CREATE TABLE IF NOT EXISTS silver.events (user_id INT NOT NULL, event_type VARCHAR(20) NOT NULL, ")
    assert said[1:] == [f"DELETE FROM silver.events WHERE CAST(event_time AS DATE) = DATE '2024-01-0{d}'" for d in (1, 3, 9)]
    assert loaded == [("silver.events", 2), ("silver.events", 4), ("silver.events", 0)]
    with pytest.raises(ValueError):
        jdbc.delete_day_sql("t", "2024-01-01' OR '1' = '1")
    assert "user_id INT PRIMARY KEY" in jdbc.create_table_sql("crm", schemas.CRM, schemas.CRM_LENGTHS, key="user_id")


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_balanced_predicates_cover_every_row_once(spark, parts):
    # ids that cluster: most of them near each other, a few far away, some unknown
    keys = spark.range(0, 4000).select(F.when(F.col("id") % 100 == 0, F.lit(None)).when(F.col("id") < 3500, F.col("id"))
                                       .otherwise(F.col("id") * 1_000_000).cast("long").alias("user_id"))
    found = jdbc.balanced_predicates(keys, "user_id", parts)
    counts = [keys.where(p).count() for p in found]
    assert sum(counts) == 4000 and len(found) == parts
    at_once = keys.select(sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in found).alias("n"))
    assert at_once.where("n <> 1").count() == 0
    assert max(counts) <= 2 * 4000 / parts
    assert jdbc.balanced_predicates(keys.limit(0), "user_id", parts) == ["1 = 1"]


def test_crm_reads_in_ranges_by_default(spark, monkeypatch):
    asked = []

    class Reader:
        def jdbc(self, url, table, **options):
            asked.append((table, options))
            return spark.createDataFrame([(3, 90)] if "bounds" in table else [], "user_id int, loyalty_tier string" if "bounds" in table
                                         else "user_id int, loyalty_tier string, acquisition_channel string")

    class Session:
        read = Reader()

    crm_src.scan_crm(Session(), url="u", num_partitions=4)
    assert "min(user_id)" in asked[0][0] and (asked[1][1]["lowerBound"], asked[1][1]["numPartitions"]) == (3, 4)
    crm_src.scan_crm(Session(), url="u", predicates=["user_id < 5", "user_id >= 5"])
    assert asked[2][1]["predicates"] == ["user_id < 5", "user_id >= 5"]


def test_dq_enforce_still_names_the_failed_checks(spark):
    with pytest.raises(AssertionError, match="failures"):
        quality.enforce(checks.dq_not_null({n: spark.createDataFrame([(None,) * len(c)], ", ".join(f"{x} int" for x in c))
                                            for n, c in checks.NOT_NULL.items()}))
