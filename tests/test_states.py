"""Partial states by day, sketches, hot keys, landing by file, tables by name."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from strata import catalog, schemas
from strata.operators import enrich, hot_keys, tables
from strata.plans import daily, gold, named, sketches, states
from strata.session import local_path
from strata.sources import bronze as bronze_src
from strata.sources import csv as csv_src
from strata.streaming import landing_stream

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def serving(spark, workdir):
    L = catalog.Layers(spark, SF)
    path = workdir + "/serving"
    tables.write_table(L.serving.withColumn("event_date", F.to_date("event_time")), path, "event_date")
    return tables.read_table(spark, path)


def days_of(df):
    return [str(r[0]) for r in df.select("event_date").distinct().orderBy("event_date").collect()]


# ---------------------------------------------------------------- states


def test_a_load_reads_its_day_only(spark, serving, workdir):
    state = states.DayState(spark, workdir + "/visits", states.VISITS)
    days = days_of(serving)
    seen = []

    class Watched(states.DayState):
        pass

    def watch(df, *more):
        seen.append(df)
        return states.VISITS.of_events(df, *more)

    watched = Watched(spark, state.path, states.Aggregate(states.VISITS.keys, states.VISITS.first, states.VISITS.merge))
    object.__setattr__(watched.aggregate, "of_events", watch)
    watched.update(serving, days[4:5])
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert f"event_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and days[4] in plan
    assert state.open_days() == days[4:5]


def test_states_equal_the_dimensions_whatever_is_loaded_again(spark, serving, workdir):
    days = days_of(serving)
    visits = states.DayState(spark, workdir + "/visits", states.VISITS)
    products = states.DayState(spark, workdir + "/products", states.PRODUCTS)
    for state in (visits, products):
        with pytest.raises(FileNotFoundError):
            state.read()
        state.update(serving, days[10:])
        state.update(serving.where("price > 50"), days[:12])  # a first, wrong version of those days
        state.update(serving, days[:12])
        state.fold(days[5])
        state.fold(days[5])
        state.update(serving, days[6:9])
        state.fold(days[8])
        assert state.folded_until() == days[8] and state.open_days() == days[9:]
        with pytest.raises(ValueError):
            state.update(serving, [days[8]])
    assert rows(states.dim_users(visits)) == rows(gold.dim_users(serving))
    assert rows(states.dim_products(products)) == rows(gold.dim_products(serving))
    crm = catalog.Layers(spark, SF).crm
    assert rows(states.dim_users_loyalty(visits, crm)) == rows(gold.dim_users_loyalty(serving, crm))
    # an emptied day goes
    visits.update(serving.where(F.lit(False)), [days[-1]])
    left = serving.where(F.col("event_date") != F.lit(days[-1]).cast("date"))
    assert rows(states.dim_users(visits)) == rows(gold.dim_users(left))


def test_a_fold_that_broke_off_counts_nothing_twice(spark, serving, workdir, monkeypatch):
    days = days_of(serving)
    visits = states.DayState(spark, workdir + "/visits", states.VISITS)
    visits.update(serving, days)
    with monkeypatch.context() as m:  # the new base is there, the days it covers still are
        m.setattr(tables, "delete_path", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            visits.fold(days[6])
    assert rows(states.dim_users(visits)) == rows(gold.dim_users(serving))
    # a base without its _SUCCESS file doesn't count
    serving.limit(1).selectExpr("user_id", "user_session", "event_time AS began", "event_time AS ended").write.parquet(visits.path + f"/base/until={days[9]}")
    tables.delete_path(spark, visits.path + f"/base/until={days[9]}/_SUCCESS")
    assert visits.folded_until() == days[6] and rows(states.dim_users(visits)) == rows(gold.dim_users(serving))


# ---------------------------------------------------------------- sketches


def test_sketches_merge_to_within_their_error(spark, workdir):
    n, path = 60_000, workdir + "/sketches"
    events = spark.range(3 * n).select((F.col("id") % n).cast("string").alias("s"), F.expr("date_add(DATE'2024-01-01', cast(id div 30000 as int))").alias("d"))
    days = [str(dt.date(2024, 1, 1) + dt.timedelta(days=k)) for k in range(6)]
    for part in (days[:4], days[3:]):
        sketches.update_sketches(spark, path, events, "s", "d", part)
    stored = tables.read_table(spark, path)
    assert stored.count() == 6 and stored.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    assert abs(sketches.merged_count(stored).first()[0] - n) <= 4 * sketches.relative_error() * n
    for r in sketches.merged_count(stored, "d").collect():
        assert abs(r.estimate - 30_000) <= 4 * sketches.relative_error() * 30_000
    plan = sketches.merged_count(stored.where("d >= DATE'2024-01-03'"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "ReadSchema: struct<sketch:binary>" in plan
    # a day loaded again with nothing
    sketches.update_sketches(spark, path, events.where(F.lit(False)), "s", "d", days)
    assert sketches.merged_count(spark.createDataFrame([], stored.schema)).first()[0] == 0


# ---------------------------------------------------------------- hot keys


def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 8).when(F.col("id") % 7 != 0, F.col("id")).alias("k"))
    assert hot_keys.hot_keys(df, "k", 0.05) == [7, 8]
    assert hot_keys.hot_keys(df, "k", 0.3) == [7]
    assert hot_keys.hot_keys(df.where("k IS NULL"), "k", 0.1) == []
    assert len(hot_keys.hot_keys(df, "k", 0.0, most=5)) == 5


def test_a_hot_user_fills_no_partition_even_without_aqe(spark):
    n = 12_000
    events = spark.range(n).select(F.when(F.col("id") % 3 == 0, 42).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 900 + 100).cast("int").alias("user_id"),
                                   F.col("id").alias("event"))
    crm = spark.range(1000).select(F.col("id").cast("int").alias("user_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("loyalty_tier"),
                                   F.lit("c").alias("acquisition_channel"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        hot = hot_keys.hot_keys(events, "user_id", 0.05)
        assert hot == [42]
        plain, apart = enrich.enrich(events, crm), enrich.enrich(events, crm, hot)

        def sizes(df):
            return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]

        assert max(sizes(plain)) > 2 * statistics.median(sizes(plain))
        assert max(sizes(apart)) <= 2 * statistics.median(sizes(apart))
        assert rows(apart.select(*plain.columns)) == rows(plain)
        assert rows(enrich.enrich(events, crm, []).select(*plain.columns)) == rows(plain)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


# ---------------------------------------------------------------- landing by file


def test_landing_stream_reads_new_files_only(spark, workdir):
    L = catalog.Layers(spark, SF)
    raw = L.raw.drop("event_id")
    month = F.when(F.col("event_time").rlike("^[0-9]{4}-"), F.substring("event_time", 1, 7)).otherwise("undated")
    first, second = raw.where("product_id % 2 = 0 OR product_id IS NULL"), raw.where("product_id % 2 <> 0")
    csv_src.write_csv(first.withColumn("period", month), workdir + "/landing/one", "period")
    got = landing_stream.stage_landing(spark, workdir + "/landing", workdir + "/staging", workdir + "/ckpt", timeout_s=600)
    want = bronze_src.stage_by_day(csv_src.scan_csv(spark, workdir + "/landing/one"), workdir + "/whole")
    assert got == want and got["read"] == first.count()
    csv_src.write_csv(second.withColumn("period", month), workdir + "/landing/two", "period")
    more = landing_stream.stage_landing(spark, workdir + "/landing", workdir + "/staging", workdir + "/ckpt", max_files_per_trigger=1, timeout_s=600)
    assert more["read"] == second.count()  # none of the first drop again
    assert landing_stream.stage_landing(spark, workdir + "/landing", workdir + "/staging", workdir + "/ckpt", timeout_s=600) == {"read": 0, "staged": 0}
    both = [bronze_src.staged(csv_src.scan_csv(spark, f"{workdir}/landing/{d}")) for d in ("one", "two")]
    assert rows(landing_stream.read_staged(spark, workdir + "/staging")) == rows(both[0].unionByName(both[1]))


def test_file_year_of_a_stream_equals_that_of_a_scan(spark, workdir):
    import os
    folder = local_path(workdir) + "/landing"
    text = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n2019-10-01 00:00:00 UTC,view,1,1,a.b,x,1.5,7,s\n"
    for name in ("2019-Oct.csv", "events 2021.csv", "plain.csv", "period=2018-03/part-00000-2099.csv"):
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    scan = sorted(r.file_year for r in csv_src.scan_csv(spark, workdir + "/landing").collect())
    batch = spark.read.schema(schemas.RAW_CLICKSTREAM).option("header", True).option("recursiveFileLookup", True).csv(workdir + "/landing")
    assert sorted(r.file_year for r in landing_stream.with_file_year(batch).collect()) == scan == ["2018", "2019", "2020", "2021"]


# ---------------------------------------------------------------- names


def test_tables_by_name_are_pruned_and_counted(spark, serving, workdir):
    P = daily.Paths(workdir)
    daily.fact_sales_incremental(spark, P.fact_sales, serving.drop("event_date"))
    name = named.declare(spark, "strata_test", "fact_sales", P.fact_sales, daily.FACT_SCHEMAS["sale_date"], "sale_date")
    named.declare(spark, "strata_test", "fact_sales", P.fact_sales, daily.FACT_SCHEMAS["sale_date"], "sale_date")  # again
    stored = daily.read_fact(spark, P.fact_sales, "sale_date")
    assert spark.table(name).drop("sale_date").exceptAll(stored).isEmpty() and spark.table(name).count() == stored.count()
    day = days_of(serving)[3]
    df = spark.sql(f"SELECT price FROM {name} WHERE sale_date = DATE '{day}'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ReadSchema: struct<price:double>" in plan
    assert "Location: InMemoryFileIndex(1 paths)" in plan
    info = {r.info_name: r.info_value for r in spark.sql(f"DESC EXTENDED {name} product_id").collect()}
    assert int(info["distinct_count"]) > 0
    assert f"{stored.count()} rows" in " ".join(str(r.data_type) for r in spark.sql(f"DESC EXTENDED {name}").collect())
    spark.sql("DROP DATABASE strata_test CASCADE")
    assert tables.table_exists(spark, P.fact_sales)  # external: the files stay
