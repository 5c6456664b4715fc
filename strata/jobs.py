"""Command-line jobs: the daily flow over one storage root.

    python -m strata.jobs stage    --root R --landing DIR
    python -m strata.jobs publish  --root R --date 2024-01-05
    python -m strata.jobs silver   --root R --date 2024-01-05 --crm-path P   (or --crm-url/--crm-table)
    python -m strata.jobs compact  --root R                   (fold Silver's deltas into its base)
    python -m strata.jobs serving  --root R --date 2024-01-05 [--jdbc-url U --jdbc-table T --jdbc-property k=v]
    python -m strata.jobs gold     --root R --crm-path P [--full-refresh] [--retract] [--publish]
    python -m strata.jobs dq       --root R --crm-path P      (exit 1 when a check fails)
    python -m strata.jobs kpi      --root R
    python -m strata.jobs day      --root R --date 2024-01-05 --crm-path P   (publish to checks; exit 1 when one fails)
    python -m strata.jobs land     --root R --landing DIR     (stage the landing files that came since the last run)
    python -m strata.jobs dims     --root R --date 2024-01-05 --crm-path P [--fold 2023-12-31]   (dimensions from states by day)
    python -m strata.jobs sketch   --root R --date 2024-01-05 (distinct purchasing sessions from one sketch a day)
    python -m strata.jobs carts    --root R --crm-path P [--delay "2 days"] [--horizon "31 days"]  (abandonment as a stream)
    python -m strata.jobs names    --root R --database D      (name the stored tables in the session's catalogue)
    python -m strata.jobs sample   --root R --quota-bytes N --used-bytes N  (users that fit the quota)

Folders below ``--root``: staging, bronze, silver, quarantine, serving,
dim_users, dim_products, dim_users_loyalty, fact_sales, fact_carts, crm, sampled_users,
and gold, the published versions (``day`` and ``gold --publish`` write there: the checks
run first, and a failed one leaves the published version as it was; ``dq`` and ``kpi``
read it where there is one). ``silver --delta N`` appends to Silver as load N instead of
rewriting its days. Every job can be re-run for the same date with the same result. Cluster sizing
comes from ``spark-submit``; the session only gets the settings results depend
on (``strata.session``).
"""

from __future__ import annotations

import argparse
import os
import re
import sys
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import sample, tables
from strata.plans import checks, daily, kpi, named, publish, sketches, states
from strata.plans.publish import Draft, GoldStore
from strata.session import build_session
from strata.sources import bronze as bronze_src
from strata.sources import csv as csv_src
from strata.sources import jdbc
from strata.sources.crm import scan_crm
from strata.streaming import cart_stream, landing_stream

SEED_SALT = "crm-seed"


def _crm(spark: SparkSession, args, P: daily.Paths) -> DataFrame:
    if getattr(args, "crm_url", None):
        columns = [f.name for f in schemas.CRM.fields]
        if args.crm_keys:  # ranges of equal numbers of keys, as a stored copy or the users of Silver have them
            predicates = jdbc.balanced_predicates(spark.read.parquet(args.crm_keys), "user_id", args.crm_partitions)
            return _contract(scan_crm(spark, url=args.crm_url, table=args.crm_table, columns=columns, predicates=predicates))
        return _contract(scan_crm(spark, url=args.crm_url, table=args.crm_table, columns=columns,
                                  num_partitions=args.crm_partitions, lower_bound=args.crm_lower, upper_bound=args.crm_upper))
    return _contract(spark.read.parquet(getattr(args, "crm_path", None) or P.crm))


def _contract(crm: DataFrame) -> DataFrame:
    return schemas.enforced(crm, schemas.CRM, schemas.CRM_LENGTHS)


def _serving(spark: SparkSession, P: daily.Paths) -> DataFrame:
    return daily.read_serving(spark, P, with_id=False).drop("event_date")


CHECKED = ("dim_users_loyalty", "dim_products", "fact_sales", "fact_cart_abandonment")


def stored_tables(spark: SparkSession, P: daily.Paths, crm: DataFrame, source: GoldStore | Draft | None = None) -> dict[str, DataFrame]:
    """The tables that checks read: Gold of a draft, of the published version, or in place."""
    if source is None and GoldStore(spark, P.gold).current():
        source = GoldStore(spark, P.gold)
    if source is not None:
        return {"ecommerce_events": _serving(spark, P), "user_loyalty": crm, **{name: source.read(name) for name in CHECKED}}
    return {
        "ecommerce_events": _serving(spark, P),
        "user_loyalty": crm,
        "dim_users_loyalty": tables.read_table(spark, P.dim_users_loyalty, schemas.DIM_USERS_LOYALTY),
        "dim_products": tables.read_table(spark, P.dim_products, schemas.DIM_PRODUCTS),
        "fact_sales": daily.read_fact(spark, P.fact_sales, "sale_date"),
        "fact_cart_abandonment": daily.read_fact(spark, P.fact_carts, "cart_date"),
    }


def load_gold(spark: SparkSession, P: daily.Paths, crm: DataFrame, full_refresh: bool = False,
              retract: bool = False) -> None:
    """Dimensions (full refresh) and facts (incremental) from the stored serving table."""
    serving = _serving(spark, P)
    daily.build_dims(spark, P, serving, crm)
    daily.fact_sales_incremental(spark, P.fact_sales, serving, full_refresh=full_refresh)
    daily.fact_cart_abandonment_incremental(spark, P.fact_carts, serving, full_refresh=full_refresh, retract=retract)


def publish_gold(spark: SparkSession, P: daily.Paths, crm: DataFrame, full_refresh: bool = False, retract: bool = False) -> str:
    """Build Gold as a draft, check it, publish it; returns the version. A failed check raises,
    and the published version stays."""
    draft = publish.build(GoldStore(spark, P.gold), _serving(spark, P), crm, full_refresh=full_refresh, retract=retract)
    return draft.publish(lambda d: checks.dq_report(stored_tables(spark, P, crm, d)))


def run_day(spark: SparkSession, P: daily.Paths, run_date: str, crm: DataFrame, retract: bool = False) -> dict:
    """One staged day from Bronze to checked and then published Gold; returns the row counts.

    Stops with an error at the first step that fails. Gold is checked before it is
    published, so a bad day leaves the published version as it was."""
    bronze_src.publish_day(spark, P.staging, P.bronze, run_date)
    raw = bronze_src.scan_day(spark, P.bronze, run_date)
    counts = daily.bronze_to_silver(spark, P, crm, raw, run_dates=[run_date])
    counts["serving_rows"] = daily.silver_to_serving(spark, P, [run_date], with_id=False)
    counts["version"] = publish_gold(spark, P, crm, retract=retract)
    return counts


def update_dims(spark: SparkSession, P: daily.Paths, dates: list[str], crm: DataFrame, fold: str | None = None) -> dict:
    """Load the days into the states and write the dimensions from them; with ``fold`` merge
    older days, which then can't be loaded again."""
    serving = daily.read_serving(spark, P, with_id=False)
    visits = states.DayState(spark, P.state_visits, states.VISITS)
    products = states.DayState(spark, P.state_products, states.PRODUCTS)
    for state in (visits, products):
        state.update(serving, dates)
        if fold:
            state.fold(fold)
    tables.write_table(states.dim_users(visits), P.dim_users)
    tables.write_table(states.dim_products(products), P.dim_products)
    tables.write_table(states.dim_users_loyalty(visits, crm), P.dim_users_loyalty)
    return {"days": len(visits.open_days()), "folded_until": visits.folded_until()}


def declare_tables(spark: SparkSession, P: daily.Paths, database: str) -> list[str]:
    """Name the tables that are stored in place."""
    known = [("ecommerce_events", P.serving, daily.serving_schema(False), "event_date"), ("user_loyalty", P.crm, schemas.CRM, None),
             ("dim_users", P.dim_users, schemas.DIM_USERS, None), ("dim_products", P.dim_products, schemas.DIM_PRODUCTS, None),
             ("dim_users_loyalty", P.dim_users_loyalty, schemas.DIM_USERS_LOYALTY, None),
             ("fact_sales", P.fact_sales, daily.FACT_SCHEMAS["sale_date"], "sale_date"),
             ("fact_cart_abandonment", P.fact_carts, daily.FACT_SCHEMAS["cart_date"], "cart_date")]
    return [named.declare(spark, database, name, path, schema, column) for name, path, schema, column in known
            if tables.table_exists(spark, path)]


def register_views(spark: SparkSession, P: daily.Paths, crm: DataFrame) -> list[str]:
    """Name the stored tables as temporary views for SQL; returns the names."""
    named = stored_tables(spark, P, crm)
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    return sorted(named)


def _serving_days(spark: SparkSession, P: daily.Paths, dates: list[str]) -> DataFrame:
    days = daily.read_serving(spark, P, with_id=False)
    return days.where(F.col("event_date").isin([F.lit(d).cast("date") for d in dates])).drop("event_date")


def _properties(given: list[str]) -> dict[str, str]:
    pairs = (p.split("=", 1) for p in given)
    return {k: os.environ[v[1:]] if v.startswith("$") else v for k, v in pairs}


def _gated(job: Callable[[], object]) -> int:
    """Exit code of a job: 1 where a check failed or a row broke its contract."""
    try:
        print(job())
    except AssertionError as e:
        print(e)
        return 1
    except (PySparkException, Py4JJavaError) as e:
        broken = re.search(r"contract: \w+ is [\w ]+", str(e))
        if broken is None:
            raise
        print(broken.group())
        return 1
    return 0


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata.jobs")
    ap.add_argument("job", choices=["stage", "publish", "silver", "compact", "serving", "gold", "dq", "kpi", "day", "sample",
                                     "land", "dims", "sketch", "carts", "names"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--date", action="append", help="run date YYYY-MM-DD (repeatable)")
    ap.add_argument("--landing")
    ap.add_argument("--crm-path")
    ap.add_argument("--crm-url")
    ap.add_argument("--crm-table", default="crm.user_loyalty")
    ap.add_argument("--crm-partitions", type=int)
    ap.add_argument("--crm-keys", help="Parquet with user_id whose quantiles bound the range queries")
    ap.add_argument("--crm-lower", type=int)
    ap.add_argument("--crm-upper", type=int)
    ap.add_argument("--local-sort", action="store_true", help="stage without a shuffle (time-ordered landing)")
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--retract", action="store_true")
    ap.add_argument("--fold", help="merge the states of days up to this one")
    ap.add_argument("--delay", default=cart_stream.DELAY, help="how late a row of the stream may come")
    ap.add_argument("--horizon", default=cart_stream.HORIZON, help="how far apart a cart and its purchase may lie")
    ap.add_argument("--database", default="strata")
    ap.add_argument("--publish", action="store_true", help="check Gold as a draft, then publish it as a version")
    ap.add_argument("--delta", type=int, help="number of the load: append to Silver instead of rewriting days")
    ap.add_argument("--jdbc-url", help="also reload the days into this database")
    ap.add_argument("--jdbc-table", default="silver.ecommerce_events")
    ap.add_argument("--jdbc-property", action="append", default=[], help="name=value; a value that starts with $ is read from the environment")
    ap.add_argument("--jdbc-partitions", type=int)
    ap.add_argument("--quota-bytes", type=int, default=512 * 1024 * 1024)
    ap.add_argument("--used-bytes", type=int, default=0)
    args = ap.parse_args(argv)

    spark = spark or build_session(app_name=f"strata-{args.job}")
    P = daily.Paths(args.root)
    dates = args.date or []
    if args.job in ("publish", "silver", "serving", "day", "dims", "sketch") and not dates:
        ap.error(f"{args.job} needs --date")

    if args.job == "stage":
        if not args.landing:
            ap.error("stage needs --landing")
        print(bronze_src.stage_by_day(csv_src.scan_csv(spark, args.landing), P.staging, local_sort=args.local_sort))
    elif args.job == "publish":
        bronze_src.publish_days(spark, P.staging, P.bronze, dates)
    elif args.job == "silver":
        raw = daily.bronze_days(spark, P.bronze, dates, bronze_src.staged_schema())
        return _gated(lambda: daily.bronze_to_silver(spark, P, _crm(spark, args, P), raw, run_dates=dates, delta=args.delta))
    elif args.job == "compact":
        print({"compacted": daily.compact_silver(spark, P, with_id=False)})
    elif args.job == "serving":
        failed = _gated(lambda: {"serving_rows": daily.silver_to_serving(spark, P, dates, with_id=False)})
        if failed or not args.jdbc_url:
            return failed
        days = _serving_days(spark, P, dates)
        jdbc.load_days_jdbc(days, args.jdbc_url, args.jdbc_table, dates, schemas.SERVING, schemas.SERVING_LENGTHS,
                            _properties(args.jdbc_property), args.jdbc_partitions)
    elif args.job == "gold" and args.publish:
        return _gated(lambda: publish_gold(spark, P, _crm(spark, args, P), full_refresh=args.full_refresh, retract=args.retract))
    elif args.job == "gold":
        load_gold(spark, P, _crm(spark, args, P), full_refresh=args.full_refresh, retract=args.retract)
    elif args.job == "day":
        return _gated(lambda: [run_day(spark, P, d, _crm(spark, args, P), retract=args.retract) for d in dates])
    elif args.job == "dq":
        report = checks.dq_report(stored_tables(spark, P, _crm(spark, args, P)))
        rows = report.collect()          # one row per check (20)
        for r in rows:
            print(f"{r['table']:24} {r['column']:16} {r['check']:40} {r['failures']}")
        if any(r["failures"] > 0 for r in rows):
            return 1
    elif args.job == "kpi":
        named = stored_tables(spark, P, spark.createDataFrame([], schemas.CRM))
        sales, carts, users = (named[n] for n in ("fact_sales", "fact_cart_abandonment", "dim_users_loyalty"))
        for name, df in [("revenue", kpi.kpi_revenue(sales)), ("customers", kpi.kpi_customers(users)),
                         ("abandonment", kpi.kpi_abandonment_rate(carts, sales)),
                         ("tiers", kpi.users_by_tier(users)), ("channels", kpi.users_by_channel(users)),
                         ("top_brands", kpi.top_brands(sales))]:
            print(name, [r.asDict() for r in df.collect()])   # small reports (≤ 10 rows)
    elif args.job == "land":
        if not args.landing:
            ap.error("land needs --landing")
        print(landing_stream.stage_landing(spark, args.landing, P.staging_landed, P.landing_checkpoint))
    elif args.job == "dims":
        return _gated(lambda: update_dims(spark, P, dates, _crm(spark, args, P), args.fold))
    elif args.job == "sketch":
        bought = daily.read_serving(spark, P, with_id=False).where("event_type = 'purchase'")
        sketches.update_sketches(spark, P.session_sketches, bought, "user_session", "event_date", dates)
        print({"sessions": sketches.merged_count(tables.read_table(spark, P.session_sketches)).first()[0],
               "standard_error": round(sketches.relative_error(), 4)})
    elif args.job == "carts":
        return _gated(lambda: cart_stream.stream_cart_abandonment(
            spark, P.bronze, P.fact_carts_stream, _crm(spark, args, P), bronze_src.staged_schema(), P.carts_checkpoint,
            delay=args.delay, horizon=args.horizon))
    elif args.job == "names":
        print(declare_tables(spark, P, args.database))
    elif args.job == "sample":
        users = sample.distinct_users(spark.read.schema(bronze_src.staged_schema()).parquet(P.staging))
        chosen = sample.bounded_sample(users, sample.row_budget(args.quota_bytes, args.used_bytes), "user_id", SEED_SALT)
        tables.write_table(chosen, P.sampled_users)
    return 0


if __name__ == "__main__":
    sys.exit(run())
