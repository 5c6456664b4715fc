"""Write, audit, publish: Gold changes as a whole, after its checks, or not at all.

Layout below ``root``::

    <table>/version=<v>/[<partition>=<value>/]   what version v wrote
    manifest/<v>.json                            which version holds each table or partition
    _current                                     the published version

A ``Draft`` writes its tables into a new version's folders, where no reader looks. The
checks read the draft as it would be published; if one fails, an error is raised and the
published version stays as it was. ``publish`` writes the manifest and then replaces
``_current`` by a rename, the one step that readers see. A table that is loaded by
partitions names, for each of them, the version that wrote it last: an incremental load
writes its own days only and shares all others with the versions before.

A manifest has a line for each partition (days), so it is small; it never holds rows.
Publishing refuses a draft whose base is no longer the published version.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas
from strata.operators import quality, tables
from strata.plans import daily, gold

# Tables of Gold: their contracts and, for those loaded by partitions, the partition column.
CONTRACTS = {"dim_users": schemas.DIM_USERS, "dim_products": schemas.DIM_PRODUCTS, "dim_users_loyalty": schemas.DIM_USERS_LOYALTY,
             "fact_sales": schemas.FACT_SALES, "fact_cart_abandonment": schemas.FACT_CART_ABANDONMENT}
PARTITIONED = {"fact_sales": "sale_date", "fact_cart_abandonment": "cart_date"}
WHOLE = ""  # the one entry of a table that isn't loaded by partitions


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = tables._fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = tables._fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another: one step on file systems with an atomic rename."""
    _, p, jvm = tables._fs(spark, source)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(p, jvm.org.apache.hadoop.fs.Path(target), options)


class GoldStore:
    """Published versions of the Gold tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> str | None:
        """The published version, None before the first."""
        text = _read_text(self.spark, f"{self.root}/_current")
        return text.strip() if text else None

    def manifest(self, version: str | None) -> dict[str, dict[str, str]]:
        """table: {partition value, or "" for a whole table: the version that holds it}."""
        text = _read_text(self.spark, f"{self.root}/manifest/{version}.json") if version else None
        return json.loads(text) if text else {}

    def versions(self) -> list[str]:
        fs, p, _ = tables._fs(self.spark, f"{self.root}/manifest")
        return sorted(s.getPath().getName()[:-5] for s in fs.listStatus(p) if s.getPath().getName().endswith(".json")) if fs.exists(p) else []

    def folder(self, name: str, version: str) -> str:
        return f"{self.root}/{name}/version={version}"

    def read(self, name: str, version: str | None = None) -> DataFrame:
        """A table of the published version, or of ``version``, without its partition column."""
        return self.read_entries(name, self.manifest(version or self.current()).get(name, {}))

    def read_entries(self, name: str, entries: dict[str, str], values: set[str] | None = None, keep_partition: bool = False) -> DataFrame:
        """The rows that manifest ``entries`` name (``values``: of these partitions only)."""
        column = PARTITIONED.get(name)
        schema = daily.FACT_SCHEMAS[column] if column else CONTRACTS[name]
        wanted = {v: at for v, at in entries.items() if values is None or v in values}
        folders = [tables.partition_path(self.folder(name, at), column, v) if v != WHOLE else self.folder(name, at) for v, at in sorted(wanted.items())]
        if folders:
            # Several folders of one table: what lies above them is read as a column, which isn't wanted.
            reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
            df = reader.parquet(*folders).select(*schema.names)
        else:
            df = self.spark.createDataFrame([], schema)
        return df.drop(column) if column and not keep_partition else df

    def draft(self) -> Draft:
        return Draft(self)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove what only versions older than the last ``keep`` published ones hold, and drafts
        that were never published (no draft may be under way). Returns the folders removed."""
        current = self.current()
        kept = [v for v in self.versions() if current is not None and v <= current][-max(1, keep):]
        used = {(name, at) for v in kept for name, entries in self.manifest(v).items() for at in entries.values()}
        removed = []
        for name in CONTRACTS:
            for at in tables.list_partitions(self.spark, f"{self.root}/{name}", "version"):
                if (name, at) not in used:
                    tables.delete_path(self.spark, self.folder(name, at))
                    removed.append(self.folder(name, at))
        for v in self.versions():
            if v not in kept:
                tables.delete_path(self.spark, f"{self.root}/manifest/{v}.json")
        return removed


class Draft:
    """A version under way, on top of the one published when it began."""

    def __init__(self, store: GoldStore):
        self.store, self.spark = store, store.spark
        self.base = store.current()
        self.version = f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:6]}"
        self.entries = store.manifest(self.base)

    def write(self, name: str, df: DataFrame) -> None:
        """Write a whole table."""
        tables.write_table(schemas.conform(df, CONTRACTS[name]), self.store.folder(name, self.version))
        self.entries[name] = {WHOLE: self.version}

    def load(self, name: str, job: Callable[[str], object], lookback_days: int = daily.LOOKBACK_DAYS, full_refresh: bool = False) -> None:
        """Run an incremental ``job`` (path) of a partitioned table on a copy of the newest
        days, as many as its lookback reaches, so what it changes lies in this version only."""
        column, path, old = PARTITIONED[name], self.store.folder(name, self.version), self.store.manifest(self.base).get(name, {})
        tables.delete_path(self.spark, path)  # a load before in this draft
        dated = sorted(v for v in old if v != tables.NULL_PARTITION)
        if dated and not full_refresh:
            since = (dt.date.fromisoformat(dated[-1]) - dt.timedelta(days=lookback_days)).isoformat()
            days = {v for v in dated if v >= since}
            tables.write_table(self.store.read_entries(name, old, days, keep_partition=True), path, column)
        job(path)
        new = {v: self.version for v in tables.list_partitions(self.spark, path, column)}
        self.entries[name] = new if full_refresh else {**old, **new}

    def read(self, name: str) -> DataFrame:
        return self.store.read_entries(name, self.entries.get(name, {}))

    def publish(self, audit: Callable[[Draft], DataFrame] | None = None) -> str:
        """Make this the published version if every check of ``audit``'s report passes."""
        if audit is not None:
            quality.enforce(audit(self))
        _write_text(self.spark, f"{self.store.root}/manifest/{self.version}.json", json.dumps(self.entries, indent=0, sort_keys=True))
        if self.store.current() != self.base:
            tables.delete_path(self.spark, f"{self.store.root}/manifest/{self.version}.json")
            raise RuntimeError(f"another version was published since {self.base}")
        told = f"{self.store.root}/_current.{self.version}"
        _write_text(self.spark, told, self.version)
        _replace(self.spark, told, f"{self.store.root}/_current")
        return self.version


def build(store: GoldStore, serving: DataFrame, crm: DataFrame, full_refresh: bool = False, retract: bool = False) -> Draft:
    """A draft of all Gold tables: dimensions anew, facts by their lookback."""
    spark, draft = store.spark, store.draft()
    draft.write("dim_users", gold.dim_users(serving))
    draft.write("dim_products", gold.dim_products(serving))
    draft.write("dim_users_loyalty", gold.dim_users_loyalty(serving, crm))
    draft.load("fact_sales", lambda path: daily.fact_sales_incremental(spark, path, serving, full_refresh=full_refresh), full_refresh=full_refresh)
    draft.load("fact_cart_abandonment", lambda path: daily.fact_cart_abandonment_incremental(
        spark, path, serving, full_refresh=full_refresh, retract=retract), full_refresh=full_refresh)
    return draft
