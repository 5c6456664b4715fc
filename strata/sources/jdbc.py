"""JDBC sink for the serving table (the reading side is ``crm.scan_crm``).

Writes are parallel (one connection per task, ``num_partitions`` caps the
connections) in ``batch_size`` statements. A database cannot drop a day the
way a partitioned table can, so a day reload over JDBC runs the database's
own DELETE before this append (``load_days_jdbc``). The Parquet serving table
(``tables.replace_partitions``) needs no such step. No database can be reached
here: the statements and the rows per day are tested, the connection is not.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               num_partitions: int | None = None, batch_size: int = 10_000, mode: str = "append") -> None:
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    if num_partitions:
        props.setdefault("numPartitions", str(num_partitions))
    df.write.jdbc(url, table, mode=mode, properties=props)


def execute(spark: SparkSession, url: str, statements: list[str], properties: dict | None = None) -> None:
    """Run statements on the database in one transaction, over a connection of the driver."""
    jvm = spark.sparkContext._jvm
    given = dict(properties or {})
    driver = given.pop("driver", None)
    if driver:
        jvm.java.lang.Class.forName(driver)
    info = jvm.java.util.Properties()
    for k, v in given.items():
        info.setProperty(k, str(v))
    connection = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.execute(sql)
        connection.commit()
    finally:
        connection.close()


SQL_TYPES = {"int": "INT", "bigint": "BIGINT", "double": "DOUBLE PRECISION", "date": "DATE", "timestamp": "TIMESTAMP",
             "string": "TEXT"}


def create_table_sql(table: str, schema: T.StructType, lengths: dict[str, int] | None = None, key: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS of a contract."""
    columns = []
    for f in schema.fields:
        kind = f"VARCHAR({lengths[f.name]})" if f.name in (lengths or {}) else SQL_TYPES[f.dataType.simpleString()]
        columns.append(f"{f.name} {kind}{' PRIMARY KEY' if f.name == key else '' if f.nullable else ' NOT NULL'}")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def delete_day_sql(table: str, run_date: str, column: str = "event_time") -> str:
    """DELETE of one day's rows; the day is passed as checked ISO text."""
    day = datetime.date.fromisoformat(str(run_date))
    return f"DELETE FROM {table} WHERE CAST({column} AS DATE) = DATE '{day.isoformat()}'"


def replace_day_jdbc(df: DataFrame, url: str, table: str, delete, run_date: str, column: str = "event_time",
                     properties: dict | None = None, num_partitions: int | None = None) -> None:
    """Reload one day: ``delete`` runs a statement on the database, then the day's rows are
    appended. Not tried against a database here."""
    delete(delete_day_sql(table, run_date, column))
    write_jdbc(df, url, table, properties, num_partitions)


def load_days_jdbc(df: DataFrame, url: str, table: str, run_dates: list[str], schema: T.StructType, lengths: dict[str, int],
                   properties: dict | None = None, num_partitions: int | None = None, column: str = "event_time",
                   run=execute) -> None:
    """The day reload of a database table: it is made if it is missing, then each day is
    deleted and its rows appended, with the contract enforced while they are written. A run
    that fails between the two is repaired by running the day again."""
    spark = df.sparkSession
    run(spark, url, [create_table_sql(table, schema, lengths)], properties)
    rows = schemas.enforced(df, schema, lengths)
    for d in run_dates:
        day = rows.where(F.to_date(column) == F.lit(str(d)).cast("date"))
        replace_day_jdbc(day, url, table, lambda sql: run(spark, url, [sql], properties), d, column, properties, num_partitions)


def balanced_predicates(keys: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """Disjoint WHERE clauses that together cover every value of ``column``, NULL included,
    each with about as many of ``keys``' rows: bounds are quantiles, not equal widths, so
    ids that cluster don't gather in one query. One aggregate over the key column."""
    shares = [i / parts for i in range(1, parts)]
    found = keys.agg(F.percentile_approx(column, shares, accuracy).alias("q")).first()["q"] if shares else None
    bounds = sorted({int(b) for b in found or []})
    if not bounds:
        return ["1 = 1"]
    out = [f"{column} < {bounds[0]} OR {column} IS NULL"]
    out += [f"{column} >= {low} AND {column} < {high}" for low, high in zip(bounds, bounds[1:])]
    return [*out, f"{column} >= {bounds[-1]}"]
