"""Spark session settings and the shared work folder.

Library code never hard-codes cluster sizing (executor memory, cores); those
belong to ``spark-submit``. What it does pin are the settings the results
depend on: UTC session zone (event_date, timestamp text in hash keys), dynamic
partition overwrite (idempotent day reloads and upserts) and AQE (runtime
partition coalescing, skew-join splitting, broadcast conversion).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested ``spark-submit --conf`` values for a load of ``input_bytes``
    (e.g. one day of Bronze): enough initial shuffle partitions for ~256 MB
    each, AQE sizing by bytes rather than by parallelism, and skew splitting
    above 1 GB. Returned, not applied: cluster sizing belongs to the submitter."""
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.parquet.compression.codec": "zstd",
    }


def build_session(master: str | None = None, app_name: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the required settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable required options to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS/object store) — every executor and the
    driver see it. Only a local-mode session without the setting gets a
    private temporary folder, as in tests.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir")
    if not d:
        opt = sc._jsc.sc().getCheckpointDir()
        d = opt.get() if opt.isDefined() else None
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return f"{base}/strata-work/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python-side code can inspect a local path."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
