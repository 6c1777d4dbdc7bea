"""Session construction and the shared scratch location.

On a cluster the session is created by the platform; ``configure`` only fills in
settings that are still unset. ``scratch_dir`` reads ``spark.checkpoint.dir``
(the shared folder the cluster names) and falls back to a fresh local folder
only when it is unset, as in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings we rely on; applied only where the session leaves them unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plan-time scan sizes come from compressed parquet bytes; decoded rows are
    # several times larger. Without this factor a fact-sized scan can look
    # "small" and be chosen as a broadcast build side.
    "spark.sql.sources.fileCompressionFactor": "4",
    # A side partitioned by adsh alone serves a join on (adsh, tag_id) as well; skewed
    # partitions are split by AQE.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerline") -> SparkSession:
    """Local session for tests, benchmarks and examples (UI off, UTC)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS to an existing session without overriding explicit settings."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


SCRATCH_KEY = "ledgerline.scratch.dir"


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only when it is unset and the
    master is local (tests, local runs) a local folder is created; on any other
    master an unset folder is an error, since executors would write to their own
    disks. ``spark.checkpoint.dir`` itself is a static setting, so the folder is
    registered as the RDD checkpoint directory and remembered under ``SCRATCH_KEY``
    for this session.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster, scratch tables "
                               "need a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set(SCRATCH_KEY, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never-used path under the shared scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table made under ``fresh_path``, on whatever store holds it."""
    if not path.startswith(scratch_dir(spark) + "/"):
        raise ValueError(f"not a scratch path: {path}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def batches_of(spark: SparkSession, max_bytes: int) -> Iterator[None]:
    """Actions within send Python about ``max_bytes`` at a time, for tables whose rows are of
    megabytes: up to Spark's own 64 MB, a batch takes several times its size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(max_bytes))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def spread(scan: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a bare scan over the cluster when it has too few splits.

    For CPU-heavy per-row work (tokenising, regex extraction, vector distances)
    straight after a read. Large inputs arrive in many splits and pass through
    untouched; a single-row-group file would otherwise run in one task. Meant for
    scans alone: there, counting the partitions runs no job.
    """
    target = min_partitions or scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() < target:
        return scan.repartition(target)
    return scan
