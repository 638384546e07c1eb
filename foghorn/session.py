"""Session construction, checkpoints and the scale guards used across the package."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

# A side is broadcast only after its rows, and the bytes of its texts, have been checked against these.
BROADCAST_ROW_LIMIT = 200_000
BROADCAST_BYTE_LIMIT = 32 << 20


def build_session(app: str = "foghorn", cpus: str | int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and benches; on a cluster pass the session in."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder: the cluster's own, or a scratch one in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="foghorn-ckpt-")
    sc.setCheckpointDir(shared)
    return shared


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back.

    Used where two consumers must see the very same physical partitions, or
    where a loop would otherwise grow the lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Use every core on an input that has fewer splits than the session has cores.

    For per-row work that costs far more than moving the row once. Inputs with
    at least one split per core, which is every large one, are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
