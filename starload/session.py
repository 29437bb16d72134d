"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results, not speed.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # A repeated key inside one JSON object: the last one wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# What a large cluster should run with; AQE sizes, coalesces and splits partitions from there.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def settle(spark: SparkSession) -> SparkSession:
    """Set the settings results depend on; safe to call on any session, any number of times."""
    for name, value in RESULT_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = 8, app: str = "starload", **conf: str) -> SparkSession:
    """Single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        # Python call sites in error messages cost more than planning does on small data.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in (RESULT_SETTINGS | conf).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return settle(spark)


def apply_cluster_settings(spark: SparkSession) -> SparkSession:
    """What a large cluster should run with; a setting the session was started with is kept."""
    started = spark.sparkContext.getConf()
    for name, value in CLUSTER_SETTINGS.items():
        if not started.contains(name):
            spark.conf.set(name, value)
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder: a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch_root(spark: SparkSession) -> str:
    """A new folder under the shared folder the cluster names; a local one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/starload-{uuid.uuid4().hex}"
