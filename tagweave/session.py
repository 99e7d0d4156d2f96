"""Session settings and lineage cutting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session. Skewed lookup joins are split at run time
# even where that costs one more exchange; time arithmetic is done in UTC.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tagweave", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or fetch) a session. Without ``master`` the cluster's own setting is used."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(shared)


def use_checkpoint_dir(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of a session that was configured without one."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None and configured is None:
        context.setCheckpointDir(folder)


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors share."""
    _ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
