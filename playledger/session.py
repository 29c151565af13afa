"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "playledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; `conf` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: weeks start on Sunday 00:00 UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder the cluster names; `fallback` only where none is set."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get(CHECKPOINT_CONF, None) or fallback
    if not folder:
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set and no fallback was given")
    context.setCheckpointDir(folder)
    return folder
