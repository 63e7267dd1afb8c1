"""SparkSession factory and small session helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "amalgam", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every plan of this library assumes.

    AQE is on, the session zone is UTC, and ``master`` falls back to what
    spark-submit configured. Extra ``conf`` entries use ``__`` for dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
    }
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one only where none is configured and driver and executors are one process."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(configured or os.path.join(tempfile.gettempdir(), "amalgam-checkpoints"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage.

    Used between the rounds of iterative operators. The files survive lost
    executors, unlike a local checkpoint; with
    spark.cleaner.referenceTracking.cleanCheckpoints, as :func:`build_session`
    sets it, they go when nothing refers to them any more.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``directory``."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
