"""Sinks: parquet with a fixed codec, text sidecars, and safe replacement."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", partitions: list[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """A tab-separated sidecar; arrays, maps and structs as JSON."""
    from pyspark.sql import functions as F

    plain = [F.to_json(c).alias(c) if t.split("<")[0] in ("array", "map", "struct") else F.col(c) for c, t in df.dtypes]
    df.select(*plain).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def replace_parquet(df: DataFrame, path: str) -> None:
    """Write beside ``path`` and swap, so that ``df`` may read from it."""
    context = df.sparkSession.sparkContext
    new, old = (context._jvm.org.apache.hadoop.fs.Path(f"{path}.{k}-{uuid.uuid4().hex[:8]}") for k in ("new", "old"))
    here = context._jvm.org.apache.hadoop.fs.Path(path)
    files = here.getFileSystem(context._jsc.hadoopConfiguration())
    write_parquet(df, str(new.toString()))
    if files.exists(here):
        files.rename(here, old)
    files.rename(new, here)
    files.delete(old, True)
