"""Incremental upserts of a keyed parquet table, in batch or from a stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgam.functions.keys import first_by
from amalgam.operators.joins import upsert

POINTER = "CURRENT.json"


class RollingTable:
    """Versions of a table in numbered folders and a pointer to the current one; a version is never written over."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        if not self._fs.exists(self._path(f"{self.path}/{POINTER}")):
            return 0
        return json.loads("\n".join(r.value for r in self.spark.read.text(f"{self.path}/{POINTER}").collect()))["version"]

    def read(self) -> DataFrame | None:
        v = self.version()
        return self.spark.read.parquet(f"{self.path}/v{v}") if v else None

    def write(self, df: DataFrame) -> int:
        v = self.version() + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{v}")
        out = self._fs.create(self._path(f"{self.path}/{POINTER}"), True)
        out.write(bytearray(json.dumps({"version": v}).encode()))
        out.close()
        return v

    def apply(self, delta: DataFrame, key: str, order: str) -> int:
        """Upsert the last row of each key by ``order``."""
        latest = first_by(delta, [key], [F.col(order).desc_nulls_last(), F.xxhash64(*delta.columns)])
        base = self.read()
        return self.write(latest if base is None else upsert(base, latest, key))

    def follow(self, stream: DataFrame, key: str, order: str, checkpoint: str):
        """A started streaming query that upserts every micro-batch once the trigger fires."""
        return stream.writeStream.foreachBatch(lambda df, _: self.apply(df, key, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, kind: str, value: str, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts and sums by window and kind; rows later than ``late`` are dropped in a stream."""
    window = F.window(F.col(ts), width)
    return events.withWatermark(ts, late).groupBy(window.alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")
