"""Samples that are the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stratified(df: DataFrame, stratum: Column, key: str, each: int, salt: str = "") -> DataFrame:
    """``each`` rows of every stratum, in the order of the md5 of salt and key."""
    order = F.md5(F.concat(F.lit(salt), F.col(key).cast("string")).cast("binary"))
    place = F.row_number().over(Window.partitionBy("stratum").orderBy(order, F.col(key)))
    return df.withColumn("stratum", stratum).withColumn("nth", place).filter(F.col("nth") <= each)


def stale_first(df: DataFrame, checked: str, most: int, key: str, older_than: str | None = None) -> DataFrame:
    """The ``most`` rows checked longest ago, never checked ones first; ties by hash of the key."""
    rows = df.filter(F.col(checked).isNull() | (F.col(checked) < F.expr(older_than))) if older_than else df
    return rows.orderBy(F.col(checked).asc_nulls_first(), F.xxhash64(key), key).limit(most)
