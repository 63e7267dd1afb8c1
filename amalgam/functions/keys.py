"""Deterministic identifiers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def uuid5(name: Column, namespace: uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """The version 5 UUID of a text in a namespace, as text; equal to Python's ``uuid.uuid5``."""
    raw = F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8"))
    h = F.sha1(raw)
    variant = F.lower(F.conv((F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)).cast("string"), 10, 16))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )


def name_key(*parts: Column) -> Column:
    """Lower-cased parts joined by colons, null parts left out."""
    return F.lower(F.concat_ws(":", *parts))


def bucket(value: Column, n: int) -> Column:
    """A stable bucket from 0 to n - 1."""
    return F.pmod(F.xxhash64(value), F.lit(n)).cast("int")


def first_by(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first by ``order``, which must be total."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")
