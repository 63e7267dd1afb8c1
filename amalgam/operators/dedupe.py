"""Merging of duplicate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amalgam.functions.arrays import distinct, flattened
from amalgam.functions.keys import first_by


def filled(columns: list[str]) -> Column:
    """How many of the columns are not null."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNotNull().cast("int")
    return total


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """(key, n) of keys with several rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def merge_duplicates(df: DataFrame, key: str, quality: list[str], tie: list[Column], maxima: list[str] = ()) -> DataFrame:
    """One row for each key: the one with most ``quality`` columns filled, then by ``tie``; ``maxima`` take the group's maximum."""
    group = Window.partitionBy(key)
    wide = df.withColumns({c: F.max(c).over(group) for c in maxima}) if maxima else df
    return first_by(wide, [key], [filled(quality).desc(), *tie])


def mode_by(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, value): the most frequent value that is not null, the smallest of equals."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count(F.lit(1)).alias("__n"))
    return counts.groupBy(*key).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(value))


def dedupe_accepted(df: DataFrame, group: list[str], key: str, modes: list[str] = (), unions: list[str] = ()) -> DataFrame:
    """Leave one accepted row in each group and give it what the others know.

    The winner has most accepted_by, fewest considered_synonym (null counts as
    none), the earliest year and the least key. Its nulls in ``modes`` are
    filled by the group's most frequent value (least of equals), its arrays in
    ``unions`` by the union; the others are no longer accepted.
    """
    rivals = df.filter("accepted")
    order = Window.partitionBy(*group).orderBy(
        F.coalesce(F.size("accepted_by"), F.lit(0)).desc(), F.coalesce(F.size("considered_synonym"), F.lit(0)), F.col("year").asc_nulls_last(), F.col(key)
    )
    place = rivals.select(key, F.row_number().over(order).alias("__place"))
    known = rivals.groupBy(*group).agg(
        F.count(F.lit(1)).alias("__n"), *[distinct(flattened(F.collect_list(F.struct(F.col(c)))[c])).alias(f"__{c}") for c in unions]
    ).filter("__n > 1")
    for c in modes:
        known = known.join(mode_by(rivals, group, c).withColumnRenamed(c, f"__{c}"), group, "left")
    out = df.join(place, key, "left").join(known, group, "left")
    won = (F.col("__place") == 1) & F.col("__n").isNotNull()
    changes = {c: F.when(won, F.coalesce(F.col(c), F.col(f"__{c}"))).otherwise(F.col(c)) for c in modes}
    changes |= {c: F.when(won, F.col(f"__{c}")).otherwise(F.col(c)) for c in unions}
    changes["accepted"] = F.col("accepted") & F.coalesce(F.col("__place") == 1, F.lit(False))
    return out.withColumns(changes).select(*df.columns)
