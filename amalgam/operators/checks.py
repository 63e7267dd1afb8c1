"""Sentinel checks: queries that must, or must not, return rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


@dataclass(frozen=True)
class Check:
    """``expect`` is "any" (some row must come) or "none"; ``query`` is SQL or a function of the session."""

    name: str
    query: str | Callable[[SparkSession], DataFrame]
    expect: str
    message: str


def run_checks(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """(name, status, message): passed, failed, or skipped where a column or table is missing."""
    rows = []
    for check in checks:
        try:
            frame = spark.sql(check.query) if isinstance(check.query, str) else check.query(spark)
            found = bool(frame.limit(1).count())
            status = "passed" if found == (check.expect == "any") else "failed"
        except AnalysisException:
            status = "skipped"
        rows.append((check.name, status, None if status == "passed" else check.message))
    return spark.createDataFrame(rows, "name string, status string, message string")


def content_hash(df: DataFrame) -> int:
    """A hash of all rows that does not depend on their order; nulls count by their place."""
    from pyspark.sql import functions as F

    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in df.columns])
    columns = [F.to_json(c) if dict(df.dtypes)[c].startswith("map") else F.col(c) for c in df.columns]
    return int(df.select(F.xxhash64(*columns, nulls).cast("decimal(38,0)").alias("h")).agg(F.sum("h")).first()[0] or 0)
