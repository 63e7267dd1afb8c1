"""Registration of queries: a name, a plan builder and, where SQL can express it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from amalgam.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of a directory as attributes."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.directory, name)


def query(oracle: str | None = None):
    """Register a function of :class:`Tables` under its name."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, directory: build(Tables(spark, directory))
        if oracle:
            ORACLES[build.__name__] = oracle
        return build

    return register
