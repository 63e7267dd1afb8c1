"""Helpers shared by the training-data operators."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgam.session import cut, table

__all__ = ["cut", "table", "slices", "map_arrow", "all_of", "components", "free_name", "join_counted", "remembers", "turn_to", "small_batches", "ceil_div", "small"]

#: Bytes of input that one output batch of a Python stage covers at most (one row may be longer).
BATCH_BYTES = 4 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each, one row at least."""
    for batch in batches:
        at, rows = 0, batch.num_rows
        if not rows:
            continue
        per_row = max(1, batch.column(batch.schema.get_field_index(column)).nbytes // rows)
        step = max(1, limit // per_row)
        while at < rows:
            yield batch.slice(at, step)
            at += step
        del batch
        pa.default_memory_pool().release_unused()


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session hands rows to Python in Arrow batches of ``BATCH_BYTES`` at most from now on.

    The default of 10,000 rows or 64 MB takes several times that in the memory
    of the executor, which it keeps. A smaller bound that is set stays.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")
    return df


_FORGET: dict[str, Callable[[], None]] = {}


def remembers(module: str, forget: Callable[[], None]) -> None:
    """Say how what a module keeps between the tasks of a Python worker is freed."""
    _FORGET[module] = forget


def turn_to(module: str) -> None:
    """Free what other modules' tasks left in this Python worker, before a task of ``module``."""
    for name, forget in _FORGET.items():
        if name != module:
            forget()
    pa.default_memory_pool().release_unused()


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str, by: str) -> DataFrame:
    """``mapInArrow`` with small batches; ``fn`` turns a batch into columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to(fn.__module__)
        for part in slices(batches, by):
            out = fn(part)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out)

    return small_batches(df).mapInArrow(run, schema)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.and_, conditions)


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def small(df: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows, which is counted; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


#: A key with more than this share (one in so many) of all rows is hot: there are fewer such keys than this.
HOT_SHARE = 2000


def join_counted(rows: DataFrame, counts: DataFrame, key: str, times: str, total: int) -> DataFrame:
    """``rows`` joined with ``counts``, which has one row for a ``key`` and in ``times`` how many of the ``total`` rows have it.

    Rows of hot keys stay where they are and meet their count by a broadcast of
    fewer than ``HOT_SHARE`` rows; all others are shuffled.
    """
    hot = F.col(times) * HOT_SHARE > total
    few = F.broadcast(counts.filter(hot))
    rest = rows.join(few.select(key), key, "left_anti").join(counts.filter(~hot), key)
    return rows.join(few, key).unionByName(rest)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges ``(a, b)``: rows ``(node, root)``, root the least node.

    Alternates the large-star and small-star contractions, both plain
    aggregations and equi-joins, until the edge set stands still; a node's
    neighbours are never gathered in one place. Nodes without an edge to
    another node do not appear. The rounds grow with the logarithm of the
    longest chain; RuntimeError if ``most_rounds`` were too few.
    """

    def stand(frame: DataFrame) -> tuple:
        row = frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    def centre(frame: DataFrame) -> DataFrame:
        """Each edge (u, v) with the least of u and u's neighbours."""
        least = frame.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return frame.join(least, "u")

    edges = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = stand(edges)
    for _ in range(most_rounds if before[0] else 1):
        if not before[0]:
            break
        both = edges.selectExpr("a as u", "b as v").unionAll(edges.selectExpr("b as u", "a as v"))
        large = centre(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        down = large.selectExpr("a as u", "b as v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u").filter("v != m").selectExpr("v as a", "m as b")
            .unionAll(least.selectExpr("u as a", "m as b")).filter("a != b").distinct()
        )
        edges = cut(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        after = stand(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
