"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are turned into whole numbers (floor of ``SCALE`` times a component).
Candidates are ordered by length into ranges of ``RANGE_BYTES`` and, in a task,
buckets of ``BUCKET`` vectors. A query's k-th best score so far, at first over
the ``PILOT`` longest candidates, divided by its own length is the length that
a candidate needs at least; queries are ordered by it into blocks. The longest
vector of each range and the least need of each block, a number each, tell
which ranges a block has to see: only these travel. Within a task the k-th best
score gives each bucket a local threshold: the cosine that a candidate of its
length needs. A threshold over 1 skips the bucket, and with it all shorter
ones; a high one prunes by the query's strongest coordinate, which confines
that coordinate of a unit candidate to an interval; a low one prunes by length
alone. What is left is verified by whole-number products.

Defined results: a vector that is null or holds a null or non-finite component
takes no part, nor does one without an id; shorter vectors count as padded with
zeros; a query is no candidate of its own id, and rows with an equal id are one
vector's; equal scores go to the smaller id; with fewer candidates than k, all
are returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amalgam.llm.common import ceil_div, cut, small

SCALE = 256.0
BUCKET, PILOT = 2048, 4096
#: Bytes of the candidates of a range and of the queries of a block, as whole numbers of 64 bits.
RANGE_BYTES = QUERY_BYTES = 4 << 20
#: Local cosine threshold from which a bucket is pruned by coordinate.
HIGH = 0.7
#: Relative slack of the float bounds; scores themselves are whole numbers.
SLACK = 1e-9


def quantised(vector: Column, scale: float = SCALE) -> Column:
    """array<bigint> of floor(scale * x); null where the vector takes no part."""
    whole = vector.cast("array<double>")
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & finite, F.transform(whole, lambda x: F.floor(x * scale)))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = lists.offsets.to_numpy().astype(np.int64)
    values, each = lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]], np.diff(at)
    if len(each) and (each == width).all():
        return values.reshape(len(each), width)
    out = np.zeros((len(each), width), np.int64)
    out[np.repeat(np.arange(len(each)), each), np.arange(len(values)) - np.repeat(at[:-1] - at[0], each)] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole-number rows: in floats where they cannot round, else in integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Search:
    """Top k of candidates that arrive in buckets of falling length, for one block of queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, least: np.ndarray | None = None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.least = np.full(len(ids), -np.inf) if least is None else least.astype(np.float64)
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
        #: Products verified and pruned, for tests and reports.
        self.verified = self.pruned = 0

    def bucket(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray) -> None:
        """Search one bucket; ``lengths`` fall."""
        top = lengths[0] * (1 + SLACK)
        open_ = np.flatnonzero(self.lengths * top >= self.least)
        self.pruned += (len(self.ids) - len(open_)) * len(ids)
        if not len(open_):
            return
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(self.least[open_] > 0, self.least[open_] / (self.lengths[open_] * top), -1.0)
        narrow = local >= HIGH
        for q, cosine in zip(open_[narrow].tolist(), local[narrow].tolist(), strict=True):
            self._take(q, ids, vectors, self._coordinate(q, cosine, vectors, lengths))
        wide = open_[~narrow]
        for at in range(0, len(wide), 512):
            some = wide[at : at + 512]
            scores = products(self.vectors[some], vectors)
            self.verified += scores.size
            for q, row in zip(some.tolist(), scores, strict=True):
                self._offer(q, ids, row)

    def _coordinate(self, q: int, cosine: float, vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Candidates whose coordinate along the query's strongest one allows the cosine, and that are long enough."""
        unit = self.vectors[q] / self.lengths[q]
        f = int(np.argmax(np.abs(unit)))
        c, t = float(unit[f]), min(1.0, cosine)
        spread = np.sqrt(max(0.0, 1 - c * c) * max(0.0, 1 - t * t))
        # cos(x, q) >= t bounds the angle, and so x_f, unless the coordinate axis lies within that angle
        low = c * t - spread - SLACK if c > -t else -1.0
        high = c * t + spread + SLACK if c < t else 1.0
        x = vectors[:, f] / np.maximum(lengths, 1e-300)
        return np.flatnonzero((x >= low) & (x <= high) & (lengths * self.lengths[q] * (1 + SLACK) >= self.least[q]))

    def _take(self, q: int, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray) -> None:
        self.pruned += len(ids) - len(rows)
        self.verified += len(rows)
        if len(rows):
            self._offer(q, ids[rows], products(self.vectors[q : q + 1], vectors[rows])[0])

    def _offer(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        good = (scores >= self.least[q]) & (ids != self.ids[q])
        if not good.any():
            return
        ids, scores = ids[good], scores[good]
        if len(scores) > self.k:
            cut_at = np.partition(scores, len(scores) - self.k)[-self.k]
            near = scores >= cut_at
            ids, scores = ids[near], scores[near]
        ids, scores = np.concatenate((self.best[q][0], ids)), np.concatenate((self.best[q][1], scores))
        order = np.lexsort((ids, -scores))[: self.k]
        self.best[q] = ids[order], scores[order]
        if len(order) == self.k:
            self.least[q] = max(self.least[q], scores[order[-1]])

    def run(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        order = np.lexsort((ids, -lengths))
        ids, vectors, lengths = ids[order], vectors[order], lengths[order]
        for at in range(0, len(ids), BUCKET):
            end = at + BUCKET
            self.bucket(ids[at:end], vectors[at:end], lengths[at:end])


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every row that ``is_query`` (of the column ``id``) marks."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v")).filter("id is not null and v is not null")
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = cut(rows.withColumn("square", square))
    n, width, n_queries = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if(is_query)).first()
    width = width or 0
    ranges, blocks = (max(1, ceil_div(count * max(1, width) * 8, limit)) for count, limit in ((n, RANGE_BYTES), (n_queries, QUERY_BYTES)))
    pilot_rows = rows.orderBy(F.desc("square"), "id").limit(PILOT).select("id", "v").toArrow()  # bounded by PILOT
    pilot = pilot_rows.column(0).to_numpy().astype(np.int64), _matrix(pilot_rows.column(1), width)

    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                found = Search(part.column(0).to_numpy(), _matrix(part.column(1), width), k)
                found.run(*pilot)
                # a repeated id would be counted twice here, so the bound takes distinct ids only
                least = [float(s[-1]) if len(s) == k and len(set(i.tolist())) == k else -np.inf for i, s in found.best]
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(np.array(least) > 0, np.array(least) / found.lengths, 0.0)
                yield pa.RecordBatch.from_pydict({"id": part.column(0), "v": part.column(1), "least": pa.array(least, pa.float64()), "need": pa.array(need, pa.float64())})

    asked = rows.filter(is_query).dropDuplicates(["id"]).select("id", "v").repartition(blocks).mapInArrow(thresholds, "id long, v array<long>, least double, need double")
    queries = cut(asked.repartitionByRange(blocks, "need", "id").withColumn("block", F.spark_partition_id()))
    held = cut(rows.dropDuplicates(["id"]).repartitionByRange(ranges, F.desc("square"), "id").withColumn("range", F.spark_partition_id()))
    # a range's longest vector and a block's least need: one number each
    tops = held.groupBy("range").agg((F.sqrt(F.max("square")) * (1 + SLACK)).alias("top"))
    needs = queries.groupBy("block").agg(F.min("need").alias("need"))
    seen = cut(small(tops).join(needs, F.col("top") >= F.col("need")).select("block", "range"))
    pairs = max(1, min(seen.count(), 1 << 16))
    asked_of = queries.join(small(seen), "block").select("block", "range", "id", "v", "least").repartition(pairs, "block", "range")
    held_for = held.join(small(seen), "range").select("block", "range", "id", "v").repartition(pairs, "block", "range")

    def meet(asked_rows: pa.Table, held_rows: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        empty = pa.table([pa.array([], pa.int64())] * 3, names=names)
        if not asked_rows.num_rows or not held_rows.num_rows:
            return empty
        ids = asked_rows.column("id").to_numpy()
        found = Search(ids, _matrix(asked_rows.column("v"), width), k, asked_rows.column("least").to_numpy())
        found.run(held_rows.column("id").to_numpy(), _matrix(held_rows.column("v"), width))
        each = [len(i) for i, _ in found.best]
        return pa.table([np.repeat(ids, each), np.concatenate([i for i, _ in found.best]), np.concatenate([s for _, s in found.best])], names=names)

    local = asked_of.groupBy("block", "range").cogroup(held_for.groupBy("block", "range")).applyInArrow(meet, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return local.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
