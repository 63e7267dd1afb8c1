"""Document fingerprints by winnowing.

A text's k-grams (``K`` code points) are hashed with a rolling polynomial; of
every ``WINDOW`` neighbouring hashes the least is kept, the rightmost of equals,
with its position. Two texts that share ``K + WINDOW - 1`` code points in a row
share a fingerprint with the matching positions; nothing shorter than ``K`` is
ever matched.

Defined results: a null text counts as empty and has an empty fingerprint; a
text shorter than ``K`` is one gram, one with fewer grams than ``WINDOW`` is one
window; two empty fingerprints are alike with likeness 1. Documents follow each
other by ascending id, null first, equal ids by the hash of their text (then by
the text); the last is followed by the first, a single document by itself. Repeated rows are separate documents.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amalgam.llm.common import ceil_div, cut, map_arrow, slices, small_batches

K, WINDOW = 24, 41
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all windows of ``k`` codes, modulo 2^64, then mixed."""
    value, length = codes.astype(np.uint64) + np.uint64(1), 1
    total, done = None, 0
    rest = k
    # k = sum of powers of two: windows of doubled length are joined from left to right
    while rest:
        if rest & 1:
            if total is None:
                total, done = value, length
            else:
                power = np.uint64(pow(_BASE, done, 1 << 64))
                tail = total[length:]
                total, done = value[: len(tail)] * power + tail, done + length
        rest >>= 1
        if rest:
            power = np.uint64(pow(_BASE, length, 1 << 64))
            value, length = value[: len(value) - length] * power + value[length:], 2 * length
    total = total ^ (total >> np.uint64(32))
    total = total * np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(29))


def window_minima(values: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least value of every window, the rightmost of equals, without repeats."""
    window = min(window, len(values))
    least, at, size = values, np.arange(len(values)), 1

    def join(step: int) -> tuple[np.ndarray, np.ndarray]:
        left, right = least[:-step], least[step:]
        later = right <= left
        return np.where(later, right, left), np.where(later, at[step:], at[:-step])

    while 2 * size <= window:
        least, at = join(size)
        size *= 2
    if size < window:
        least, at = join(window - size)
    return at[np.append(True, at[1:] != at[:-1])]


def winnow(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the fingerprint of one text."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        hashes = gram_hashes(codes, min(k, len(codes)))
    at = window_minima(hashes, window)
    return hashes[at], at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared over all distinct hashes of two fingerprints; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    both = len(a) + len(b)
    if not both:
        return 1.0
    shared = both - len(np.unique(np.concatenate((a, b))))
    return shared / (both - shared)


def digest(print_: tuple[np.ndarray, np.ndarray]) -> str:
    """A fingerprint's hashes and positions as one string, equal for equal fingerprints only."""
    return hashlib.sha256(print_[0].astype("<u8").tobytes() + print_[1].astype("<i8").tobytes()).hexdigest()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """(id, hashes, positions): the kept hashes (as signed numbers) of every whole text."""

    def batch(part: pa.RecordBatch) -> dict:
        found = [winnow(x, k, window) for x in part.column(1).to_pylist()]
        at = pa.array(np.cumsum([0, *(len(h) for h, _ in found)]), pa.int32())
        both = [np.concatenate([f[i] for f in found]).view(np.int64) for i in (0, 1)]
        return {"id": part.column(0), "hashes": pa.ListArray.from_arrays(at, both[0]), "positions": pa.ListArray.from_arrays(at, both[1])}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, batch, "id long, hashes array<long>, positions array<long>", by="text")


_RESULT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_hashes long, n_edited long"


class _Compared:
    """Collects the result columns of documents that are compared with the next one."""

    def __init__(self, k: int, window: int):
        self.k, self.window, self.rows = k, window, []

    def prints(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return winnow(text, self.k, self.window)

    def add(self, id_, text: str, own, following: str, next_print) -> None:
        tail = len(text) // 4
        edited = text[: len(text) - tail] + following[:tail]
        changed = self.prints(edited)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        self.rows.append((id_, len(text), sha, digest(own), digest(changed), likeness(own[0], changed[0]), likeness(own[0], next_print[0]), len(own[0]), len(changed[0])))

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW, rows_per_task: int = 20_000) -> DataFrame:
    """Fingerprints of every text and of its edited text, compared with it and with the next document.

    One range shuffle orders the documents; each task walks its range and
    keeps one document in hand. Only the first and the last text of each range
    travel again, to be compared across the borders: every last text is joined
    with the first one of the next range, so that no task gathers them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(100_000, ceil_div(docs.count(), rows_per_task)))
    names = [x.split()[0] for x in _RESULT.split(", ")]
    types = pa.schema([(n, pa.int64() if t == "long" else pa.float64() if t == "double" else pa.string()) for n, t in (x.split() for x in _RESULT.split(", "))])
    edge_names = ["first_text", "last_text"]
    edges = pa.schema([*types, *((n, pa.string()) for n in edge_names)])

    def table(found: list[tuple]) -> pa.RecordBatch:
        width = len(found[0]) if found else len(types)
        columns = list(zip(*found, strict=True)) if found else [()] * width
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types if width == len(types) else edges, strict=False)], schema=types if width == len(types) else edges)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first, held = _Compared(k, window), None, None
        for part in slices(batches, "text"):
            for id_, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                own = out.prints(text)
                if held is None:
                    first = text
                else:
                    out.add(*held, text, own)
                held = (id_, text, own)
            if out.rows:
                yield table([(*r, None, None) for r in out.take()])
        if held is not None:
            yield table([(held[0], *[None] * (len(names) - 1), first, held[1])])

    def border(part: pa.RecordBatch) -> dict:
        out = _Compared(k, window)
        for id_, text, following in zip(*(c.to_pylist() for c in part.columns), strict=True):
            out.add(id_, text, out.prints(text), following, out.prints(following))
        return dict(zip(names, zip(*out.take(), strict=True), strict=True)) if part.num_rows else None

    ordered = rows.repartitionByRange(tasks, "id", "hash").sortWithinPartitions("id", "hash", "text").select("id", "text")
    done = cut(small_batches(ordered).mapInArrow(walk, f"{_RESULT}, first_text string, last_text string").withColumn("task", F.spark_partition_id()))
    borders = done.filter("last_text is not null")
    by_task = Window.orderBy("task")  # one number a task, no texts
    whole = by_task.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = borders.select("task", F.coalesce(F.lead("task").over(by_task), F.first("task").over(whole)).alias("next"))
    firsts = borders.select(F.col("task").alias("next"), F.col("first_text").alias("following"))
    last = borders.select("task", "id", F.col("last_text").alias("text")).join(follows, "task").join(firsts, "next").select("id", "text", "following")
    return done.filter("last_text is null").select(*names).unionAll(map_arrow(last, border, _RESULT, by="text"))
