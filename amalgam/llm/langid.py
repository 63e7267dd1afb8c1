"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a random vector of ``DIMS`` signs,
derived from its code point. A trigram's vector binds its letters: the product
of the first letter's vector rotated twice, the second's rotated once and the
third's. A text's vector bundles (sums) those of its trigrams; a language's
prototype bundles all texts of that language. A text is assigned the language
whose prototype has the highest cosine with it.

Training reduces in each task to one vector of whole numbers a language, so
its result does not depend on the order of rows; the number of languages is
checked against ``most_langs``. The prototypes (8 KB each) go to the executors
with the function.

Defined results: null texts and texts without a letter are ``und`` with score
0, and so is every text if nothing could be learned; equal cosines go to the
language that sorts first; a text is used whole; an empty table gives no rows;
rows without an id are predicted but never learned from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgam.llm.common import map_arrow, remembers, slices, small_batches, turn_to

DIMS = 1024
UND = "und"
#: Trigram vectors that a Python worker remembers (1 KB each).
KNOWN = 20_000
_BITS = 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: the code point itself for a letter, else 0."""
    return np.fromiter((c if chr(c).isalpha() else 0 for c in range(0x110000)), np.int64, 0x110000)


@lru_cache(maxsize=20_000)
def _letter(code: int, turns: int) -> np.ndarray:
    """A letter's vector of signs, rotated ``turns`` times."""
    bits = np.frombuffer(hashlib.shake_128(b"letter %d" % code).digest(DIMS // 8), np.uint8)
    return np.roll((np.unpackbits(bits).astype(np.int8) << 1) - 1, turns)


def trigrams(text: str) -> np.ndarray:
    """The trigrams of a text's lower-cased words as numbers; empty if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate(([0], _letters()[codes], [0]))
    inside = codes != 0
    inside[1:] |= inside[:-1]
    if not inside.any():
        return codes[:0]
    codes = np.concatenate(([0], codes[inside]))
    return codes[:-2] << 2 * _BITS | codes[1:-1] << _BITS | codes[2:]


class _Grams:
    """Vectors of the trigrams met so far: sorted keys, the row of each, and the rows."""

    def __init__(self):
        self.rows = np.empty((KNOWN, DIMS), np.int8)
        self.forget()

    def forget(self) -> None:
        self.keys, self.at = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def vectors(self, keys: np.ndarray) -> np.ndarray:
        """int8 rows for sorted distinct ``keys``, ``KNOWN`` at most."""
        place = np.searchsorted(self.keys, keys)
        there = place < len(self.keys)
        there[there] = self.keys[place[there]] == keys[there]
        if not there.all():
            if len(self.keys) + len(keys) - there.sum() > KNOWN:
                self.forget()
                place[:], there[:] = 0, False
            fresh, n = keys[~there], len(self.keys)
            self._bind(fresh, self.rows[n : n + len(fresh)])
            self.keys = np.insert(self.keys, place[~there], fresh)
            self.at = np.insert(self.at, place[~there], np.arange(n, n + len(fresh)))
            place = np.searchsorted(self.keys, keys)
        return self.rows[self.at[place]]

    @staticmethod
    def _bind(keys: np.ndarray, out: np.ndarray) -> None:
        mask = (1 << _BITS) - 1
        for i, k in enumerate(keys.tolist()):
            np.multiply(_letter(k >> 2 * _BITS, 2), _letter(k >> _BITS & mask, 1), out=out[i])
            out[i] *= _letter(k & mask, 0)


@lru_cache(maxsize=1)
def _grams() -> _Grams:
    return _Grams()


def _forget() -> None:
    for known in (_letters, _letter, _grams):
        known.cache_clear()


remembers(__name__, _forget)


def bundle(grams: np.ndarray) -> np.ndarray:
    """The summed vectors of trigrams, repeats included, as whole numbers in float64."""
    keys, counts = np.unique(grams, return_counts=True)
    out = np.zeros(DIMS)
    for at in range(0, len(keys), 2048):
        rows = _grams().vectors(keys[at : at + 2048])
        out += counts[at : at + 2048].astype(np.float32) @ rows.astype(np.float32)
    return out


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", most_langs: int = 1000, reducers: int = 16) -> dict[str, np.ndarray]:
    """Prototype of each language, unit length, from the rows with a language and a text."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to(__name__)
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches, "text"):
            by: dict[str, list] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(trigrams(text))
            for lang, grams in by.items():
                sums[lang] = sums.get(lang, 0) + np.rint(bundle(np.concatenate(grams))).astype(np.int64)
            if len(sums) > most_langs:
                raise ValueError(f"over {most_langs} languages")
        yield packed(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in batches:
            for lang, vector in zip(*(c.to_pylist() for c in part.columns), strict=True):
                sums[lang] = sums.get(lang, 0) + np.frombuffer(vector, np.int64)
        yield packed(sums)

    def packed(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"lang": pa.array(sums, pa.string()), "vector": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    kind = "lang string, vector binary"
    reduced = small_batches(rows).mapInArrow(profile, kind).repartition(reducers).mapInArrow(add, kind)
    total: dict[str, np.ndarray] = {}
    for row in reduced.toLocalIterator():  # `reducers` rows a language at most
        total[row.lang] = total.get(row.lang, 0) + np.frombuffer(row.vector, np.int64)
        if len(total) > most_langs:
            raise ValueError(f"over {most_langs} languages")
    return {k: v / n for k, v in sorted(total.items()) if (n := float(np.linalg.norm(v)))}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): the best language of every text and its cosine, 0 if negative."""
    langs = list(prototypes)
    matrix = np.array([prototypes[x] for x in langs], np.float32).reshape(len(langs), DIMS)

    def one(text: str | None) -> tuple[str, float]:
        grams = trigrams(text) if text else ()
        if not len(grams) or not langs:
            return UND, 0.0
        vector = bundle(grams)
        cosines = matrix @ (vector / max(float(np.linalg.norm(vector)), 1e-9)).astype(np.float32)
        best = int(np.argmax(cosines))
        return langs[best], min(1.0, max(0.0, float(cosines[best])))

    def batch(part: pa.RecordBatch) -> dict:
        found = [one(x) for x in part.column(1).to_pylist()]
        return {"id": part.column(0), "lang_pred": pa.array([x for x, _ in found], pa.string()), "score": pa.array([y for _, y in found], pa.float64())}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, batch, "id long, lang_pred string, score double", by="text")


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    """Whether crc32 of the id as text falls in the fold that is never learned from; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold


def keep_identified(
    docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", least: float = 0.15
) -> DataFrame:
    """The rows of ``docs`` whose language is known; all columns stay.

    A text without a letter is rejected, and one that is surely in none of the
    languages: even with the chance error of a cosine over its n trigrams,
    1 / sqrt(n), added, its best cosine is below ``least``. If nothing was
    learned, only texts without a letter go. Texts are judged row by row, so
    equal ids with different texts are kept or rejected each for itself.
    """
    at = docs.columns.index(text_col)
    matrix = np.array(list(prototypes.values()), np.float32).reshape(len(prototypes), DIMS)

    def known(text: str | None) -> bool:
        grams = trigrams(text) if text else ()
        if not len(grams) or not len(matrix):
            return len(grams) > 0
        vector = bundle(grams)
        cosine = float((matrix @ vector).max()) / max(float(np.linalg.norm(vector)), 1e-9)
        return cosine + len(grams) ** -0.5 >= least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to(__name__)
        for part in slices(batches, text_col):
            kept = [known(x) for x in part.column(at).to_pylist()]
            yield part.filter(pa.array(kept, pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)
