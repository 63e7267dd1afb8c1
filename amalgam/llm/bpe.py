"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is split by a pattern; each match is encoded by itself, so the tokens
of a document are the concatenation of its matches' tokens. Within a match the
encoding is a tree reduction: halves are encoded on their own (down to leaves
of ``LEAF`` bytes, merged directly), and two neighbours are joined by
re-encoding a window of bytes around their boundary. The window starts with
one token on either side and doubles on a side until the tokens outside are
proven stable: a token sequence is the encoding of its bytes exactly if every
adjacent pair of it is the encoding of that pair's bytes, so it is enough that
the two pairs at the window's edges encode to themselves. This needs a
vocabulary in which every token encodes to itself, which :func:`vocabulary`
checks. Decoding is concatenation, which is associative: runs of ids become
bytes and neighbouring byte strings are concatenated up a tree likewise.

Defined results: a null text encodes like an empty one, to no tokens; equal
rows give equal results; an empty table gives no rows; texts of any length are
encoded whole; other columns are ignored.
"""

from __future__ import annotations

import base64
import gc
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgam.llm.common import map_arrow, remembers

LEAF = 6
#: Bytes that a Python worker's memory of matches, leaves and pairs takes each, about, and the longest match (in characters) it remembers.
MEMO_BYTES, MEMO_CHARS = 96 << 20, 64
#: Bytes of a remembered entry besides its key's and its ids' (objects, table slots).
ENTRY = 240
#: Token ids that become bytes at once in decoding.
RUN = 256
_NONE = 1 << 62


class Vocabulary:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.memo = _Memo(self._match)
        self._leaves = _Memo(self.merge)
        self._windows = _Memo(lambda pair: self.merge(self.tokens[pair[0]] + self.tokens[pair[1]]))

    def merge(self, data: bytes) -> list[int]:
        """The encoding of ``data`` by direct merging: least rank first, leftmost of equals."""
        if len(data) > 512:
            return self._merge_long(data)
        get, at = self.ranks.get, list(range(len(data) + 1))
        pair = [get(data[i : i + 2], _NONE) for i in range(len(data) - 1)]
        while pair and (least := min(pair)) != _NONE:
            k = pair.index(least)
            del at[k + 1], pair[k]
            if k:
                pair[k - 1] = get(data[at[k - 1] : at[k + 1]], _NONE)
            if k < len(pair):
                pair[k] = get(data[at[k] : at[k + 2]], _NONE)
        return [self.ranks[data[a:b]] for a, b in zip(at, at[1:], strict=False)]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap and links between starts of tokens."""
        n, get = len(data), self.ranks.get
        after, before = list(range(1, n + 2)), list(range(-1, n))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or after[after[i]] != end:
                continue
            gone = after[i]
            alive[gone] = False
            after[i] = end
            if end < n:
                before[end] = i
                if (r := get(data[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if i and (r := get(data[before[i] : end])) is not None:
                heapq.heappush(heap, (r, before[i], end))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : after[i]]])
            i = after[i]
        return out

    def window(self, a: int, b: int) -> list[int]:
        """The encoding of the bytes of two tokens; it is ``[a, b]`` exactly if the pair is stable."""
        return self._windows[a, b]

    def stable(self, a: int, b: int) -> bool:
        return self.window(a, b) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenated bytes of two encodings."""
        if not left or not right:
            return left or right
        i = j = 1
        window = self.window(left[-1], right[0])
        while True:
            ok_left = i == len(left) or self.stable(left[-i - 1], window[0])
            ok_right = j == len(right) or self.stable(window[-1], right[j])
            if ok_left and ok_right:
                return left[: len(left) - i] + window + right[j:]
            i, j = min(i if ok_left else 2 * i, len(left)), min(j if ok_right else 2 * j, len(right))
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[len(left) - i :] + right[:j])))

    def piece(self, data: bytes) -> list[int]:
        """The encoding of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        parts = [self._leaves[data[i : i + LEAF]] for i in range(0, len(data), LEAF)]
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def _match(self, match: str) -> tuple[int, ...]:
        return tuple(self.piece(match.encode()))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, self.split(text))))

    def decode(self, ids) -> bytes:
        parts = [b"".join(map(self.tokens.__getitem__, ids[i : i + RUN])) for i in range(0, len(ids), RUN)]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


class _Memo(dict):
    """Remembers results of a function of short keys in about ``MEMO_BYTES``; forgets all when these are full."""

    def __init__(self, of):
        self.of, self.held = of, 0

    def __missing__(self, key):
        found = self.of(key)
        if len(key) <= MEMO_CHARS:
            self.held += ENTRY + len(key) + 8 * len(found)
            if self.held > MEMO_BYTES:
                self.forget()
            self[key] = found
        return found

    def forget(self) -> None:
        self.clear()
        self.held = 0


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read ``path``: lines of a base64 token and its rank. Every byte must be a token and every token encode to itself."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    found = Vocabulary(ranks, pattern)
    if any(bytes([i]) not in ranks for i in range(256)) or any(found.merge(k) != [v] for k, v in ranks.items()):
        raise ValueError(f"{path}: not a byte-level BPE vocabulary whose tokens encode to themselves")
    return found


def _forget() -> None:
    if vocabulary.cache_info().currsize:
        vocabulary.cache_clear()
        gc.collect()  # a vocabulary and its memories refer to each other


remembers(__name__, _forget)


def _lists(each: list[list[int]]) -> pa.ListArray:
    at = np.zeros(len(each) + 1, np.int32)
    np.cumsum([len(x) for x in each], out=at[1:])
    values = np.fromiter(chain.from_iterable(each), np.int32, int(at[-1]))
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every whole text."""

    def batch(part: pa.RecordBatch) -> dict:
        v = vocabulary(path, pattern)
        return {"id": part.column(0), "ids": _lists([v.encode(x or "") for x in part.column(1).to_pylist()])}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, batch, "id long, ids array<int>", by="text")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes): the bytes that token ids stand for; null ids give no bytes."""

    def batch(part: pa.RecordBatch) -> dict:
        v = vocabulary(path, pattern)
        return {"id": part.column(0), "bytes": pa.array([v.decode(x or ()) for x in part.column(1).to_pylist()], pa.binary())}

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return map_arrow(rows, batch, "id long, bytes binary", by="ids")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, bytes): encode and decode in one pass over the texts."""

    def batch(part: pa.RecordBatch) -> dict:
        v = vocabulary(path, pattern)
        each = [v.encode(x or "") for x in part.column(1).to_pylist()]
        return {"id": part.column(0), "ids": _lists(each), "bytes": pa.array(map(v.decode, each), pa.binary())}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, batch, "id long, ids array<int>, bytes binary", by="text")
