import hashlib
import random

import numpy as np
import pytest
import xxhash

from amalgam.llm import queries, winnow


def brute(text, k, w):
    text = text or ""
    if not text:
        return []
    k = min(k, len(text))
    hs = []
    for i in range(len(text) - k + 1):
        v = 0
        for c in text[i : i + k]:
            v = (v * winnow._BASE + ord(c) + 1) % 2**64
        v ^= v >> 32
        v = v * 0xD6E8FEB86659FD93 % 2**64
        hs.append(v ^ v >> 29)
    w = min(w, len(hs))
    at = set()
    for i in range(len(hs) - w + 1):
        least = min(hs[i : i + w])
        at.add(max(j for j in range(i, i + w) if hs[j] == least))
    return [(hs[j], j) for j in sorted(at)]


@pytest.mark.parametrize(("k", "w"), [(1, 1), (3, 4), (5, 8), (24, 41), (7, 3)])
def test_matches_definition(k, w):
    rng = random.Random(k * w)
    for n in (0, 1, 2, 5, 23, 24, 25, 64, 65, 300):
        for letters in ("ab", "abcdefgh é日\U0001f600", "a"):
            text = "".join(rng.choice(letters) for _ in range(n))
            h, p = winnow.winnow(text, k, w)
            assert list(zip(h.tolist(), p.tolist(), strict=True)) == brute(text, k, w)


def test_guarantee():
    rng = random.Random(7)
    for _ in range(50):
        shared = "".join(rng.choice("abcdef ") for _ in range(winnow.K + winnow.WINDOW - 1))
        a, b = ("".join(rng.choice("ghijk") for _ in range(rng.randrange(90))) for _ in "ab")
        ha, pa_ = winnow.winnow(a + shared + b)
        hb, pb = winnow.winnow(b + shared + a)
        common = set(ha.tolist()) & set(hb.tolist())
        where = {(p - len(a)) for h, p in zip(ha.tolist(), pa_, strict=True) if h in common}
        assert where & {(p - len(b)) for h, p in zip(hb.tolist(), pb, strict=True) if h in common}


def expected(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, np.uint64(xxhash.xxh64_intdigest(r[1], 42)).astype(np.int64), r[1]))
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        own, changed, other = (set(h for h, _ in brute(x, winnow.K, winnow.WINDOW)) for x in (t, edited, nxt))
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        yield (d, len(t), hashlib.sha256(edited.encode()).hexdigest(), like(own, changed), like(own, other))


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_brute_force(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i * 3, "".join(rng.choice("abc de") for _ in range(rng.choice([0, 1, 3, 4, 60, 200, 500])))) for i in range(60)]
    rows += [(1000, None), (1001, rows[5][1]), (1002, rows[5][1]), (None, "no id here"), (9, rows[3][1]), (9, rows[3][1]), (9, "another text of an id that is taken"), (None, "none either")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op1_winnowing(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:3]))
    want = sorted(expected(rows), key=key)
    have = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=key)
    assert have == want
    by_text = {}
    for r in got:
        for d, t in rows:
            if d == r.doc_id and len({u for e, u in rows if e == d}) == 1:
                by_text.setdefault(t or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_one_and_none(spark):
    one = spark.createDataFrame([(5, "short", 1)], "doc_id long, text string, n_chars int")
    row = winnow.compare_with_next(one).collect()
    assert [(r.id, r.n_chars, r.near_next) for r in row] == [(5, 5, 1.0)]
    assert winnow.compare_with_next(one.limit(0)).count() == 0
    found = winnow.fingerprints(one).first()
    assert np.array(found.hashes, np.int64).view(np.uint64).tolist() == [h for h, _ in brute("short", 24, 41)]
