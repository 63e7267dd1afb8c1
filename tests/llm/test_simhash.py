import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from amalgam.llm import simhash


def brute(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(items):
    """(id, fp) -> least id reachable over distance <= 2, by all pairs."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(items))]


def test_fingerprint_matches_definition():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 7, 60, 9000):
        text = " ".join(rng.choice(["Ab", "ÉTÉ", "the", "x\x0by", "q"]) for _ in range(n))
        assert simhash.simhash(text.encode()) == brute(text)


def test_documents_components(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(400)]
    rows, k = [], 0
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 40, 200]))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            if rng.random() < 0.6:
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((k, " ".join(copy), "x"))
            k += 1
    rows += [(k, None, "x"), (k + 1, "", None), (None, "only here", "x"), (3, rows[3][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {(r.id, r.fp % (1 << 64)): r.component for r in simhash.near_duplicates(docs).collect()}
    items = [(d, brute(t)) for d, t, _ in rows]
    want = {(d, f): c for (d, f), c in zip(items, classes(items), strict=True)}
    assert got == want


def test_crowded_keys_give_the_same_components(spark):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(50)}
    for seed in list(fps)[:3]:
        for _ in range(120):
            fps.add(seed ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    from amalgam.llm.common import components

    want = classes(list(zip(fps, fps, strict=True)))
    sizes = {}
    for w in want:
        sizes[w] = sizes.get(w, 0) + 1
    for cap in (1, 10, 1000):
        got = components(simhash.links(nodes, pairwise=cap)).groupBy("root").count().collect()
        assert sorted(r["count"] for r in got) == sorted(n for n in sizes.values() if n > 1)


def sets_of(text, words=5):
    tokens = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")).split()
    return frozenset(" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))) if tokens else frozenset()


def kept_by_hand(rows, similarity=0.8):
    """The (id, text) that stay: one of each group over all pairs of sets."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    sets, root = [sets_of(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= similarity:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [rows[i] for i in range(len(rows)) if root[i] == i]


def edited(rng, tokens, vocab, times):
    out = list(tokens)
    for _ in range(times):
        out[rng.randrange(len(out))] = rng.choice(vocab)
    return out


def test_keep_one_of_similar_texts(spark, monkeypatch):
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(900)]
    rows, k = [], 0
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 4, 30, 120, 400]))]
        for _ in range(rng.randint(1, 4)):
            rows.append((k, " ".join(edited(rng, base, vocab, rng.randint(0, 3)))))
            k += 1
    hot = [rng.choice(vocab) for _ in range(260)]
    rows += [(k + i, " ".join(edited(rng, hot, vocab, 1 + i % 3))) for i in range(90)]
    rows += [(5000, None), (5001, ""), (None, "without an id"), (None, "without an id either, quite another text"), (3, "a second text of that id"), (7, rows[9][1])]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in [*rows, rows[2], rows[3]]], "doc_id long, text string, cls string, row_key int")
    want = {(d, t) for d, t in kept_by_hand(rows)}
    assert len(want) < len(set(rows)) - 80
    for crowd in (48, 8, 2):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        monkeypatch.setattr(simhash, "MOST_SHINGLES", 0 if crowd == 2 else 2_000_000)
        kept = simhash.keep_one(docs.repartition(5))
        assert kept.columns == docs.columns
        got = kept.collect()
        assert {(r.doc_id, r.text) for r in got} == want and len(got) == len(want)


def test_keep_one_loses_no_link_of_short_texts(spark):
    """Pairs of similarity 0.8 (five shingles, four of them) whose 24 min-wise keys all differ, or whose fingerprints do in over 24 bits."""
    longer = [" ".join([f"w{k}", *(f"x{k + i}" for i in range(8))]) for k in (374903, 888027, 3371, 7352, 9493)]
    rows = [(2 * i + j, t if not j else t.rsplit(" ", 1)[0]) for i, t in enumerate(longer) for j in (0, 1)]
    want = set(kept_by_hand(rows))
    assert len(want) == len(longer)
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in kept} == want and len(kept) == len(want)


def test_pivots_keys_and_bits_discard_no_similar_sets():
    """Of random sets: similar ones pass every step, and the pivot distance table discards nearly all others."""
    rng = np.random.default_rng(4)

    def table(a, b):
        return np.abs(simhash.pivot_row(a).astype(int) - simhash.pivot_row(b)).sum()

    passed = 0
    for turn in range(600):
        n = int(rng.integers(1, 400)) if turn % 50 else 20_000
        a = np.unique(rng.integers(0, 2**64, n, np.uint64))
        less, more = (int(rng.integers(0, n // 8 + 2)) for _ in range(2))
        b = np.unique(np.concatenate([rng.permutation(a)[min(less, len(a) - 1) :], rng.integers(0, 2**64, more, np.uint64)]))
        common = np.sort(rng.permutation(np.union1d(a, b))[: n // 3])
        places = rng.permutation(len(common))
        both = len(np.intersect1d(a, b))
        assert table(a, b) <= len(a) + len(b) - 2 * both
        if both / (len(a) + len(b) - both) >= 0.8:
            passed += 1
            assert np.intersect1d(*(simhash.least_keys(x, common, places, 0.8) for x in (a, b))).size
            firm = simhash.firm_bits(a, 0.8) | simhash.firm_bits(b, 0.8)
            assert not (simhash.majority(a) ^ simhash.majority(b)) & firm
    assert passed > 100
    for n in (5, 20, 100, 400):
        others = [np.unique(rng.integers(0, 2**64, n, np.uint64)) for _ in range(60)]
        left = sum(table(a, b) <= (len(a) + len(b)) / 9 for i, a in enumerate(others) for b in others[:i])
        assert left <= 5, n


def test_single_shingles_in_common_are_no_keys():
    """Sets that share a tenth of their shingles with others hardly ever meet, however many there are; similar ones always do."""
    rng = np.random.default_rng(8)
    pool, none = rng.integers(0, 2**64, 3000, np.uint64), np.zeros(0, np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(pool, n // 10, replace=False), rng.integers(0, 2**64, n - n // 10, np.uint64)])) for n in rng.integers(30, 600, 500)]
    keys = [np.unique(simhash.least_keys(x, none, none.astype(int), 0.8)) for x in sets]
    times = np.unique(np.concatenate(keys), return_counts=True)[1]
    assert (times * (times - 1) // 2).sum() < 50
    for n in [*range(1, 70), 127, 128, 129, 1023, 1024]:
        a = np.unique(rng.integers(0, 2**64, n, np.uint64))
        b = np.unique(np.concatenate([a, rng.integers(0, 2**64, n // 4, np.uint64)]))
        c = a[: -(-4 * n // 5)]
        for x, y in ((a, b), (a, c)):
            assert np.intersect1d(*(simhash.least_keys(z, none, none.astype(int), 0.8) for z in (x, y))).size, n


def test_empty(spark):
    assert simhash.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert simhash.near_duplicates(one).filter(F.col("fp") == 0).count() == 1
