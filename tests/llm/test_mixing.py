import math
import random

import pytest

from amalgam.llm import mixing, queries


def shares(sizes):
    """{source: size} -> {source: target}, by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    done, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in done]
        left = total - sum(done.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return done | share
        done |= {s: 3 * sizes[s] for s in over}


def make(rng, n, sources):
    rows = []
    for i in range(n):
        k = int(rng.lognormvariate(3, 1.2))
        s = sources[0] if rng.random() < 0.4 else rng.choice(sources)
        rows.append((i, None if rng.random() < 0.02 else " \t".join(["é"] * k), s))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = make(rng, 900, ["b", "a", "￿", "\U0001f600", None, "tiny"])
    rows = [r for r in rows if r[2] != "tiny"] + [(2000, "one two", "tiny"), (2001, "", "void"), (None, "a b c", "a"), (7, rows[7][1], rows[7][2])]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op3_mixing(spark, str(tmp_path)).collect()
    again = queries.op3_mixing(spark, str(tmp_path)).collect()
    order = lambda rs: sorted(map(str, rs))
    assert order(got) == order(again) and len(got) == len(rows)
    words = {}
    for _, t, s in rows:
        words[s] = words.get(s, 0) + len((t or "").split())
    want = shares(words)
    by_id = {d: s for d, _, s in rows}
    taken = {}
    for r in got:
        s = by_id[r.doc_id]
        assert r.source_size == words[s] and math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in taken.items():
        assert abs(t - want[s]) <= 3, (s, t, want[s])


def test_tilts_solve_the_constraints(spark):
    rows = [("a", s, c) for s, c in ((1, 5), (4, 7), (30, 2), (200, 1))] + [("b", 3, 4)]
    targets = spark.createDataFrame([("a", 293, 500.0), ("b", 12, 36.0)], "key string, source_size long, target double")
    got = {r.key: r for r in mixing.tilts(spark.createDataFrame(rows, "key string, size long, rows long"), targets).collect()}
    total = sum(c * s * min(3, math.exp(got["a"].lam * s / got["a"].mean)) for k, s, c in rows if k == "a")
    assert math.isclose(total, 500, rel_tol=1e-8)
    assert math.isclose(min(3, math.exp(got["b"].lam * 3 / got["b"].mean)), 3, rel_tol=1e-6)


def copies_by_hand(rows, targets):
    """{(id, text): copies}: bisection for the tilt, then error diffusion from long to short documents."""
    out = {}
    for s, target in targets.items():
        own = sorted({(d, len((t or "").split())) for d, t, x in rows if x == s}, key=lambda r: (-r[1], r[0]))
        times = {k: sum(1 for d, t, x in rows if x == s and (d, len((t or "").split())) == k) for k in own}
        total = sum(n * times[d, n] for d, n in own)
        if not total:
            out |= dict.fromkeys(((d, n, s) for d, n in own), 0)
            continue
        mean = total / sum(c for (d, n), c in times.items() if n)
        rate = lambda lam, n: min(3.0, math.exp(min(lam * n / mean, 9))) if n else 0.0
        low, high = -500.0, 500.0
        for _ in range(200):
            lam = (low + high) / 2
            low, high = (lam, high) if sum(rate(lam, n) * n * times[d, n] for d, n in own) < target else (low, lam)
        missed = 0.0
        for d, n in own:
            want, whole = rate(lam, n) * n * times[d, n], n * times[d, n]
            c = min(3, max(0, round((missed + want) / whole))) if whole else 0
            if not whole or abs((missed + want) / whole % 1 - 0.5) > 1e-6:  # else either is right
                out[d, n, s] = c
            missed += want - whole * c
    return out


def test_copies_by_hand(spark):
    rng = random.Random(11)
    rows = make(rng, 400, ["b", "a", None]) + [(900 + i, "x y z", "tiny") for i in range(3)]
    rows += [(7, "w " * 33, "b"), (7, "w " * 33, "b")]
    words = {}
    for _, t, s in rows:
        words[s] = words.get(s, 0) + len((t or "").split())
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    got, want = {(r.id, r.size, r.key[1:] or None): r.copies for r in found}, copies_by_hand(rows, shares(words))
    assert len(want) >= len(got) - 3 and {k: got[k] for k in want} == want


def test_hidden_names_and_ids_that_repeat(spark):
    rows = [(1, "a b c", "s", "k1", 5), (1, "d e f", "s", "k2", 5), (None, "g h", "s", "k3", 5), (None, None, None, "k4", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mixed_key string, __k int")
    found = mixing.mix_documents(docs)
    assert found.columns == docs.columns
    assert {r.mixed_key for r in found.collect()} == {"k1", "k2", "k3"}


def test_no_convergence_is_said(spark):
    rows = spark.createDataFrame([("a", 5, 3), ("a", 9, 1)], "key string, size long, rows long")
    targets = spark.createDataFrame([("a", 24, 31.0)], "key string, source_size long, target double")
    with pytest.raises(RuntimeError):
        mixing.tilts(rows, targets, rounds=1)


def test_documents_are_repeated_with_all_columns(spark):
    rows = [(i, "w " * (1 + i % 7), "s" if i % 3 else None, "x") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    copies = {r.id: r.copies for r in mixing.mix(docs).collect()}
    found = mixing.mix_documents(docs)
    assert found.columns == docs.columns
    seen = {}
    for r in found.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0
    nothing = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.copies) for r in mixing.mix(nothing).collect()] == [(0, 0.0, 0)]
