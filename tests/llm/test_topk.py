import math
import random

import numpy as np
import pyarrow as pa
import pytest

from amalgam.llm import queries, topk


def brute(rows, every=50, k=5):
    good = {i: [math.floor(256 * float(x)) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, a in good.items():
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good.items() if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(found, 1)}
    return out


def make(seed, n, dims=8, scale=1.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        length = rng.choice([0.01, 1, 1, 3])
        rows.append((i, [float(np.float32(rng.gauss(0, 1) * length * scale)) for _ in range(dims)]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(topk, "RANGE_BYTES", 150 * 64)
    monkeypatch.setattr(topk, "QUERY_BYTES", 4 * 64)
    monkeypatch.setattr(topk, "PILOT", 20)
    rows = make(seed, 600)
    rows += [(1000, None), (1050, [float("nan")] * 8), (1100, [None] * 8), (1150, rows[3][1]), (1151, rows[3][1]), (1152, rows[3][1]), (None, rows[4][1]), (1200, [1.0, 2.0]), (1250, [0.0] * 8), (1300, [])]
    spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {tuple(r) for r in queries.op10_topk(spark, str(tmp_path)).collect()}
    assert got == brute(rows)


def test_pruning_changes_nothing():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 16)) * 200
    vectors = np.floor(centres[rng.integers(0, 5, 3000)] + rng.normal(size=(3000, 16)) * 15).astype(np.int64)
    vectors *= rng.choice([1, 1, 2, 5], size=(3000, 1))
    ids = rng.permutation(3000)
    old = topk.BUCKET
    topk.BUCKET = 100
    try:
        found = topk.Search(ids[:40], vectors[:40], 5)
        found.run(ids, vectors)
    finally:
        topk.BUCKET = old
    assert found.pruned > found.verified
    scores = vectors[:40] @ vectors.T
    for q in range(40):
        others = np.flatnonzero(ids != ids[q])
        order = others[np.lexsort((ids[others], -scores[q, others]))][:5]
        assert found.best[q][0].tolist() == ids[order].tolist() and found.best[q][1].tolist() == scores[q, order].tolist()


def test_exact_beyond_floats():
    a = np.array([[2**30, 1], [-(2**30), 3]])
    assert topk.products(a, a).tolist() == [[int(x) * int(y) + int(u) * int(v) for y, v in a.tolist()] for x, u in a.tolist()]


def test_matrix_of_uneven_rows():
    lists = pa.chunked_array([pa.array([[9], [1, 2], [], [3]], pa.list_(pa.int64())).slice(1), pa.array([[4, 5]], pa.list_(pa.int64()))])
    assert topk._matrix(lists, 2).tolist() == [[1, 2], [0, 0], [3, 0], [4, 5]]


def test_wide_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=3000)]) for i in range(120)]
    found = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), topk.F.col("id") % 50 == 0)
    assert {tuple(r) for r in found.collect()} == brute(rows)


def test_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    found = topk.search(frame, topk.F.col("id") % 50 == 0)
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.search(frame.limit(0), topk.F.col("id") % 50 == 0).count() == 0
