import random
import zlib

import pytest

from amalgam.llm import queries, sharding


def test_differencing_classic():
    found = sharding.differencing([[n, 0] for n in (8, 7, 6, 5, 4)], 2)
    sums = [0, 0]
    for n, parts in zip((8, 7, 6, 5, 4), found, strict=True):
        sums[parts[0]] += n
    assert sorted(sums) == [14, 16]


def by_hand(sizes, ways):
    """Spread that differencing leaves: lists of labelled parts, the two of largest spread combined by search each time."""
    left = [(k, sorted([n] + [0] * (ways - 1), reverse=True)) for k, n in enumerate(sizes)]
    n = len(left)
    while len(left) > 1:
        left.sort(key=lambda p: (p[1][-1] - p[1][0], p[0]))
        (_, a), (_, b) = left[:2]
        left[:2] = [(n, sorted((x + y for x, y in zip(a, b[::-1], strict=True)), reverse=True))]
        n += 1
    return left[0][1]


@pytest.mark.parametrize("ways", [2, 3, 7])
def test_differencing_by_hand(ways):
    rng = random.Random(ways)
    for _ in range(20):
        sizes = [rng.randrange(1, 60) for _ in range(rng.randrange(1, 25))]
        sums = [0] * ways
        for n, parts in zip(sizes, sharding.differencing([[n] + [0] * (ways - 1) for n in sizes], ways), strict=True):
            sums[parts[0]] += n
        assert sorted(sums, reverse=True) == by_hand(sizes, ways)


def test_many_rows_of_one_id(spark):
    rows = [(7, "same text")] * 500 + [(None, "t%d" % i) for i in range(200)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 700 and all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("ways", [1, 3, 24])
def test_differencing_is_a_placement(ways):
    rng = random.Random(ways)
    items = [[rng.randrange(1000) for _ in range(ways)] for _ in range(200)]
    found = sharding.differencing(items, ways)
    assert all(sorted(f) == list(range(ways)) for f in found)
    sums = [0] * ways
    for item, f in zip(items, found, strict=True):
        for j, to in enumerate(f):
            sums[to] += item[j]
    assert sum(sums) == sum(map(sum, items)) and max(sums) - min(sums) <= 40


def check(rows, got, ways=24, tight=None):
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(d for d, _ in rows if d is not None)
    sizes, slots, texts = [0] * ways, {}, {}
    by = {}
    for d, t in rows:
        by.setdefault(d, set()).add(t)
    for r in got:
        assert 0 <= r.shard < ways and r.law == "bytes" and r.grown_shard is None
        assert (r["size"], r.text_crc32) in {(len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in by[r.doc_id]}
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        texts.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert tight is None or max(sizes) - min(sizes) <= tight, sizes
    return texts


def test_query(spark, tmp_path):
    rng = random.Random(3)
    texts = ["é" * int(rng.lognormvariate(4, 1)) + str(i) for i in range(1500)]
    rows = [(i, rng.choice(texts) if i % 5 == 0 else texts[i % len(texts)]) for i in range(3000)]
    rows += [(4000, None), (4001, ""), (None, "x"), (3, rows[3][1])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op9_sharding(spark, str(tmp_path)).collect()
    again = queries.op9_sharding(spark, str(tmp_path)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    found = check(rows, got, tight=64)
    assert all(len(s) == 1 for crc, s in found.items() if crc)  # null and empty texts are two groups


def test_levels_and_oversized_group(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    rows = [(i, "copy " * 20 if i % 3 == 0 else "w" * rng.randrange(300)) for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shards(docs, 24, split_over=1.25).collect()
    sizes = [0] * 24
    for r in got:
        sizes[r.shard] += r["size"]
    assert max(sizes) - min(sizes) < 0.05 * sum(sizes) / 24
    whole = sharding.shards(docs, 24).collect()
    copy = zlib.crc32(("copy " * 20).encode())
    hot = {r.shard for r in whole if r.text_crc32 == copy}
    sizes = [0] * 24
    for r in whole:
        sizes[r.shard] += r["size"]
    rest = [n for j, n in enumerate(sizes) if j not in hot]
    assert len(hot) == 1 and len(whole) == len(rows) and max(rest) - min(rest) < 0.05 * sum(rest) / 23
    assert sizes[hot.pop()] == sum(r["size"] for r in whole if r.text_crc32 == copy)
    groups = spark.createDataFrame([(str(i), rng.randrange(1, 5000)) for i in range(900)], "key string, bytes long")
    placed = {r.key: r.shard for r in sharding.balance(groups, 6, block=20).collect()}
    sums = [0] * 6
    for r in groups.collect():
        sums[placed[r.key]] += r.bytes
    assert len(placed) == 900 and max(sums) - min(sums) < 0.005 * sum(sums) / 6, sums


def test_group_near_a_share_is_left_alone_in_its_shard(spark):
    rng = random.Random(8)
    rows = [(f"g{i}", rng.randrange(100, 3000)) for i in range(9000)]
    share = sum(n for _, n in rows) / 23
    rows.append(("big", int(share * 1.02)))
    placed = {r.key: r.shard for r in sharding.balance(spark.createDataFrame(rows, "key string, bytes long"), 24, block=500).collect()}
    sums = [0] * 24
    for k, n in rows:
        sums[placed[k]] += n
    assert len(placed) == len(rows)
    rest = sorted(sums)[:-1]
    assert max(sums) == int(share * 1.02) and rest[-1] - rest[0] < 0.002 * share


def test_empty(spark):
    assert sharding.shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = spark.createDataFrame([(1, None, "a")], "doc_id long, text string, shard string")
    assert [(r["size"], r.text_crc32, r.slot) for r in sharding.shards(one).collect()] == [(8, 0, 0)]
