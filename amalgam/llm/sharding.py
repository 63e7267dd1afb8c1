"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A group of equal texts goes to one shard whole. Differencing combines the
partial partitions with the largest spread again and again, their parts in
opposite order, until one is left. It runs in three steps, none of which holds
more than a block of groups:

1. The groups above a ``BIG``-th of a shard's share, fewer than ``BIG`` times
   the number of shards, are placed first.
2. All other groups are dealt to blocks by hash, and each block is combined
   with the large groups' partition, scaled to the block's size: what a large
   group takes of a shard is left free by every block alike.
3. One block is held back and combined with the sum of all the others, which
   evens out what they missed by.

Groups are indivisible: a group larger than a shard's share makes its shard
larger than the others by what it has too much, and the others are balanced
among themselves. A caller may give ``split_over`` to split groups above so
many shares by document instead.

Defined results: a null text is its own group, of the 8 bytes that every
document has besides its text, with CRC 0; repeated rows are documents of one
group; ids may be null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amalgam.llm.common import cut, small

BLOCK, BIG = 4096, 64
#: Bytes that a document takes besides its text.
OVERHEAD = 8
#: Rows of a part of a shard that are numbered together.
NUMBERED = 20_000


def differencing(items: list[list[int]], ways: int) -> list[list[int]]:
    """Place partial partitions: for each item, the final part of each of its ``ways`` parts.

    Entry j of an item is the size of its part j.
    """
    if not items:
        return []
    heap, tie = [], count()
    for i, parts in enumerate(items):
        order = sorted(range(ways), key=lambda j: (-parts[j], j))
        sums = [parts[j] for j in order]
        heap.append((sums[-1] - sums[0], next(tie), sums, (i, order)))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, tree_a = heapq.heappop(heap)
        _, _, b, tree_b = heapq.heappop(heap)
        joint = [x + y for x, y in zip(a, reversed(b), strict=True)]
        order = sorted(range(ways), key=lambda j: (-joint[j], j))
        sums = [joint[j] for j in order]
        heapq.heappush(heap, (sums[-1] - sums[0], next(tie), sums, (tree_a, tree_b, order)))
    out: list[list[int]] = [[] for _ in items]
    todo = [(heap[0][3], list(range(ways)))]
    while todo:
        tree, final = todo.pop()
        back = [0] * ways
        for place, j in enumerate(tree[-1]):
            back[j] = final[place]
        if len(tree) == 2:
            out[tree[0]] = back
        else:
            todo.append((tree[0], back))
            todo.append((tree[1], back[::-1]))
    return out


def balance(groups: DataFrame, ways: int, block: int = BLOCK) -> DataFrame:
    """(key, shard) for rows (key, bytes), key a distinct binary or string."""
    kind = groups.schema["key"].dataType.simpleString()
    groups = groups.select("key", F.col("bytes").cast("long").alias("bytes"))
    total, n = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    large = F.col("bytes") * (ways * BIG) > total
    big = sorted(((r.key, r.bytes) for r in groups.filter(large).collect()), key=lambda r: (-r[1], bytes(r[0]) if kind == "binary" else r[0]))  # under BIG * ways rows
    placed = [parts[0] for parts in differencing([[size] + [0] * (ways - 1) for _, size in big], ways)]
    base = [0] * ways
    for (_, size), shard in zip(big, placed, strict=True):
        base[shard] += size
    rest = max(1, total - sum(base))
    blocks = max(1, -(-n // block))
    dealt = cut(groups.filter(~large).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))))

    def combine(filled: list[int], scaled: bool):
        def place(table: pa.Table) -> pa.Table:
            table = table.sort_by([("bytes", "descending"), ("key", "ascending")])
            sizes = table.column("bytes").to_pylist()
            turn = table.column("block")[0].as_py() % ways  # so that blocks don't favour the same shards
            share = sum(sizes) / rest if scaled else 1
            so_far = [int(filled[(j + turn) % ways] * share) for j in range(ways)]
            found = differencing([so_far, *([size] + [0] * (ways - 1) for size in sizes)], ways)
            shard_of = {slot: (j + turn) % ways for j, slot in enumerate(found[0])}
            return table.select(["key", "bytes"]).append_column("shard", pa.array([shard_of[x[0]] for x in found[1:]], pa.int32()))

        return place

    result = f"key {kind}, bytes long, shard int"
    most = cut(dealt.filter("block != 0").groupBy("block").applyInArrow(combine(base, True), result))
    for row in most.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():  # a row for each shard
        base[row.shard] += row.bytes
    last = dealt.filter("block = 0").groupBy("block").applyInArrow(combine(base, False), result)
    first = groups.sparkSession.createDataFrame([(k, s) for (k, _), s in zip(big, placed, strict=True)], f"key {kind}, shard int")
    return most.select("key", "shard").unionAll(last.select("key", "shard")).unionAll(first)


def shards(docs: DataFrame, ways: int = 24, id_col: str = "doc_id", text_col: str = "text", split_over: float | None = None) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every document; slots of a shard run from 0 without gaps."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = cut(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.when(F.col(text_col).isNotNull(), F.unhex(F.sha2(raw, 256))).otherwise(F.lit(bytes(32))).alias("digest"),
            F.monotonically_increasing_id().alias("row"),  # fixed by the checkpoint; spreads rows that are equal
        )
    )
    groups = cut(base.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")))
    total, n = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    share = max(1.0, total / ways)
    over = F.lit(False) if split_over is None else F.col("bytes") > split_over * share
    parts = F.when(over, F.ceil(F.col("bytes") / share)).otherwise(F.lit(1)).cast("int")
    # groups with over a thousandth of all rows, a thousand at most, are matched by broadcast: their rows stay spread
    many = F.col("rows") > n / 1000
    hot = F.broadcast(groups.filter(many).select("digest", parts.alias("parts")))

    def part_key(parts):
        return F.concat(F.col("digest"), F.pmod(F.xxhash64("id", "text_crc32", "row"), parts).cast("string").cast("binary"))

    cold_docs = base.join(hot, "digest", "left_anti").withColumn("key", F.concat(F.col("digest"), F.lit(b"0")))
    hot_docs = base.join(hot, "digest").withColumn("key", part_key(F.col("parts"))).drop("parts")
    cold_keys = groups.filter(~many).select(F.concat(F.col("digest"), F.lit(b"0")).alias("key"), "bytes")
    hot_keys = hot_docs.groupBy("key").agg(F.sum("size").alias("bytes"))
    placed = cut(balance(cold_keys.unionAll(hot_keys), ways))
    hot_places = placed.join(F.broadcast(groups.filter(many).select("digest")), F.substring("key", 1, 32) == F.col("digest"), "left_semi")
    chosen = cold_docs.join(placed, "key").unionByName(hot_docs.join(F.broadcast(hot_places), "key"))
    runs = max(1, -(-n // (ways * NUMBERED)))
    dealt = cut(chosen.select("id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("id", "text_crc32", "row"), F.lit(runs)).alias("run")))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # runs, not rows
    starts = dealt.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n")).select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "run").orderBy("id", "text_crc32")) - 1
    return dealt.join(small(starts), ["shard", "run"]).select("id", "size", "text_crc32", "shard", (within + F.col("start")).cast("long").alias("slot"))
