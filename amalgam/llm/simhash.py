"""SimHash near-duplicates with pivot distance tables.

Every document gets a 64-bit SimHash of its word shingles. Fingerprints link
at Hamming distance ``radius`` or less (:func:`near_duplicates`):

* *Keys.* Two fingerprints at distance 2 or less differ in at most two of four
  groups of 16 bits, so they agree in one of the six pairs of groups: six keys
  of 32 bits for each fingerprint, and no link is missed. A table of distances
  can discard pairs but finds none by itself: a scattered pivot's coordinate
  alone lets a third of all pairs pass.
* *Pivot distance table.* The distances to 16 scattered reference fingerprints
  are precomputed. Pairs that meet in a key are discarded if any of them
  differs by more than the radius (the triangle inequality), and the
  survivors' distance is verified.

Keys under which very many different fingerprints meet never have their pairs
listed: their members emit the 65 points at distance 0 or 1. Two fingerprints
are at distance 2 or less exactly if they share such a point, so a star from
each point to its least member gives the same components with rows linear in
the group.

Sets of five-word shingles that are similar by 0.8 or more have fingerprints 10
bits apart on average; at such a radius the distances between fingerprints and
pivots discard nothing. :func:`keep_one` therefore takes the same steps with
the metric of the sets, the size of their symmetric difference, whose radius
follows from the similarity and the two sizes; no step loses a link:

* *Keys.* The shingles are dealt over parts by their hashes. Two similar sets
  differ in so few shingles that they have whole parts in common, and in any
  one order of all parts the first of these is among the first few of either
  (:func:`least_keys`). Parts of the most shingles come first, where those
  that a sample finds often count less, so that a key is a combination of
  several shingles: single ones are met again by chance, the more often the
  more texts there are.
* *Fingerprints.* A bit whose majority is larger than the radius is the same in
  all similar sets (:func:`firm_bits`).
* *Pivot distance table.* The pivots are 128 sets, each of all shingles whose
  hashes share the highest seven bits (for long sets 1,024, of ten bits). A set's distance to one is a constant less
  twice the number of shingles in it, plus the set's size; the pivots have no
  shingle in common, so what two sets' numbers differ by adds up to at most
  their distance (the triangle inequality in every part).
* Survivors are decided by the sets themselves.

Defined results: null and empty texts have fingerprint zero, no shingles, and
link like any other; repeated rows share a fingerprint; a document without
doc_id takes its group's least doc_id (null if the group has none); an empty
table gives no rows; other columns are ignored (:func:`keep_one` keeps them).
"""

from __future__ import annotations

import math
import operator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgam.llm.common import all_of, components, cut, free_name, join_counted, map_arrow, small

SEED = 42
BITS = 64
GROUP = 16
#: Members of a key up to which its pairs are compared one by one.
PAIRWISE = 48
PIVOTS = 16
#: Pivots of the table of distances between sets: hashes that share this many of the highest bits are one pivot.
PIVOT_BITS = 7
#: Bits of the pivots whose odd numbers are compared where sets meet.
ODD_BITS = 9
#: Shingles beyond which a set's row has finer pivots, and their bits.
LONG, LONG_BITS = 640, 10
#: Rows, about, in which shingles are counted, and how many of the most frequent ones come last in the order of keys.
SAMPLE, MOST_COMMON = 10_000, 200_000
#: Shingles from which a set is dealt over parts, and how many times as many parts as two sets can differ in; smaller sets have pairs of shingles as keys.
DEALT, SPARE = 32, 1.2
#: Words of 64 marks, at least (8 kB) and at most (32 MB), that keep all keys that are met twice; others pass, too, one in ``APART`` while the most suffices.
LEAST_MARKS, MOST_MARKS, APART = 1 << 10, 1 << 22, 64
#: What a shingle adds to the weight of its part: one that the sample does not find often, and at most one that it does.
RARE, OFTEN = 16, 12
#: What rounding may add to a bound.
SLACK = 1e-9
#: Classes that share a key up to which all pairs are listed; beyond, each is compared with a leader first.
CROWD = 64
#: Pairs of a class that are decided in one task.
PART = 256
#: Shingles (8 bytes each) up to which all sets in question are broadcast to be compared; more are shuffled.
MOST_SHINGLES = 2_000_000
#: Classes whose numbers (8 bytes each) are broadcast to find their texts; more are found by a shuffle.
MOST_KEYS = 200_000


def shingles(text: bytes | None, words: int = 3) -> np.ndarray:
    """The hashes of a text's word shingles, repeats included."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    found = [b" ".join(tokens)] if len(tokens) < words else map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(SEED)), np.uint64)


def _ones(hashes: np.ndarray) -> np.ndarray:
    """In how many of the hashes each bit is set."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return ones


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as an unsigned integer; zero if there are none."""
    return int(np.packbits(_ones(hashes) * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def simhash(text: bytes | None, words: int = 3) -> int:
    """The fingerprint of one text as an unsigned integer."""
    return majority(shingles(text, words))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): the signed 64-bit SimHash of every row."""

    def batch(part: pa.RecordBatch) -> dict:
        found = np.array([simhash(x, words) for x in part.column(1).to_pylist()], np.uint64)
        return {"id": part.column(0), "fp": pa.array(found.view(np.int64))}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("bytes"))
    return map_arrow(rows, batch, "id long, fp long", by="bytes")


def _pivots(count: int = PIVOTS) -> list[int]:
    """Fixed scattered reference fingerprints, as signed integers."""
    return [xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) - (1 << 63) for i in range(count)]


def distance_table(fp: Column) -> Column:
    """Hamming distances from ``fp`` to the scattered pivots."""
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("byte") for p in _pivots()])


def _group(fp: Column, i: int) -> Column:
    """The unit-pivot coordinates of group ``i`` as one number."""
    return F.shiftrightunsigned(fp, i * GROUP).bitwiseAND(F.lit((1 << GROUP) - 1))


def _keys(fp: Column) -> Column:
    n = BITS // GROUP
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    tagged = [
        F.shiftleft(F.lit(k).cast("long"), 2 * GROUP)
        .bitwiseOR(F.shiftleft(_group(fp, i), GROUP))
        .bitwiseOR(_group(fp, j))
        for k, (i, j) in enumerate(pairs)
    ]
    return F.array(*tagged)


def links(nodes: DataFrame, radius: int = 2, pairwise: int = PAIRWISE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` whose components are those of distance <= radius.

    ``radius`` is 0, 1 or 2: with more, three of the four groups could differ.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the key layout holds for a radius of 2 at most")
    keyed = nodes.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    sizes = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    members = cut(join_counted(keyed, sizes, "key", "n", 6 * nodes.count()))
    table = members.filter(F.col("n") <= pairwise).select("key", "fp", distance_table(F.col("fp")).alias("d"))
    a, b = table.alias("a"), table.alias("b")
    close = [F.abs(F.col("a.d")[j] - F.col("b.d")[j]) <= radius for j in range(PIVOTS)]
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius
    meet = [F.col("a.key") == F.col("b.key"), F.col("a.fp") < F.col("b.fp")]
    pairs = a.join(b, all_of([*meet, *close, near])).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    crowded = members.filter(F.col("n") > pairwise).select("fp").distinct()
    flips = {0: [], 1: [], 2: range(BITS)}[radius]
    if radius == 1:
        # distance 1: the two share the point with the differing bit cleared
        points = F.array(*[F.struct(F.lit(i).alias("bit"), F.col("fp").bitwiseAND(F.lit(~(1 << i) if i < 63 else (1 << 63) - 1)).alias("at")) for i in range(BITS)])
    else:
        signed = [(1 << i) - (1 << 64 if i == 63 else 0) for i in flips]
        points = F.array(*[F.struct(F.lit(0).alias("bit"), F.col("fp").bitwiseXOR(F.lit(x)).alias("at")) for x in [0, *signed]])
    spread = crowded.select("fp", F.explode(points).alias("p"))
    least = spread.groupBy("p").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m")
    stars = spread.join(least, "p").filter("fp != b").select(F.col("fp").alias("a"), "b")
    return pairs.unionAll(stars).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """(id, fp, component): each document's fingerprint and the least id it reaches over links."""
    prints = cut(fingerprints(docs, id_col, text_col, words))
    nodes = cut(prints.groupBy("fp").agg(F.min("id").alias("low")))
    found = components(links(nodes, radius))
    rooted = nodes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component"))
    return prints.join(rooted.join(lows, "root").select("fp", "component"), "fp").select("id", "fp", "component")


def _sets(part: pa.RecordBatch, words: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text in column ``bytes``, sorted."""
    return [np.unique(shingles(x, words)) for x in part.column(part.schema.get_field_index("bytes")).to_pylist()]


def _classes(sets: list[np.ndarray]) -> pa.Array:
    """A hash of each set."""
    return pa.array(np.array([xxhash.xxh3_64_intdigest(x.tobytes(), SEED) for x in sets], np.uint64).view(np.int64))


def least_keys(hashes: np.ndarray, common: np.ndarray, places: np.ndarray, similarity: float) -> np.ndarray:
    """Keys of a set of shingles, which are sorted: every two sets with the similarity have one in common.

    Sizes are in ranges that double. A set has keys in its own range and in
    those above that a similar set can be in; two sets meet in that of the larger.
    """
    if not len(hashes):
        return hashes
    rare, weights = np.ones(len(hashes), bool), np.full(len(hashes), RARE)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        rare = common[at] != hashes
        weights = np.where(rare, RARE, np.ceil(np.log2(len(common) - places[at] + 1) * (OFTEN / np.log2(len(common) + 1))).astype(np.int64))
    most, keys = math.floor(len(hashes) / similarity + SLACK), []
    if len(hashes) < DEALT:
        often = hashes[~rare]
        ordered = np.concatenate([hashes[rare], often[np.argsort(places[at[~rare]])]]) if len(often) else hashes
        keys.append(_pair_keys(ordered, similarity))
    low = DEALT
    while low <= most:
        if len(hashes) < 2 * low:
            keys.append(_part_keys(hashes, weights, low, similarity))
        low *= 2
    return np.concatenate(keys)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return numbers ^ (numbers >> np.uint64(32))


def _pair_keys(ordered: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs of a set's first shingles, in an order of all.

    Of n shingles a similar set lacks n - n * similarity at most; with two more
    than these the first two that both have are among them. Sets that may have
    only one in common have single ones as keys, too.
    """
    least = math.ceil(len(ordered) * similarity - SLACK)
    first = ordered[: len(ordered) - least + 2]
    i, j = np.triu_indices(len(first), 1)
    pairs = _mixed(first[i] + first[j])
    return np.concatenate([pairs, first]) if least < 2 else pairs


def _part_keys(hashes: np.ndarray, weights: np.ndarray, low: int, similarity: float) -> np.ndarray:
    """The first of a set's parts among those for sets of up to twice ``low`` shingles.

    A set of n differs from a similar one in n * (1 - similarity) / similarity
    shingles at most, and so in as many parts; of one more the two share one.
    """
    ratio = (1 - similarity) / similarity
    parts = math.ceil(SPARE * 2 * low * ratio) + 1
    edges = np.searchsorted(hashes, (np.arange(parts + 1, dtype=np.float64) * (2.0**32 / parts)).astype(np.uint64) << np.uint64(32))
    edges[-1] = len(hashes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes, dtype=np.uint64)])
    heavy = np.concatenate([np.zeros(1, np.int64), np.cumsum(weights)])
    keys = _mixed(sums[edges[1:]] - sums[edges[:-1]] + np.arange(low, low + parts, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    lacks = 0xFFFF - np.minimum(heavy[edges[1:]] - heavy[edges[:-1]], 0xFFFF)
    order = (lacks.astype(np.uint64) << np.uint64(48)) | (keys >> np.uint64(16))
    return keys[np.argsort(order, kind="stable")[: math.floor(len(hashes) * ratio + SLACK) + 1]]


def firm_bits(hashes: np.ndarray, similarity: float) -> int:
    """The bits of :func:`majority` that are the same for every set with the similarity."""
    ones, most = _ones(hashes), math.floor(len(hashes) * (1 - similarity) / similarity + SLACK)
    lead = 2 * ones - len(hashes)
    return int(np.packbits((lead > most) | (lead <= -most), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def pivot_row(hashes: np.ndarray) -> np.ndarray:
    """How many shingles a set shares with each of the pivots, as bytes from -128 (none) to 127 (255 or more)."""
    return (np.minimum(_shared(hashes, LONG_BITS if len(hashes) > LONG else PIVOT_BITS), 255) - 128).astype(np.int8)


def _shared(hashes: np.ndarray, bits: int) -> np.ndarray:
    return np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def _common(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample of the rows (key, bytes), sorted, and their places from the rarest on.

    They only order keys: no result depends on them.
    """

    def batch(part: pa.RecordBatch) -> dict:
        sets = _sets(part, words)
        return {"shingle": pa.array((np.concatenate(sets) if sets else np.zeros(0, np.uint64)).view(np.int64))}

    every = max(1, docs.count() // SAMPLE)
    sample = docs.filter(F.pmod("key", F.lit(every)) == 0).select("bytes")
    counts = map_arrow(sample, batch, "shingle long", by="bytes").groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    top = counts.filter("times > 1").orderBy(F.desc("times"), "shingle").limit(MOST_COMMON).toArrow()
    found = top.column("shingle").to_numpy()[::-1].copy().view(np.uint64)
    places = np.argsort(found)
    return found[places], places


def profiles(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float) -> DataFrame:
    """(id, key, cls, n, fp, firm, odd, pivots, bands) of every row: 64-bit hashes of its id and text and of its set of n shingles.

    The rest describes the set: fingerprint, firm bits, row of the pivot table
    and which of its numbers are odd, and the keys under which it meets others.
    """
    rows = _keyed(docs, id_col, text_col)
    common, places = _common(rows, words)

    def batch(part: pa.RecordBatch) -> dict:
        sets = _sets(part, words)
        bands = [least_keys(x, common, places, similarity) for x in sets]
        ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
        table = [pivot_row(x) for x in sets]
        odd = np.packbits([_shared(x, ODD_BITS) & 1 for x in sets], bitorder="little").view(np.int64) if sets else np.zeros(0, np.int64)
        return {
            "id": part.column(0), "key": part.column(1), "cls": _classes(sets), "n": pa.array([len(x) for x in sets], pa.int32()),
            "fp": _signed([majority(x) for x in sets]), "firm": _signed([firm_bits(x, similarity) for x in sets]),
            "odd": pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * ((1 << ODD_BITS) // 64)), pa.array(odd)),
            "pivots": pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, table)]).astype(np.int32)), pa.array(np.concatenate(table) if sets else np.zeros(0, np.int8))),
            "bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bands).view(np.int64) if sets else np.zeros(0, np.int64))),
        }

    return map_arrow(rows, batch, "id long, key long, cls long, n int, fp long, firm long, odd array<long>, pivots array<tinyint>, bands array<long>", by="bytes")


def _signed(numbers: list[int]) -> pa.Array:
    return pa.array(np.array(numbers, np.uint64).view(np.int64))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    return docs.select(id_.alias("id"), F.xxhash64(id_, text).alias("key"), text.cast("binary").alias("bytes"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, key, root): the rows' groups over links of ``similarity`` or more between their sets of shingles.

    Equal sets are one class. Classes that share a key are compared: all
    pairs where up to ``CROWD`` share it. In a crowded key each is compared
    with a leader first, any one of them; of many copies most are
    in one group then, and all that are not are compared with the whole key. So no pair of two groups that meets in a key is left out, and
    none inside one group need be listed. A pair is discarded by sizes, by
    fingerprints and by the pivot distance table; the rest are decided by the
    exact similarity of their sets.
    """
    if not 0 < similarity <= 1:
        raise ValueError("a similarity is above 0 and at most 1")
    rows = cut(profiles(docs, id_col, text_col, words, similarity))
    classes = cut(rows.groupBy("cls").agg(F.min("key").alias("key"), *[F.first(c).alias(c) for c in ("n", "fp", "firm", "odd", "pivots")]))
    sets_of = _Sets(docs, classes.select("cls", "key"), id_col, text_col, words)
    met = cut(_met(rows.select("cls", "bands")))
    shared = met.groupBy("band").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    meeting = cut(join_counted(met, cut(shared), "band", "times", met.count()))
    few = meeting.filter(F.col("times") <= CROWD).drop("times").join(classes.select("cls", "n", "odd"), "cls")
    links = _verified(_discarded(_meeting(few, few, similarity, once=True), classes, similarity), sets_of, similarity)
    crowded = meeting.filter(F.col("times") > CROWD)
    if crowded.limit(1).count():
        bands = crowded.groupBy("cls").agg(F.collect_list("band").alias("bands"))
        crowded = cut(crowded.drop("times").join(classes.select("cls", "n", "odd"), "cls"))
        leaders = crowded.groupBy("band").agg(F.min_by(F.struct("cls", "n", "odd"), F.struct(F.xxhash64("cls", "band"), "cls")).alias("x"))
        led = _discarded(_meeting(crowded, small(leaders.select("band", "x.*")), similarity), classes, similarity)
        links = cut(links.unionAll(_verified(led, sets_of, similarity)).distinct())
        grouped = crowded.join(components(links), F.col("cls") == F.col("node"), "left").withColumn("group", F.coalesce("root", "cls")).drop("node", "root")
        placed = cut(grouped.join(bands, "cls"))
        sizes = placed.groupBy("band", "group").agg(F.count(F.lit(1)).alias("n"))
        main = sizes.groupBy("band").agg(F.max_by("group", F.struct("n", "group")).alias("main"))
        apart = cut(placed.join(small(main), "band").filter("group != main").drop("main"))
        links = links.unionAll(_verified(_discarded(_meeting(placed, small(apart), similarity, other=True), classes, similarity), sets_of, similarity))
    found = components(links)
    named = rows.select("id", "key", "cls").join(found, F.col("cls") == F.col("node"), "left")
    return named.select("id", "key", F.coalesce("root", "cls").alias("root"))


def _meeting(left: DataFrame, right: DataFrame, similarity: float, other: bool = False, once: bool = False) -> DataFrame:
    """The pairs (a, b), a < b, of classes that share a band and may be similar; with ``other`` of two groups only."""
    names = ["band", "cls", "n", "odd"] + (["group", "bands"] if other else [])
    left, right = left.select(*names), right.select(*[F.col(c).alias(f"{c}2") for c in names])
    near = F.least("n", "n2") >= F.greatest("n", "n2") * similarity - SLACK
    unlike = [F.bit_count(F.col("odd")[j].bitwiseXOR(F.col("odd2")[j])) for j in range((1 << ODD_BITS) // 64)]
    near &= reduce(operator.add, unlike) <= _radius(similarity)  # an odd and an even number differ by one at least
    if other:
        near &= F.col("group") != F.col("group2")
        near &= F.array_min(F.array_intersect("bands", "bands2")) == F.col("band")  # a pair is listed under one of its keys
    apart = F.col("cls") < F.col("cls2") if once else F.col("cls") != F.col("cls2")
    met = left.join(right, (F.col("band") == F.col("band2")) & apart & near)
    return met.select(F.least("cls", "cls2").alias("a"), F.greatest("cls", "cls2").alias("b"))


def _within(similarity: float) -> Column:
    """Whether the rows ``pivots`` and ``pivots2`` of the pivot table, if they are of the same pivots, allow the similarity of sets of ``n`` and ``n2`` shingles."""
    steps = F.zip_with("pivots", "pivots2", lambda x, y: F.abs(x.cast("int") - y.cast("int")))
    return (F.size("pivots") != F.size("pivots2")) | (F.aggregate(steps, F.lit(0), lambda x, y: x + y) <= _radius(similarity))


def _radius(similarity: float) -> Column:
    return (F.col("n") + F.col("n2")) * ((1 - similarity) / (1 + similarity)) + SLACK


def _discarded(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The distinct ones of the pairs (a, b) that neither fingerprints nor the pivot distance table discard."""
    table = classes.select("cls", "n", "fp", "firm", "pivots")
    other = table.select(F.col("cls").alias("b"), *[F.col(c).alias(f"{c}2") for c in table.columns[1:]])
    met = cut(pairs.distinct()).join(table.withColumnRenamed("cls", "a"), "a").join(other, "b")
    agree = F.col("fp").bitwiseXOR(F.col("fp2")).bitwiseAND(F.col("firm").bitwiseOR(F.col("firm2"))) == 0
    return met.filter(agree).filter(_within(similarity)).select("a", "b")


def _met(rows: DataFrame) -> DataFrame:
    """The distinct (band, cls) of ``rows`` (cls, bands), less most of the keys that only one row has.

    Rows are not shuffled to find these: the keys alone are counted, those met
    twice are marked in a table of bits, and what is not marked stays behind.
    The whole key is counted, and the table grows with their number.
    """
    counts = rows.select(F.explode("bands").alias("band")).groupBy("band").agg(F.count(F.lit(1)).alias("times"))
    twice = cut(counts.filter("times > 1").select("band"))
    count = 1 << max(0, math.ceil(twice.count() * APART / 64) - 1).bit_length()
    count = min(max(count, LEAST_MARKS), MOST_MARKS)
    word = F.shiftright("band", 6).bitwiseAND(F.lit(count - 1))
    found = twice.groupBy(word.alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(band & 63 as int)))").alias("bits")).toArrow()
    marks = np.zeros(count, np.uint64)
    marks[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)

    def batch(part: pa.RecordBatch) -> dict:
        lists = part.column(1)
        bands = lists.flatten().to_numpy().view(np.uint64)
        own = np.repeat(part.column(0).to_numpy(), lists.value_lengths().to_numpy())
        seen = (marks[(bands >> np.uint64(6)) & np.uint64(count - 1)] >> (bands & np.uint64(63))) & np.uint64(1) == 1
        return {"band": pa.array(bands[seen].view(np.int64)), "cls": pa.array(own[seen])}

    return map_arrow(rows, batch, "band long, cls long", by="bands").distinct()


class _Sets:
    """Reads the sets of shingles of classes from one text each."""

    def __init__(self, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, words: int):
        self.texts, self.classes, self.words = _keyed(docs, id_col, text_col), classes, words

    def __call__(self, asked: DataFrame) -> DataFrame:
        """(cls, hashes) of the classes (cls)."""
        words = self.words

        def batch(part: pa.RecordBatch) -> dict:
            sets = _sets(part, words)
            at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            return {"cls": _classes(sets), "hashes": pa.ListArray.from_arrays(pa.array(at), pa.array(values))}

        keys = self.classes.join(asked, "cls").select("key")
        texts = self.texts.join(small(keys, MOST_KEYS), "key", "left_semi").select("key", "bytes")
        return cut(map_arrow(texts, batch, "cls long, hashes array<long>", by="bytes").dropDuplicates(["cls"]))


def _verified(pairs: DataFrame, sets_of: _Sets, similarity: float) -> DataFrame:
    """The distinct pairs (a, b) of classes whose sets have the similarity."""
    pairs = cut(pairs.distinct())
    if not pairs.limit(1).count():
        return pairs
    sets = sets_of(pairs.selectExpr("a as cls").unionAll(pairs.selectExpr("b as cls")).distinct())
    # a class in very many pairs is dealt over parts
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("times")).withColumn("parts", F.ceil(F.col("times") / PART).cast("int"))
    common = F.size(F.array_intersect("x", "y"))
    similar = common / (F.size("x") + F.size("y") - common) >= similarity
    if (sets.agg(F.sum(F.size("hashes"))).first()[0] or 0) <= MOST_SHINGLES:
        left, right = (F.broadcast(sets.select(F.col("cls").alias(c), F.col("hashes").alias(h))) for c, h in (("a", "x"), ("b", "y")))
        return cut(pairs.join(left, "a").join(right, "b").filter(similar).select("a", "b"))
    first = sets.join(counts, F.col("cls") == F.col("a")).select("a", F.col("hashes").alias("x"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = join_counted(pairs, counts, "a", "times", pairs.count()).select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    both = dealt.join(sets.select(F.col("cls").alias("b"), F.col("hashes").alias("y")), "b").join(first, ["a", "part"])
    return cut(both.filter(similar).select("a", "b"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` less all but one document of each group of :func:`similar_groups`.

    The document with the least id stays (of equal ids the text that hashes
    lowest; one without an id only if none has one), once if its row is
    repeated. Different texts of one id are different documents.
    """
    found = similar_groups(docs, id_col, text_col, words, similarity)
    stay = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("least")).select(F.col("least.key").alias("stay"))
    (own,) = free_name(docs, "row_key")
    keyed = docs.withColumn(own, F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")))
    kept = keyed.join(stay.distinct(), F.col(own) == F.col("stay"), "left_semi").dropDuplicates([own])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
