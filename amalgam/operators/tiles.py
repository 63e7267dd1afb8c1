"""Occurrence points to tiles, rolled up a hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amalgam.functions.geo import is_null_island, parent_tile, tile_id
from amalgam.functions.keys import first_by
from amalgam.session import cut

GUARD = 50_000
TARGET_TILES = 25_000


def usable_points(points: DataFrame, lng: str = "lng", lat: str = "lat") -> DataFrame:
    """Points with coordinates that are no placeholders, rounded to three digits."""
    ok = F.col(lng).isNotNull() & F.col(lat).isNotNull() & ~is_null_island(F.col(lng), F.col(lat))
    return points.filter(ok).withColumns({lng: F.round(lng, 3), lat: F.round(lat, 3)})


def tile_counts(points: DataFrame, key: str, lng: str = "lng", lat: str = "lat") -> DataFrame:
    """(key, tile_id, center_lng, center_lat, count): points of each tile and the middle of their bounds.

    Equal coordinates are collapsed before the projection is computed.
    """
    unique = points.groupBy(key, lng, lat).agg(F.count(F.lit(1)).alias("n"))
    tiled = unique.withColumn("tile_id", tile_id(F.col(lng), F.col(lat)))
    middle = lambda c: (F.min(c) + F.max(c)) / 2
    return tiled.groupBy(key, "tile_id").agg(middle(lng).alias("center_lng"), middle(lat).alias("center_lat"), F.sum("n").alias("count"))


def _merge_key(guard: int, key: str):
    unique = F.concat(F.lit("u:"), F.col("tile_id").cast("string"), F.lit("#"), F.col(key).cast("string"))
    return F.when(F.col("count") > guard, unique).otherwise(F.concat(F.lit("m:"), F.col("tile_id").cast("string")))


def guarded_rollup(tiles: DataFrame, edges: DataFrame, key: str, parent: str = "parent", guard: int = GUARD, levels: int = 20) -> DataFrame:
    """Tiles of every node and of all its descendants, level by level.

    Tiles of a parent merge by tile id, at the centre of the densest child
    tile; a tile of more than ``guard`` points gets a key of its own and never
    merges again. ``edges`` are (key, parent).
    """
    columns = [key, "tile_id", "center_lng", "center_lat", "count", "merge_key"]
    front = cut(tiles.withColumn("merge_key", _merge_key(guard, key)).select(*columns))
    found = front
    up = edges.select(F.col(key), F.col(parent).alias("__up")).filter("__up is not null")
    for _ in range(levels):
        moved = front.join(up, key).drop(key).withColumnRenamed("__up", key)
        densest = F.min_by(F.struct("center_lng", "center_lat"), F.struct(-F.col("count"), F.col("center_lng"), F.col("center_lat"))).alias("c")
        merged = moved.groupBy(key, "tile_id", "merge_key").agg(densest, F.sum("count").alias("count"))
        kept = F.when(F.col("merge_key").startswith("u:"), F.col("merge_key")).otherwise(_merge_key(guard, key))
        front = cut(merged.select(key, "tile_id", F.col("c.center_lng").alias("center_lng"), F.col("c.center_lat").alias("center_lat"), "count", kept.alias("merge_key")))
        if front.isEmpty():
            break
        found = found.unionByName(front)
    return found


def coarsen(tiles: DataFrame, key: str, target: int = TARGET_TILES, guard: int = GUARD, rounds: int = 8) -> DataFrame:
    """Merge the small tiles of keys with over ``target`` tiles into parent tiles, step by step.

    Tiles of ``guard`` points or more stay. ``zoom_out`` counts the steps a tile
    took, so a coarse id is never taken for a fine one.
    """
    state = cut(tiles.select(key, "tile_id", F.lit(0).alias("zoom_out"), "center_lng", "center_lat", "count"))
    for _ in range(rounds):
        heavy = state.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("count") < guard).alias("tail")).filter((F.col("n") > target) & (F.col("tail") > 0)).select(key, F.lit(True).alias("heavy"))
        marked = cut(state.join(heavy, key, "left").withColumn("move", F.coalesce(F.col("heavy"), F.lit(False)) & (F.col("count") < guard)))
        if not marked.filter("move").limit(1).count():
            break
        mean = lambda c: (F.sum(F.col(c) * F.col("count")) / F.sum("count")).alias(c)
        moved = marked.filter("move").groupBy(key, parent_tile(F.col("tile_id")).alias("tile_id"), (F.col("zoom_out") + 1).alias("zoom_out")).agg(mean("center_lng"), mean("center_lat"), F.sum("count").alias("count"))
        state = cut(marked.filter("not move").select(*state.columns).unionByName(moved.select(*state.columns)))
    return state


def histogram(points: DataFrame, key: str, value: str, width: int = 100) -> DataFrame:
    """(key, bin, count) of values in bins of ``width``, floored."""
    b = (F.floor(F.col(value) / width) * width).cast("long").alias("bin")
    return points.filter(F.col(value).isNotNull()).groupBy(key, b).agg(F.count(F.lit(1)).alias("count"))


def histogram_rollup(bins: DataFrame, edges: DataFrame, key: str, parent: str = "parent", levels: int = 20) -> DataFrame:
    """Histograms of every node and all its descendants."""
    front = cut(bins.select(key, "bin", "count"))
    found, up = front, edges.select(F.col(key), F.col(parent).alias("__up")).filter("__up is not null")
    for _ in range(levels):
        front = cut(front.join(up, key).groupBy(F.col("__up").alias(key), "bin").agg(F.sum("count").alias("count")))
        if front.isEmpty():
            break
        found = found.unionByName(front)
    return found.groupBy(key, "bin").agg(F.sum("count").alias("count"))


def histogram_median(bins: DataFrame, key: str) -> DataFrame:
    """(key, median): the first bin at which the running count reaches half of (total + 1)."""
    running = F.sum("count").over(Window.partitionBy(key).orderBy("bin"))
    total = F.sum("count").over(Window.partitionBy(key))
    return bins.withColumns({"__r": running, "__t": total}).filter(F.col("__r") >= (F.col("__t") + 1) / 2).groupBy(key).agg(F.min("bin").alias("median"))


def exact_over_derived(exact: DataFrame, derived: DataFrame, key: str, value: str) -> DataFrame:
    """Full outer join of two estimates; the exact one wins."""
    return exact.withColumnRenamed(value, "__e").join(derived.withColumnRenamed(value, "__d"), key, "full").select(key, F.coalesce("__e", "__d").alias(value))


def raw_rollup(points: DataFrame, edges: DataFrame, key: str, ranks: list[str], parent: str = "parent", rank: str = "parent_rank", levels: int = 20) -> DataFrame:
    """``points`` of every node and of all its descendants below parents of ``ranks``, with a column count.

    Rows are points, not lists of them: equal ones of a node are counted first,
    and each level moves the counted rows to their parents. RuntimeError if
    ``levels`` were too few, as in a circle of edges.
    """
    place = [c for c in points.columns if c != key]
    up = edges.filter(F.col(rank).isin(ranks) & F.col(parent).isNotNull()).select(F.col(key), F.col(parent).alias("__up")).distinct()
    front = cut(points.groupBy(key, *place).agg(F.count(F.lit(1)).alias("count")))
    found = front
    for _ in range(levels):
        front = cut(front.join(up, key).groupBy(F.col("__up").alias(key), *place).agg(F.sum("count").alias("count")))
        if front.isEmpty():
            return found.groupBy(key, *place).agg(F.sum("count").alias("count"))
        found = found.unionByName(front)
    raise RuntimeError(f"points still move after {levels} levels")


def package(tiles: DataFrame, key: str, few: int = 20, centroids: DataFrame | None = None, bins: DataFrame | None = None, medians: DataFrame | None = None) -> DataFrame:
    """(key, habitat JSON, max, avg, observations, and what is given of centroids JSON, elevation, elevation_profile JSON).

    Tiles of fewer than ``few`` points come last, the densest first. ``centroids``
    (key, lng, lat) become distinct pairs of four digits, ``bins`` (key, bin,
    count) a profile by height, ``medians`` (key, median) the elevation.
    """
    order = F.struct((F.col("count") < few).alias("few"), (-F.col("count")).alias("n"), F.col("tile_id"), F.col("center_lng").alias("lng"), F.col("center_lat").alias("lat"))
    items = F.transform(F.sort_array(F.collect_list(order)), lambda t: F.struct(t["lng"].alias("lng"), t["lat"].alias("lat"), (-t["n"]).alias("occ")))
    out = tiles.groupBy(key).agg(F.to_json(items).alias("habitat"), F.max("count").alias("max"), F.avg("count").alias("avg"), F.sum("count").alias("observations"))
    if centroids is not None:
        pair = F.array(F.col("lng").cast("decimal(8,4)"), F.col("lat").cast("decimal(8,4)"))
        out = out.join(centroids.groupBy(key).agg(F.to_json(F.sort_array(F.collect_set(pair))).alias("centroids")), key, "left")
    if medians is not None:
        out = out.join(medians.select(key, F.col("median").cast("short").alias("elevation")), key, "left")
    if bins is not None:
        steps = F.transform(F.sort_array(F.collect_list(F.struct("bin", "count"))), lambda b: F.struct(b["bin"].alias("elevation"), b["count"].alias("occ")))
        out = out.join(bins.groupBy(key).agg(F.to_json(steps).alias("elevation_profile")), key, "left")
    return out


def with_geo(rows: DataFrame, packaged: DataFrame, key: str) -> DataFrame:
    """``rows`` with the packaged values of their key as one JSON text ``geo`` where they are accepted, else null."""
    names = {"habitat": "habitat", "max": "maxhab", "avg": "avghab", "observations": "observations", "centroids": "centroids", "elevation": "elevation", "elevation_profile": "hypsogram"}
    raw = {"habitat": "array<struct<lng:double,lat:double,occ:bigint>>", "centroids": "array<array<decimal(8,4)>>", "elevation_profile": "array<struct<elevation:bigint,occ:bigint>>"}
    parts = [(F.from_json(c, raw[c]) if c in raw else F.col(c)).alias(n) for c, n in names.items() if c in packaged.columns]
    joined = rows.join(packaged.select(key, F.to_json(F.struct(*parts)).alias("__geo")), key, "left")
    return joined.withColumn("geo", F.when(F.col("accepted"), F.col("__geo"))).drop("__geo")


def densest_tile(tiles: DataFrame, key: str) -> DataFrame:
    return first_by(tiles, [key], [F.desc("count"), F.col("tile_id")])
