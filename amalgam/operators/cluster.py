"""Representative points of point sets: k-means with fixed seeds, then a pick of dense and distant centres."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the selection policy.
RADIUS_SQUARED = 5.0
SEPARATION = 9.0
QUARTILE = 25
MOST = 3


def centres_wanted(weight: float, points: int) -> int:
    """How many clusters a set of this total weight gets."""
    n = round(weight)
    for below, k in ((100, 3), (1000, 4), (6000, 5)):
        if n < below:
            return max(3, min(k, points))
    return max(3, min(6 + (n - 6000) // 5000, 10, points))


def _squares(xy: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to centres (columns)."""
    return np.column_stack([((xy - c) ** 2).sum(axis=1) for c in centres])


def _kmeans(xy: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's iterations from farthest-point seeds, which makes them the same on every run."""
    seeds = [int(np.argmax(w))]
    far = ((xy - xy[seeds[0]]) ** 2).sum(axis=1)
    while len(seeds) < k:
        seeds.append(int(np.argmax(far * w)))
        far = np.minimum(far, ((xy - xy[seeds[-1]]) ** 2).sum(axis=1))
    centres = xy[seeds].copy()
    for _ in range(max(5, min(2 * k, 20))):
        own = np.argmin(_squares(xy, centres), axis=1)
        total = np.bincount(own, w, k)
        for d in (0, 1):
            sums = np.bincount(own, w * xy[:, d], k)
            centres[total > 0, d] = sums[total > 0] / total[total > 0]
    return centres


def representatives(xy: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Indexes of one to three distinct input points that stand for the set; all of them if there are three at most.

    Of more than three clusters, those of at least the lower quartile of weight
    near their centre count; from the heaviest on, one is chosen if it is far
    enough from those chosen, and what is missing of three is filled by weight.
    """
    if len(xy) <= 3:
        return np.arange(len(xy))
    k = centres_wanted(float(w.sum()), len(xy))
    centres = _kmeans(xy, w, k)
    apart = _squares(xy, centres)
    if k > 3:
        score = ((apart <= RADIUS_SQUARED) * w[:, None]).sum(axis=0)
        order = np.argsort(-score, kind="stable")
        dense = [c for c in order if score[c] >= np.percentile(score, QUARTILE)]
        chosen = []
        for c in dense:
            if len(chosen) < MOST and all(np.hypot(*(centres[c] - centres[o])) >= SEPARATION for o in chosen):
                chosen.append(c)
        chosen += [c for c in [*dense, *order] if c not in chosen][: MOST - len(chosen)]
        apart = apart[:, chosen[:MOST]]
    nearest = np.argmin(apart, axis=0)
    return nearest[np.sort(np.unique(nearest, return_index=True)[1])]


def centroids(points: DataFrame, key: str, x: str = "lng", y: str = "lat", weight: str | None = None, most_points: int = 2_000_000) -> DataFrame:
    """(key, nth, x, y): representative points of every key.

    Equal points are summed first. A key's distinct points meet in one task, so
    keys with more than ``most_points`` of them are refused: roll points up to
    tiles before this (:func:`modes` tells which keys need it).
    """
    w = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    unique = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(key).alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(w.cast("double").alias("w"))
    kind = unique.schema["key"].dataType.simpleString()

    def pick(group: pa.Table) -> pa.Table:
        if group.num_rows > most_points:
            raise ValueError(f"{group.num_rows} points of a key; roll them up to tiles first")
        group = group.sort_by([("x", "ascending"), ("y", "ascending")])
        xy = np.column_stack([group.column(c).to_numpy() for c in "xy"])
        rows = representatives(xy, group.column("w").to_numpy())
        taken = group.take(pa.array(rows)).drop_columns(["w"])
        return taken.append_column("nth", pa.array(np.arange(len(rows), dtype=np.int32)))

    found = unique.groupBy("key").applyInArrow(pick, f"key {kind}, x double, y double, nth int")
    return found.select(F.col("key").alias(key), "nth", F.col("x").alias(x), F.col("y").alias(y))


def modes(tile_counts: DataFrame, key: str, rank_ordinal: str, raw_points: str, genus: int = 12, few_tiles: int = 100, many_points: int = 300) -> DataFrame:
    """(key, mode): raw for genera and above with many points and for keys with few tiles, else tiles."""
    raw = ((F.col(rank_ordinal) <= genus) & (F.col(raw_points) >= many_points)) | (F.col("tiles") < few_tiles)
    return tile_counts.select(key, F.when(raw, "raw").otherwise("tiles").alias("mode"))
