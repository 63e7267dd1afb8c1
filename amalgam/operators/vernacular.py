"""Reduction of name lists in many languages."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from amalgam.functions.arrays import by_frequency, list_mode


#: Names up to this length are found by what is left of them after deletions, if at most so many; longer ones by segments.
SHORT, DELETIONS = 12, 2
#: Tasks for each core in which lists are clustered, at least.
TASKS = 4


def distance(a: str, b: str, limit: int) -> int:
    """Levenshtein distance in characters, or ``limit`` if it is that or more."""
    if abs(len(a) - len(b)) >= limit:
        return limit
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) >= limit:
            return limit
    return min(row[-1], limit)


def _segments(length: int, parts: int) -> list[tuple[int, int]]:
    """Start and end of ``parts`` nearly equal segments of a text of ``length`` characters."""
    return [(length * k // parts, length * (k + 1) // parts) for k in range(parts)]


def cluster_names(names: list[str], within: int = 3) -> list[str]:
    """Replace each name by the usual spelling of its cluster.

    The first name left seeds a cluster of all names left at a distance below
    ``within`` from it; the usual spelling is the cluster's most frequent one in
    the list, of equals the one seen first. Only names that meet the seed in an
    index are compared with it: short ones if some deletions, fewer than
    ``within``, leave the same of both; of a longer one's ``within`` segments one
    survives fewer than ``within`` edits and moves by fewer characters.
    Names that have their cluster leave the index as it is read.
    """
    counts: dict[str, int] = {}
    for n in names:
        counts[n] = counts.get(n, 0) + 1
    parts, slack = max(within, 1), max(within - 1, 0)
    short = SHORT if slack <= DELETIONS else -1
    place, index = {n: i for i, n in enumerate(counts)}, {}
    for n in counts:
        if len(n) <= short:
            for left in _left(n, slack):
                index.setdefault(left, []).append(n)
        else:
            for k, (i, j) in enumerate(_segments(len(n), parts)):
                index.setdefault((len(n), k, n[i:j]), []).append(n)
    usual: dict[str, str] = {}

    def keys(seed: str) -> Iterator[str | tuple]:
        if len(seed) <= short + slack:
            yield from _left(seed, slack)
        for length in range(max(len(seed) - slack, short + 1, 0), len(seed) + slack + 1):
            for k, (i, j) in enumerate(_segments(length, parts)):
                for at in range(max(i - slack, 0), min(i + slack, len(seed) - (j - i)) + 1):
                    yield length, k, seed[at : at + j - i]

    for seed in counts:
        if seed in usual:
            continue
        met = {seed}
        for key in keys(seed):
            if found := index.get(key):
                index[key] = found = [n for n in found if n not in usual]
                met.update(found)
        near = [n for n in sorted(met, key=place.__getitem__) if n == seed or distance(seed, n, within) < within]
        usual |= dict.fromkeys(near, max(near, key=lambda n: counts[n]))
    return [usual[n] for n in names]


def _left(name: str, most: int) -> set[str]:
    """What up to ``most`` deletions leave of a name."""
    return {"".join(x) for k in range(min(most, len(name)) + 1) for x in combinations(name, len(name) - k)}


@F.pandas_udf(ArrayType(StringType()))
def _clustered(lists: pd.Series) -> pd.Series:
    return lists.map(lambda names: None if names is None else cluster_names(list(names)))


def normalise_languages(df: DataFrame, lang: str, codes: dict[str, str]) -> DataFrame:
    """Language tags by a code table; unknown tags stay."""
    lookup = F.create_map(*map(F.lit, chain.from_iterable(codes.items())))
    return df.withColumn(lang, F.coalesce(F.try_element_at(lookup, F.lower(lang)), F.lower(lang)))


def unpack(df: DataFrame, key: str, tagged: str) -> DataFrame:
    """(key, lang, name) of an array of "lang:name" texts."""
    each = F.explode(tagged).alias("__t")
    return df.select(key, each).select(key, F.split_part("__t", F.lit(":"), F.lit(1)).alias("lang"), F.expr("substring(__t, locate(':', __t) + 1)").alias("name"))


def reduce_names(names: DataFrame, key: str, order: str, scientific: DataFrame | None = None, most: int = 10) -> DataFrame:
    """(key, vernacular map of lang to names, common_name) of rows (key, lang, name, order).

    Names are lower-cased and trimmed, the row's scientific name dropped,
    spellings clustered and sorted by frequency, ``most`` kept in a language;
    the common name is the most frequent English one. Lists are as long as a
    key has names in one language; keys are dealt over several tasks for each
    core, however few bytes they have, for clustering costs far more than reading.
    """
    rows = names.select(key, "lang", F.lower(F.trim("name")).alias("name"), F.col(order).alias("__o")).filter("name is not null and name != '' and lang is not null")
    if scientific is not None:
        rows = rows.join(scientific.select(key, F.lower(scientific.columns[1]).alias("name")).distinct(), [key, "name"], "left_anti")
    spark = names.sparkSession
    tasks = max(TASKS * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lists = rows.repartition(tasks, key).groupBy(key, "lang").agg(F.sort_array(F.collect_list(F.struct("__o", "name"))).alias("l")).select(key, "lang", F.transform("l", lambda s: s["name"]).alias("names"))
    plain = F.size(F.array_distinct("names")) == 1
    spelled = lists.withColumn("names", F.when(plain, F.slice("names", 1, 1)).otherwise(_clustered("names")))
    ranked = spelled.withColumn("top", by_frequency(F.col("names"), most))
    common = F.max(F.when(F.col("lang") == "en", list_mode(F.col("names"))))
    entries = F.sort_array(F.collect_list(F.struct("lang", "top")))
    return ranked.groupBy(key).agg(F.map_from_entries(entries).alias("vernacular"), common.alias("common_name"))
