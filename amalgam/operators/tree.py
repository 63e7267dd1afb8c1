"""Hierarchies by parent pointer: closure, backfill, cascade, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgam.functions.keys import first_by
from amalgam.operators.dedupe import mode_by
from amalgam.session import cut

#: Levels and rounds that no hierarchy of ranks passes.
LEVELS = 60


def closure(edges: DataFrame, node: str = "id", parent: str = "parent", levels: int = LEVELS) -> DataFrame:
    """(node, ancestor, level) of every ancestor, direct parents at level 1.

    One equi-join a level; a level that finds no new ancestor ends it, so
    circles end too. RuntimeError if there are ancestors beyond ``levels``.
    """
    up = cut(edges.filter(F.col(parent).isNotNull() & (F.col(node) != F.col(parent))).select(F.col(node).alias("node"), F.col(parent).alias("ancestor")).distinct())
    steps = up.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("__next"))
    found = up.withColumn("level", F.lit(1))
    front = found
    for level in range(2, levels + 2):
        met = front.join(steps, "ancestor").select("node", F.col("__next").alias("ancestor")).distinct()
        front = cut(met.join(found.select("node", "ancestor"), ["node", "ancestor"], "left_anti").withColumn("level", F.lit(level)))
        if front.isEmpty():
            return found
        found = found.unionByName(front)
    raise RuntimeError(f"a hierarchy of more than {levels} levels")


def nearest_by_rank(ancestors: DataFrame, nodes: DataFrame, node: str, rank: str, name: str, ranks: list[str]) -> DataFrame:
    """(node, one column for each rank): the name of the closest ancestor of that rank, the least of equals."""
    named = ancestors.join(nodes.select(F.col(node).alias("ancestor"), F.col(rank).alias("rank"), F.col(name).alias("name")), "ancestor")
    near = F.min_by("name", F.struct("level", "name"))
    return named.filter(F.col("rank").isin(ranks)).groupBy("node").pivot("rank", ranks).agg(near)


def backfill(df: DataFrame, ranks: list[str]) -> DataFrame:
    """Fill missing higher ranks by the most frequent value among the rows that share a lower one.

    ``ranks`` run from high to low; the last fills nothing. Each pass sees what
    the earlier filled; of equally frequent values the smallest counts.
    """
    for i in range(1, len(ranks) - 1):
        base, higher = ranks[i], ranks[:i]
        for h in higher:
            mode = mode_by(df.filter(F.col(base).isNotNull()), [base], h).withColumnRenamed(h, "__mode")
            df = df.join(mode, base, "left").withColumn(h, F.coalesce(h, "__mode")).drop("__mode")
    return df


#: Ranks whose names begin with the genus.
BELOW_GENUS = ("SPECIES", "SUBSPECIES", "VARIETY", "FORM", "SUBVARIETY", "SUBFORM", "LUSUS")


def genus_from_name(df: DataFrame, name: str = "name", rank: str = "rank", genus: str = "genus") -> DataFrame:
    """Fill a missing genus by the first word of the name of a species or below that has more than one."""
    known = F.upper(F.col(rank)).isin(*BELOW_GENUS) & F.col(name).contains(" ")
    return df.withColumn(genus, F.coalesce(F.col(genus), F.when(known, F.split_part(F.col(name), F.lit(" "), F.lit(1)))))


def complete_ranks(df: DataFrame, ranks: list[str], name: str = "name", rank: str = "rank") -> DataFrame:
    """:func:`genus_from_name` if ``ranks`` hold the genus, then :func:`backfill`."""
    return backfill(genus_from_name(df, name, rank) if "genus" in ranks else df, ranks)


def orphans_to_parents(df: DataFrame, key: str, name: str, domain: str, rank: str, order: list[Column]) -> DataFrame:
    """(key, parent): a parent by name for rows without one.

    Two words go to the GENUS of the first, three or more to the SPECIES of the
    first two, in the same domain; the first accepted one by ``order``.
    """
    words = F.split(F.col(name), " ")
    wanted = F.when(F.size(words) == 2, F.get(words, 0)).when(F.size(words) > 2, F.concat_ws(" ", F.get(words, 0), F.get(words, 1)))
    kind = F.when(F.size(words) == 2, "GENUS").when(F.size(words) > 2, "SPECIES")
    lone = df.filter("parent is null").select(F.col(key), F.col(domain), wanted.alias(name), kind.alias(rank)).filter(F.col(name).isNotNull())
    accepted = first_by(df.filter("accepted"), [domain, name, rank], [*order, F.col(key)]).select(domain, name, rank, F.col(key).alias("parent"))
    return lone.join(accepted, [domain, name, rank]).filter(F.col(key) != F.col("parent")).select(key, "parent")


def cascade(df: DataFrame, key: str = "id", parent: str = "parent", rounds: int = LEVELS) -> DataFrame:
    """Accept unaccepted parents of accepted rows, and theirs, with the union of their children's accepted_by.

    Runs to the fixed point; RuntimeError if ``rounds`` were too few for it.
    """
    state = cut(df)
    for _ in range(rounds):
        votes = (
            state.filter("accepted").filter(F.col(parent).isNotNull()).select(F.col(parent).alias(key), F.explode_outer("accepted_by").alias("by"))
            .groupBy(key).agg(F.sort_array(F.collect_set("by")).alias("__by"))
        )
        raised = state.join(votes, key, "left")
        new = ~F.col("accepted") & F.col("__by").isNotNull()
        state = cut(raised.withColumn("__new", new).withColumn("accepted_by", F.when(F.col("__new"), F.col("__by")).otherwise(F.col("accepted_by"))).withColumn("accepted", F.col("accepted") | F.col("__new")).drop("__by"))
        if not state.filter("__new").limit(1).count():
            return state.drop("__new").select(*df.columns)
        state = state.drop("__new")
    raise RuntimeError(f"rows are still accepted after {rounds} rounds")


def repair_parents(df: DataFrame, key: str = "id", name: str = "name", parent: str = "parent") -> DataFrame:
    """Parents of accepted rows that are no accepted row give way to the accepted row of the parent's name, the least of several, else to null.

    Unaccepted rows keep their parents.
    """
    accepted = df.filter("accepted")
    sound = accepted.select(F.col(key).alias(parent), F.lit(True).alias("__sound")).distinct()
    called = df.groupBy(F.col(key).alias(parent)).agg(F.min(name).alias("__called"))
    by_name = accepted.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("__called")).agg(F.min(key).alias("__other"))
    met = df.join(sound, parent, "left").join(called, parent, "left").join(by_name, "__called", "left")
    mended = F.when(~F.col("accepted") | F.col("__sound"), F.col(parent)).otherwise(F.col("__other"))
    return met.withColumn(parent, mended).select(*df.columns)


def with_child_count(df: DataFrame, key: str = "id", parent: str = "parent") -> DataFrame:
    """Null parents that no row has, then add child_count."""
    ids = df.select(F.col(key).alias(parent)).filter(F.col(parent).isNotNull()).distinct().withColumn("__there", F.lit(True))
    kept = df.join(ids, parent, "left").withColumn(parent, F.when(F.col("__there"), F.col(parent))).drop("__there").select(*df.columns)
    counts = kept.filter(F.col(parent).isNotNull()).groupBy(F.col(parent).alias(key)).agg(F.count(F.lit(1)).alias("child_count"))
    return kept.join(counts, key, "left").withColumn("child_count", F.coalesce("child_count", F.lit(0)))


def descendants(edges: DataFrame, roots: DataFrame, node: str = "id", parent: str = "parent", levels: int = 100) -> DataFrame:
    """(node, root): everything below the roots, the roots included; the least root of several."""
    front = cut(roots.select(F.col(node).alias("node"), F.col(node).alias("root")))
    found = front
    down = edges.select(F.col(parent).alias("node"), F.col(node).alias("__child")).filter("node is not null")
    for _ in range(levels):
        met = front.join(down, "node").select(F.col("__child").alias("node"), "root").distinct()
        front = cut(met.join(found, ["node", "root"], "left_anti"))
        if front.isEmpty():
            break
        found = found.unionByName(front)
    return found.groupBy("node").agg(F.min("root").alias("root"))
