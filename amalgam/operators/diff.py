"""Differences between two snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amalgam.operators.checks import content_hash

SUSPICIOUS = 0.1
SAMPLES, SAMPLES_IF_SUSPICIOUS = 2000, 200


def common_columns(a: DataFrame, b: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c in a.columns and c in b.columns]


def _scope(accepted: str | None) -> Column:
    return F.coalesce(F.col(accepted), F.lit(False)) if accepted else F.lit(True)


def changes(current: DataFrame, previous: DataFrame, key: str, tracked: list[str], accepted: str | None = None, context: list[str] = (), rekeys: bool = False) -> DataFrame:
    """(category, id, old_id, fields): new, deleted and changed rows with the fields that differ.

    Rows out of scope (``accepted`` not true) count as absent. With ``rekeys``,
    a new and a deleted row whose tracked and context columns are null-safe
    equal, each the only one of its kind on its side, become one changed row
    with its old id and the field "id_raw".
    """
    tracked = common_columns(current, previous, tracked)
    content = tracked + [c for c in common_columns(current, previous, list(context)) if c not in tracked]

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.filter(_scope(accepted)).select(F.col(key).cast("string").alias("id"), F.lit(True).alias(f"{p}in"), *[F.col(c).alias(f"{p}{c}") for c in content])

    both = side(current, "c_").join(side(previous, "p_"), "id", "full")
    here, there = F.col("c_in").isNotNull(), F.col("p_in").isNotNull()
    differs = F.array_compact(F.array(*[F.when(~F.col(f"c_{c}").eqNullSafe(F.col(f"p_{c}")), F.lit(c)) for c in tracked])) if tracked else F.array().cast("array<string>")
    fields = F.when(here & there, differs).otherwise(F.array().cast("array<string>"))
    category = F.when(~there, "new").when(~here, "deleted").when(F.size(differs) > 0, "changed")
    tagged = both.withColumns({"category": category, "fields": fields}).filter("category is not null")
    plain = tagged.select("category", "id", F.lit(None).cast("string").alias("old_id"), "fields")
    if not rekeys or not content:
        return plain

    def lonely(which: str, p: str) -> DataFrame:
        kinds = tagged.filter(F.col("category") == which).groupBy(*[f"{p}{c}" for c in content])
        return kinds.agg(F.count(F.lit(1)).alias("__n"), F.min("id").alias("id")).filter("__n = 1").drop("__n")

    n, d = lonely("new", "c_"), lonely("deleted", "p_").withColumnRenamed("id", "old_id")
    same = F.lit(True)
    for c in content:
        same = same & F.col(f"c_{c}").eqNullSafe(F.col(f"p_{c}"))
    moved = n.join(d, same).select(F.lit("changed").alias("category"), "id", "old_id", F.array(F.lit("id_raw")).alias("fields"))
    rest = plain.join(moved.select("id", F.lit("new").alias("category")), ["id", "category"], "left_anti")
    rest = rest.join(moved.select(F.col("old_id").alias("id"), F.lit("deleted").alias("category")), ["id", "category"], "left_anti")
    return rest.select("category", "id", "old_id", "fields").unionByName(moved)


def summary(found: DataFrame, current: DataFrame, previous: DataFrame, accepted: str | None = None) -> DataFrame:
    """One row: counts, scopes, whether over a tenth of the rows moved, and whether samples get cut."""
    counts = found.agg(*[F.count_if(F.col("category") == c).alias(f"n_{c}") for c in ("new", "changed", "deleted")])
    scopes = current.filter(_scope(accepted)).agg(F.count(F.lit(1)).alias("cur_scope")).crossJoin(previous.filter(_scope(accepted)).agg(F.count(F.lit(1)).alias("prev_scope")))
    top = F.greatest("n_new", "n_changed", "n_deleted")
    out = counts.crossJoin(scopes).withColumn("suspicious", top / F.greatest("prev_scope", F.lit(1)) > SUSPICIOUS)  # single rows
    return out.withColumn("truncated", top > F.when(F.col("suspicious"), SAMPLES_IF_SUSPICIOUS).otherwise(SAMPLES))


def samples(found: DataFrame, most: int = SAMPLES) -> DataFrame:
    """The first ``most`` rows of each category by id."""
    place = F.row_number().over(Window.partitionBy("category").orderBy("id"))
    return found.withColumn("nth", place).filter(F.col("nth") <= most)


def first_release(current: DataFrame, key: str, accepted: str | None = None) -> DataFrame:
    """All rows in scope as new."""
    return current.filter(_scope(accepted)).select(F.lit("new").alias("category"), F.col(key).cast("string").alias("id"), F.lit(None).cast("string").alias("old_id"), F.array().cast("array<string>").alias("fields"))


def release_changes(current: DataFrame, previous: DataFrame | None, key: str, tracked: list[str], accepted: str | None = None, **how) -> tuple[str, DataFrame]:
    """("first", all rows in scope as new), ("unchanged", no rows) if both snapshots have equal content, or ("diff", :func:`changes`).

    Content is compared by a hash over all rows, whatever their order, so an
    unchanged release costs two scans and no join.
    """
    if previous is None:
        return "first", first_release(current, key, accepted)
    if sorted(current.columns) == sorted(previous.columns) and content_hash(current.select(*sorted(current.columns))) == content_hash(previous.select(*sorted(current.columns))):
        return "unchanged", first_release(current, key, accepted).limit(0)
    return "diff", changes(current, previous, key, tracked, accepted, **how)
