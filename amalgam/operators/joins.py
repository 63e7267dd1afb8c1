"""Unions by priority, id matching and upserts, all as equi-joins on one key at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgam.functions.keys import first_by


def fill_from(left: DataFrame, right: DataFrame, on: str, columns: list[str], order: list[str] | None = None) -> DataFrame:
    """Fill nulls of ``columns`` from the one row of ``right`` with the same key.

    Several right rows of a key: the first by ``order`` (default: the columns).
    """
    source = right.filter(F.col(on).isNotNull()).select(on, *columns, *[c for c in order or [] if c not in (on, *columns)])
    source = first_by(source, [on], [F.col(c).asc_nulls_last() for c in order or columns])
    source = source.select(F.col(on), *[F.col(c).alias(f"__{c}") for c in columns])
    out = left.join(source, on, "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"__{c}")) if c in left.columns else F.col(f"__{c}") for c in columns}
    return out.withColumns(filled).drop(*[f"__{c}" for c in columns])


def not_in(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key is in no row of ``right``; null keys match nothing and stay."""
    return left.join(right.select(F.col(right_key or key).alias(key)).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def priority_union(sources: list[tuple[str, DataFrame]], keys: list[str], label: str = "source") -> DataFrame:
    """Rows of each source in turn that share no key with those of an earlier source.

    A key that is missing from a source or null in a row matches nothing. The
    anti-joins run key by key: an OR over keys could not be hashed.
    """
    out = None
    for name, frame in sources:
        new = frame
        if out is not None:
            for key in keys:
                if key in frame.columns and key in out.columns:
                    new = not_in(new, out, key)
        new = new.withColumn(label, F.lit(name))
        out = new if out is None else out.unionByName(new, allowMissingColumns=True)
    return out


def cross_fill(left: DataFrame, lookup: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Fill ids through shared keys: for each (key, id) take the id of the lookup row with that key, if ours is null."""
    for key, wanted in pairs:
        left = fill_from(left, lookup, key, [wanted])
    return left


def best_match(targets: DataFrame, candidates: DataFrame, target_key: str, on: str, order: list[Column], take: str) -> DataFrame:
    """For each target the id ``take`` of its best candidate with an equal ``on``; (target_key, take)."""
    met = targets.join(candidates, on)
    return first_by(met, [target_key], order).select(target_key, take)


def name_fallback(targets: DataFrame, candidates: DataFrame, target_key: str, candidate_key: str, name: str) -> DataFrame:
    """Pair leftovers by name, one to one: the least target and the least candidate of each name."""
    t = first_by(targets.filter(F.col(name).isNotNull()), [name], [F.col(target_key)]).select(name, target_key)
    c = first_by(candidates.filter(F.col(name).isNotNull()), [name], [F.col(candidate_key)]).select(name, candidate_key)
    return t.join(c, name).select(target_key, candidate_key, name)


def redirect(rows: DataFrame, id_col: str, merged: DataFrame, current: str, former: str) -> DataFrame:
    """Replace ids that another row lists in its array ``former`` by that row's ``current`` id.

    The array is exploded to an equi-join; an id that several rows list goes to the least.
    """
    moved = merged.select(F.explode(former).alias(id_col), F.col(current).alias("__to")).groupBy(id_col).agg(F.min("__to").alias("__to"))
    return rows.join(moved, id_col, "left").withColumn(id_col, F.coalesce("__to", id_col)).drop("__to").select(*rows.columns)


def keep_known(rows: DataFrame, id_col: str, known: DataFrame, known_key: str) -> DataFrame:
    """Null ids that ``known`` does not have."""
    have = known.select(F.col(known_key).alias(id_col)).filter(F.col(id_col).isNotNull()).distinct().withColumn("__known", F.lit(True))
    return rows.join(have, id_col, "left").withColumn(id_col, F.when(F.col("__known"), F.col(id_col))).select(*rows.columns)


def polish_ids(rows: DataFrame, id_col: str, name: str, source: DataFrame, source_id: str = "id_raw", source_name: str = "name_clean", status: str | None = None, former: str | None = None) -> DataFrame:
    """The ids of one source in accepted rows, made current; other rows stay as they are.

    In this order: ids that ``former`` lists as merged into another become that
    one; ids that the source lacks become null; with ``status``, ids of a row
    that is not accepted give way to the least accepted id of that row's name;
    missing ids are filled by name, from accepted rows first, then synonyms.
    """
    open_, rest = rows.filter("accepted"), rows.filter("not accepted or accepted is null")
    if former:
        open_ = redirect(open_, id_col, source.filter(F.col(former).isNotNull()), source_id, former)
    open_ = keep_known(open_, id_col, source, source_id)
    place = F.lit(0)
    if status:
        current = source.filter(F.col(status) == "accepted").groupBy(F.col(source_name).alias("__name")).agg(F.min(source_id).alias("__to"))
        stale = source.filter(F.col(status).isNotNull() & (F.col(status) != "accepted")).groupBy(F.col(source_id).alias(id_col)).agg(F.min(source_name).alias("__name"))
        swaps = stale.join(current, "__name").select(id_col, "__to")
        open_ = open_.join(swaps, id_col, "left").withColumn(id_col, F.coalesce("__to", id_col)).drop("__to").select(*rows.columns)
        place = F.when(F.col(status) == "accepted", 0).when(F.col(status) == "synonym", 1).otherwise(2)
    named = source.filter(F.col(source_name).isNotNull()).groupBy(F.col(source_name).alias(name)).agg(F.min(F.struct(place.alias("place"), F.col(source_id).alias("id"))).alias("__best"))
    filled = open_.join(named, name, "left").withColumn(id_col, F.coalesce(F.col(id_col), F.col("__best.id"))).select(*rows.columns)
    return filled.unionByName(rest)


def upsert(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """``base`` with the rows of ``delta`` in place of those with its keys."""
    return base.join(delta.select(key).distinct(), key, "left_anti").unionByName(delta)


def resolve_synonyms(rows: DataFrame, id_col: str, synonyms: DataFrame, synonym: str, accepted: str) -> DataFrame:
    """Replace synonym ids by the least accepted id they stand for; ``<id>_raw`` keeps the old one."""
    lookup = synonyms.groupBy(F.col(synonym).alias(id_col)).agg(F.min(accepted).alias("__to"))
    out = rows.join(lookup, id_col, "left")
    return out.withColumns({f"{id_col}_raw": F.col(id_col), id_col: F.coalesce("__to", id_col)}).drop("__to")
