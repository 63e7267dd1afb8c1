"""Majority votes of several authorities on one attribute."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgam.functions.arrays import list_mode, n_distinct
from amalgam.functions.ranks import RANKS


def vote(pool: Column, trim: bool = False) -> Column:
    """The winner of an array of votes in authority order: most frequent, ties to the earlier authority."""
    winner = list_mode(pool)
    return F.trim(winner) if trim else winner


def ambiguous(pool: Column) -> Column:
    """Whether the authorities disagree."""
    return n_distinct(pool) > 1


def short_or_quoted(name: Column) -> Column:
    """A name of at most three words, or one with a quote; others are no candidates."""
    return F.when((F.size(F.split(name, " ")) < 4) | name.contains("'"), name)


def known_rank(rank: Column) -> Column:
    return F.when(F.upper(rank).isin(RANKS), F.upper(rank))


def plausible_year(year: Column, first: int = 1700) -> Column:
    return F.when(year.between(F.lit(first), F.year(F.current_date())), year)


ADMIT: dict[str, Callable[[Column], Column]] = {"name_clean": short_or_quoted, "rank_clean": known_rank, "year": plausible_year}


def consensus(
    rows: DataFrame, authorities: list[tuple[str, DataFrame, str]], column: str, fallback: str | None = None, keep_pool: bool = False
) -> DataFrame:
    """Add ``<field>_consensus``: the vote of all authorities that have ``column``.

    An authority is (name, frame with id_raw, the column of ``rows`` that holds
    its id). Its rows are one for each id; what :data:`ADMIT` turns to null does
    not vote. ``fallback`` names the column used where nobody votes.
    """
    field = column.split("_")[0]
    admit = ADMIT.get(column, lambda c: c)
    out, votes = rows, []
    for name, frame, id_col in authorities:
        if column not in frame.columns:
            continue
        mine = f"__{field}_{name}"
        given = frame.filter(F.col("id_raw").isNotNull()).groupBy(F.col("id_raw").alias(id_col)).agg(F.min(admit(F.col(column))).alias(mine))
        out = out.join(given, id_col, "left")
        votes.append(mine)
    pool = F.array(*votes) if votes else F.array().cast("array<string>")
    is_text = dict(out.dtypes).get(votes[0]) == "string" if votes else True
    winner = vote(pool, trim=is_text)
    out = out.withColumn(f"{field}_pool", pool).withColumn(f"{field}_consensus", F.coalesce(winner, F.col(fallback)) if fallback else winner)
    return out.drop(*votes, *([] if keep_pool else [f"{field}_pool"]))


def parent_votes(rows: DataFrame, authorities: list[tuple[str, DataFrame, str]], key: str = "id_meso", name: str = "name_consensus", domain: str = "kingdom") -> DataFrame:
    """(key, authority, parent): each authority's parent as a row key.

    A parent resolves to the accepted row of its (domain, name), else to the
    authority's own row; the least key of several.
    """
    accepted = rows.filter("accepted").groupBy(domain, name).agg(F.min(key).alias("canonical"))
    out = None
    for label, frame, id_col in authorities:
        child = rows.filter(F.col(id_col).isNotNull()).select(key, F.col(id_col).alias("id_raw")).join(frame.select("id_raw", "parent_raw"), "id_raw").filter("parent_raw is not null")
        parent = rows.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("parent_raw"), F.col(key).alias("own"), F.col(domain).alias(domain), F.col(name).alias(name))
        met = child.join(parent, "parent_raw").join(accepted, [domain, name], "left")
        best = met.groupBy(key).agg(F.min("canonical").alias("c"), F.min("own").alias("o")).select(key, F.lit(label).alias("authority"), F.coalesce("c", "o").alias("parent"))
        out = best if out is None else out.unionByName(best)
    return out
