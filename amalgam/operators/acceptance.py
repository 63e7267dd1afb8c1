"""Acceptance by the status votes of authorities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgam.functions.ranks import rank_ordinal


def decide(
    rows: DataFrame,
    authorities: list[tuple[str, DataFrame, str]],
    domain: str = "kingdom",
    lists: dict[str, list[str]] | None = None,
    popular: tuple[str, str, int, str] | None = None,
) -> DataFrame:
    """Add accepted_by, considered_synonym (authority names in order), synonym and accepted.

    ``lists`` names the authorities that count in each domain (default: all).
    ``popular`` is (label, column, more than, least rank): rows above it that
    nobody calls a synonym are accepted by the label too.
    """
    out, voters = rows, []
    for name, frame, id_col in authorities:
        votes = frame.filter(F.col("id_raw").isNotNull()).groupBy(F.col("id_raw").alias(id_col)).agg(
            F.bool_or(F.col("status_clean") == "accepted").alias(f"__a_{name}"), F.bool_or(F.col("status_clean") == "synonym").alias(f"__s_{name}")
        )
        out = out.join(votes, id_col, "left")
        voters.append(name)

    def named(prefix: str):
        def counts(name):
            inside = F.lit(True) if lists is None else F.col(domain).isin([d for d, names in lists.items() if name in names] or [""])
            return F.when(F.col(f"__{prefix}_{name}") & inside, F.lit(name))

        return F.array_compact(F.array(*[counts(v) for v in voters]))

    out = out.withColumns({"accepted_by": named("a"), "considered_synonym": named("s")})
    out = out.withColumn("synonym", F.size("considered_synonym") > 0)
    if popular:
        label, column, more, least = popular
        by_pages = ~F.col("synonym") & (F.col(column) > more) & (rank_ordinal(F.col("rank_consensus")) >= rank_ordinal(F.lit(least)))
        out = out.withColumn("accepted_by", F.when(F.coalesce(by_pages, F.lit(False)), F.array_append("accepted_by", F.lit(label))).otherwise(F.col("accepted_by")))
    return out.withColumn("accepted", F.size("accepted_by") > 0).drop(*[f"__{p}_{v}" for p in "as" for v in voters])
