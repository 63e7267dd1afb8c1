"""The order of a release: backbone, ids, votes, keys, acceptance, tree, checks, package."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgam.functions.keys import name_key, uuid5
from amalgam.functions.text import normalise_names, with_rank_and_status
from amalgam.operators import acceptance, dedupe, joins, tree, vote
from amalgam.sources.releases import LocalStorage, latest_release, previous_release, release_version
from amalgam.sources.writers import write_parquet, write_tsv
from amalgam.session import cut


@dataclass
class Authority:
    """A processed source: rows with id_raw, and the shared id column that points to them."""

    name: str
    frame: DataFrame
    id_col: str
    keys: list[str] = field(default_factory=list)


def process(raw: DataFrame) -> DataFrame:
    """A raw source with name_clean, rank_raw, status_raw and so on to a processed one."""
    return with_rank_and_status(normalise_names(raw))


def fuse(authorities: list[Authority], accept: list[str] | None = None) -> DataFrame:
    """One row for each taxon of all authorities, highest priority first."""
    id_cols = [a.id_col for a in authorities]
    sources = [(a.name, a.frame.withColumn(a.id_col, F.col("id_raw")).select(*{*[c for c in id_cols if c in a.frame.columns or c == a.id_col], "name_clean", "kingdom"})) for a in authorities]
    rows = joins.priority_union(sources, [*id_cols, "name_clean"])
    for a in authorities:
        lookup = a.frame.withColumn(a.id_col, F.col("id_raw"))
        pairs = [(k, a.id_col) for k in [*id_cols, "name_clean"] if k != a.id_col and k in lookup.columns and k in rows.columns]
        rows = cut(joins.cross_fill(rows, lookup, pairs))
    ballots = [(a.name, a.frame, a.id_col) for a in authorities]
    for column, fallback in (("name_clean", "name_clean"), ("rank_clean", None), ("author_raw", None), ("year", None)):
        rows = vote.consensus(rows, ballots, column, fallback)
    rows = rows.withColumn("id_meso", uuid5(name_key(F.col("kingdom"), F.col("rank_consensus"), F.replace("name_consensus", F.lit(" "), F.lit(".")), F.col("author_consensus"), F.col("year_consensus").cast("string"))))
    quality = [c for c in rows.columns if c.endswith("_consensus")]
    rows = cut(dedupe.merge_duplicates(rows, "id_meso", [*quality, *id_cols], [F.col(c).asc_nulls_last() for c in ("source", *id_cols)]))
    rows = acceptance.decide(rows, [b for b in ballots if accept is None or b[0] in accept])
    rows = rows.withColumn("year", F.col("year_consensus"))
    rows = dedupe.dedupe_accepted(rows, ["kingdom", "name_consensus", "rank_consensus"], "id_meso", unions=["accepted_by"])
    votes = vote.parent_votes(rows, ballots)
    order = F.create_map(*[x for i, a in enumerate(authorities) for x in (F.lit(a.name), F.lit(i))])
    pool = votes.groupBy("id_meso").agg(F.sort_array(F.collect_list(F.struct(order[F.col("authority")].alias("o"), "parent"))).alias("p"))
    parents = pool.select("id_meso", vote.vote(F.transform("p", lambda x: x["parent"])).alias("parent"))
    rows = cut(rows.join(parents, "id_meso", "left"))
    lone = tree.orphans_to_parents(rows, "id_meso", "name_consensus", "kingdom", "rank_consensus", [F.size("accepted_by").desc()])
    rows = rows.join(lone.withColumnRenamed("parent", "__p"), "id_meso", "left").withColumn("parent", F.coalesce("parent", "__p")).drop("__p")
    rows = tree.cascade(rows, "id_meso", "parent")
    return tree.with_child_count(rows, "id_meso", "parent")


def with_higher_ranks(rows: DataFrame, ranks: tuple[str, ...] = ("PHYLUM", "CLASS", "ORDER", "FAMILY", "GENUS", "SPECIES")) -> DataFrame:
    """Add a column for each rank: the nearest ancestor's name, then filled from rows that share a lower rank."""
    ancestors = tree.closure(rows, "id_meso", "parent")
    near = tree.nearest_by_rank(ancestors, rows, "id_meso", "rank_consensus", "name_consensus", list(ranks))
    named = near.select(F.col("node").alias("id_meso"), *[F.col(r).alias(r.lower()) for r in ranks])
    return tree.backfill(rows.join(named, "id_meso", "left"), [r.lower() for r in ranks])


def package(rows: DataFrame, storage: LocalStorage, dates: list[int], sources: dict | None = None, geo: DataFrame | None = None, changes: tuple[str, DataFrame] | None = None, checks: DataFrame | None = None, csv: bool = False) -> str:
    """Write the release and its manifest below a new version; returns the version.

    The tables are written by Spark, so ``storage`` has to be a folder that
    driver and executors share. ``geo``, the kind and rows of ``changes``
    (:func:`amalgam.operators.diff.release_changes`) and the results of
    ``checks`` get files and manifest entries of their own.
    """
    version = release_version(dates)
    folder = storage.root / version
    manifest: dict = {"version": version, "sources": sources or {}}
    write_parquet(rows, str(folder / f"{version}.parquet"))
    if csv:
        write_tsv(rows, str(folder / f"{version}.tsv"))
    if geo is not None:
        write_parquet(geo, str(folder / f"{version}.geo.parquet"))
        manifest["geo"] = f"{version}.geo.parquet"
    if changes is not None:
        kind, found = changes
        write_parquet(found, str(folder / f"{version}.diff.parquet"))
        counts = {r.category: r["count"] for r in found.groupBy("category").count().collect()}  # three kinds
        manifest["diff"] = {"kind": kind, "file": f"{version}.diff.parquet", "counts": {c: counts.get(c, 0) for c in ("new", "changed", "deleted")}}
    if checks is not None:
        manifest["litmus"] = [r.asDict() for r in checks.collect()]  # a row for each check
    storage.write_json(f"{version}/manifest.json", manifest)
    return version


def lookup(storage: LocalStorage, which: str = "latest") -> dict | None:
    """The manifest of a release: "latest", "previous" or a version; None if there is none."""
    latest = latest_release(storage)
    version = latest if which == "latest" else (latest and previous_release(storage, latest)) if which == "previous" else which
    return storage.read_json(f"{version}/manifest.json") if version and storage.exists(f"{version}/manifest.json") else None
