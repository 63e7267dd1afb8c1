"""Name, author, area and year normalisation as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgam.functions.ranks import HYBRID_RANKS, rank_label, status_label

TIMES = "×"
# Rank terms that are left over inside names.
LEFTOVER_RANKS = [
    "ser", "sect", "subsect", "subgen", "sub", "bb", "ab", "mut", "var", "subvar", "convar", "race", "subsp", "subspec", "ssp", "forma", "form", "subf", "f", "fo", "fma", "unr", "lus",
    "lusus", "prol", "proles", "sp nov", "sp. nov", "f.sp.", "[unranked]",
]
# Signs that stand for an apostrophe.
QUOTES = "\"ʽ‛‟′″‴’‘"
# Fixed value: everything outside lower-case letters and the range from space to apostrophe.
STRAY = "[^a-z -']+"
# Letters with diacritics and their plain forms.
ACCENTED = "àáâãäåāăąçćčďèéêëēėęěìíîïīįıñńňòóôõöøōřśšùúûüūýÿžźż"
PLAIN = "aaaaaaaaacccdeeeeeeeeiiiiiiinnnooooooorssuuuuuyyzzz"


def squeeze(text: Column) -> Column:
    """White space runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def replace_first(text: Column, pattern: str, to: str) -> Column:
    """Replace the first match only (the built-in replaces all)."""
    return F.regexp_replace(text, f"(?s)^(.*?)(?:{pattern})(.*)$", f"$1{to}$2")


def without_term(name: Column, term: Column) -> Column:
    """``name`` lower-cased without a literal term wherever it stands, if it contains it."""
    low, sought = F.lower(name), F.lower(F.trim(term))
    return F.when(low.contains(sought) & (sought != ""), squeeze(F.replace(low, sought, F.lit("")))).otherwise(name)


def _leftover() -> str:
    """A pattern of the leftover terms, grouped by their first letter so that most words fail at once."""
    by_first: dict[str, list[str]] = {}
    for term in LEFTOVER_RANKS:
        by_first.setdefault(re.escape(term[0]), []).append(re.escape(term[1:]))
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_first.items())


def clean_name(name: Column) -> Column:
    """Leftover rank terms, quote variants and stray characters (tabs too) out, spaces squeezed."""
    out = F.regexp_replace(name, rf" (?:notho)?(?:{_leftover()})\.?(?:\s|$)", " ")
    out = F.regexp_replace(F.translate(out, QUOTES, "'" * len(QUOTES)), STRAY, "")
    return F.trim(F.regexp_replace(out, "  +", " "))


def with_hybrids(df: DataFrame, name: str = "name_clean", rank: str | None = "rank_raw") -> DataFrame:
    """Add hybrid and hybridpos (from 0) and take hybrid signs out of the name."""
    marked = F.replace(F.col(name), F.lit(" x "), F.lit(f" {TIMES} "))
    sign = F.instr(marked, TIMES)
    hybrid = sign > 0
    if rank and rank in df.columns:
        hybrid = hybrid | F.coalesce(F.col(rank).startswith("notho") | F.col(rank).isin(HYBRID_RANKS), F.lit(False))
    plain = F.replace(F.replace(marked, F.lit(f"{TIMES} "), F.lit("")), F.lit(TIMES), F.lit(""))
    return df.withColumns({"hybrid": hybrid, "hybridpos": F.when(hybrid & (sign > 0), (sign - 1).cast("short")), name: plain})


def normalise_names(df: DataFrame, name: str = "name_clean", author: str = "author_raw", rank: str = "rank_raw") -> DataFrame:
    """Hybrids, author and rank stripping and cleanup; rows whose name ends up empty go.

    Steps whose column is missing are left out.
    """
    out = with_hybrids(df, name, rank)
    for term in (author, rank):
        if term in df.columns:
            out = out.withColumn(name, F.when(F.col(term).isNull(), F.col(name)).otherwise(without_term(F.col(name), F.col(term))))
    return out.withColumn(name, clean_name(F.col(name))).filter(F.col(name).isNull() | (F.col(name) != ""))


def with_rank_and_status(df: DataFrame, rank: str = "rank_raw", status: str = "status_raw") -> DataFrame:
    """Add rank_clean, and with a status column status_clean, synonym and accepted."""
    out = df.withColumn("rank_clean", rank_label(F.col(rank)))
    if status in df.columns:
        label = status_label(F.col(status))
        out = out.withColumns({"status_clean": label, "synonym": label == "synonym", "accepted": label == "accepted"})
    return out


def author_and_year(text: Column) -> tuple[Column, Column]:
    """Split "Author, 1753" into the author and the year."""
    year = F.nullif(F.regexp_extract(text, r",\s*\(?(\d{4})\)?\s*$", 1), F.lit(""))
    return F.trim(F.regexp_replace(text, r",\s*\(?\d{4}\)?\s*$", "")), year.cast("int")


def year_of(text: Column) -> Column:
    """The first four digits in a row as a year, else null."""
    return F.nullif(F.regexp_extract(text, r"(\d{4})", 1), F.lit("")).cast("int")


def fold(text: Column) -> Column:
    """Lower-case ASCII words: accents folded, & spelled out, dots, backticks and apostrophes gone, the rest to spaces."""
    out = F.translate(F.replace(F.lower(text), F.lit("&"), F.lit(" and ")), ACCENTED, PLAIN)
    out = F.replace(F.regexp_replace(out, "[.`]+", ""), F.lit("'"), F.lit(""))
    return squeeze(F.regexp_replace(out, "[^a-z0-9]+", " "))


def validation_report(df: DataFrame, name: str = "name_clean") -> DataFrame:
    """One row: names of four words or more, names with characters beyond Latin letters, rows."""
    words = F.size(F.split(F.trim(F.col(name)), r"\s+"))
    return df.agg(
        F.count_if(words >= 4).alias("long_names"),
        F.count_if(F.col(name).rlike(r"[^\x00-\x7FÀ-ɏ×]")).alias("non_latin"),
        F.count(F.lit(1)).alias("rows"),
    )
