"""Free-text areas to codes, and first mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgam.functions.keys import first_by
from amalgam.functions.text import fold


def area_candidates(areas: DataFrame, area: str = "area") -> DataFrame:
    """(area, candidate, pass): readings of a text from literal to bold."""
    a = F.col(area)
    text = areas.select(area).filter(a.isNotNull() & (F.trim(a) != "")).distinct()
    readings = F.concat(
        F.array(
            F.struct(F.lit(0).alias("pass"), a.alias("candidate")),
            F.struct(F.lit(1).alias("pass"), F.trim(F.regexp_replace(a, r"\([^)]*\)", "")).alias("candidate")),
            F.struct(F.lit(2).alias("pass"), F.when(a.contains(";"), F.trim(F.split_part(a, F.lit(";"), F.lit(1)))).alias("candidate")),
            F.struct(F.lit(4).alias("pass"), F.when(a.contains(","), F.trim(F.regexp_extract(a, "([^,]+)$", 1))).alias("candidate")),
        ),
        F.transform(F.split(a, ","), lambda part: F.struct(F.lit(3).alias("pass"), F.trim(part).alias("candidate"))),
    )
    return text.select(area, F.inline(readings)).filter("candidate is not null and candidate != ''")


def match_areas(areas: DataFrame, gazetteer: DataFrame, area: str = "area", name: str = "name", code: str = "code") -> DataFrame:
    """(area, code): the code of the first reading that the gazetteer knows, the longest of a pass; a bare two-letter code stands for itself.

    Names are compared folded; of several codes of a folded name the least counts.
    """
    known = gazetteer.groupBy(fold(F.col(name)).alias("__folded")).agg(F.min(code).alias("code"))
    met = area_candidates(areas, area).withColumn("__folded", fold(F.col("candidate"))).join(known, "__folded")
    best = first_by(met, [area], [F.col("pass"), F.length("candidate").desc(), F.col("code")]).select(area, "code")
    iso = areas.select(area).distinct().filter(F.trim(area).rlike("^[A-Za-z]{2}$")).join(best, area, "left_anti")
    return best.unionByName(iso.select(area, F.lower(F.trim(area)).alias("code")))


def first_mentions(pages: DataFrame, name: str, year: str, key: str, kinds: dict[str, str]) -> DataFrame:
    """(name, kind, key, year): the earliest page of each name in each category, the least key of a year.

    ``kinds`` maps a category to an SQL condition.
    """
    out = None
    for kind, condition in kinds.items():
        rows = pages.filter(F.col(year).isNotNull()).filter(condition)
        first = rows.groupBy(name).agg(F.min(F.struct(F.col(year).alias("y"), F.col(key).alias("k"))).alias("f"))
        found = first.select(name, F.lit(kind).alias("kind"), F.col("f.k").alias(key), F.col("f.y").alias(year))
        out = found if out is None else out.unionByName(found)
    return out


def joined_titles(rows: DataFrame, key: str, value: str, most: int = 100) -> DataFrame:
    """(key, titles): sorted values joined by ", " and cut to ``most`` characters."""
    text = F.array_join(F.sort_array(F.collect_list(value)), ", ")
    return rows.groupBy(key).agg(F.substring(text, 1, most).alias("titles"))
