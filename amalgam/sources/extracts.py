"""One processed table for each public source, from its raw files as DataFrames.

The raw columns keep the names of the delivered files (see the readers); a
result has a row for each name: id_raw, name_clean, author_raw, rank_raw and
rank_clean, status, parents, years and cross-links as far as the source has
them. Joins are equi-joins that keep every name; lists are sorted and distinct,
and where a source gives several values for one the least counts, so reruns
agree. Values that are no number become null instead of failing.

``codes`` maps language tags to short ones (unknown tags stay); ``gazetteer``
has the columns name and code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgam.functions.keys import first_by
from amalgam.functions.text import author_and_year, clean_name, squeeze, with_hybrids, with_rank_and_status, without_term, year_of
from amalgam.operators.areas import first_mentions, joined_titles, match_areas
from amalgam.operators.tree import descendants
from amalgam.operators.vernacular import normalise_languages

LSID = "urn:lsid:ipni.org:names:"
# Fixed value: what a citation holds before its volume, issue and page.
BEFORE_VOLUME = r"^(.*?)(?:\s+\d+(?:\s*\([^)]*\))?(?:\s*:|$))"
KINGDOMS = ("plantae", "fungi")


# ---------------------------------------------------------------- parts that sources share


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null if there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def whole(text: Column) -> Column:
    """A whole number, null for any other text."""
    return text.cast("string").try_cast("long")


def publication(text: Column) -> Column:
    """A citation's title without a leading "in", its volume and pages; 120 characters at most."""
    return F.nullif(F.substring(F.trim(F.regexp_extract(F.regexp_replace(text, "^[Ii]n:? ", ""), BEFORE_VOLUME, 1)), 1, 120), F.lit(""))


def lower_of(df: DataFrame, *names: str) -> list[Column]:
    """Lower-cased columns under their own names."""
    return [F.lower(df[f"`{n}`"]).alias(n) for n in names]


def with_list(df: DataFrame, rows: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """``df`` with the sorted distinct ``value`` of the rows whose ``key`` is its id_raw; null where there is none."""
    listed = rows.filter(F.col(f"`{key}`").isNotNull() & value.isNotNull()).groupBy(F.col(f"`{key}`").alias("id_raw")).agg(F.sort_array(F.collect_set(value)).alias(name))
    return df.join(listed, "id_raw", "left")


def with_tagged_names(df: DataFrame, rows: DataFrame, codes: dict[str, str]) -> DataFrame:
    """``df`` with vernacular, an array of "lang:name", from rows (id_raw, lang, name)."""
    coded = normalise_languages(rows.filter("lang is not null and trim(name) != ''"), "lang", codes)
    return with_list(df, coded, "id_raw", F.concat_ws(":", "lang", F.trim("name")), "vernacular")


def processed(df: DataFrame, *strip: str) -> DataFrame:
    """Terms of the columns ``strip`` out of the name, hybrid signs read, name cleaned, rank and status labelled; rows left without a name go."""
    for term in strip:
        df = df.withColumn("name_clean", F.when(F.col(term).isNull(), F.col("name_clean")).otherwise(without_term(F.col("name_clean"), F.col(term))))
    said = F.coalesce("hybrid", F.lit(False)) if "hybrid" in df.columns else F.lit(False)
    marked = with_hybrids(df.withColumn("said_hybrid", said))
    clean = marked.withColumn("hybrid", F.col("hybrid") | F.col("said_hybrid")).drop("said_hybrid").withColumn("name_clean", clean_name(F.col("name_clean")))
    kept = clean.filter("name_clean != ''")
    return with_rank_and_status(kept) if "rank_raw" in df.columns else kept


def areas_of(code: Column, country: Column) -> Column:
    """An area code without its scheme and country suffix, else a two-letter country."""
    low = F.lower(code)
    return F.when(low.startswith("tdwg:"), F.replace(F.replace(low, F.lit("tdwg:"), F.lit("")), F.lit("-oo"), F.lit(""))).when(F.length(country) == 2, F.lower(country))


# ---------------------------------------------------------------- plants


def ipni(names: DataFrame, taxa: DataFrame, relations: DataFrame, references: DataFrame) -> DataFrame:
    """Plant names registry: Name, Taxon, NameRelation and Reference files of a ColDP archive."""
    year = F.col("`col:publishedInYear`")
    # fixed values: two years with typing errors
    mended = F.when(year == "71997", 1997).when(year == "187", 1876).otherwise(whole(year)).cast("int")
    family = taxa.groupBy(F.col("`col:nameID`").alias("id_raw")).agg(F.min(F.lower("`col:family`")).alias("family"))
    remarks = F.lower("`col:remarks`")
    cited = first_by(references, ["col:ID"], [F.col("`col:title`").asc_nulls_last(), F.col("`col:remarks`").asc_nulls_last()]).select(
        F.col("`col:ID`").alias("reference"),
        F.substring("`col:title`", 1, 120).alias("publication"),
        matched(remarks, r"\[bhl_title_id:(\d+)\]").cast("long").alias("bhl_title"),
        matched(remarks, r"\[bhl_page_id:(\d+)\]").cast("long").alias("bhl_page"),
    )
    name = F.col("`col:scientificName`")
    out = names.select(
        F.col("`col:ID`").alias("id_raw"), name.alias("name_raw"),
        F.replace(F.replace(F.lower(name), F.lit(" sieber ex dc. "), F.lit(" ")), F.lit(" dc. "), F.lit(" ")).alias("name_clean"),
        F.col("`col:authorship`").alias("author_raw"), F.col("`col:rank`").alias("rank_raw"), mended.alias("year"), F.col("`col:referenceID`").alias("reference"),
    )
    out = with_list(out.join(family, "id_raw", "left"), relations, "col:nameID", F.struct(F.col("`col:relatedNameID`").alias("id"), F.col("`col:type`").alias("type")), "synonyms")
    return processed(out.join(cited, "reference", "left").drop("reference"), "rank_raw")


def wcvp(names: DataFrame, distribution: DataFrame) -> DataFrame:
    """Plant checklist: names and distribution, separated by bars."""
    sign = F.lit("×")
    genus, species = F.coalesce(F.col("genus_hybrid") == sign, F.lit(False)), F.coalesce(F.col("species_hybrid") == sign, F.lit(False))
    life = F.col("lifeform_description")
    out = names.select(
        F.col("plant_name_id").alias("id_raw"), F.col("taxon_name").alias("name_raw"), F.lower("taxon_name").alias("name_clean"), F.col("taxon_rank").alias("rank_raw"),
        *lower_of(names, "family", "genus", "species"),
        (genus | species).alias("hybrid"), F.when(genus, "genus").when(species, "species").alias("hybrid_type"), "hybrid_formula",
        F.col("parent_plant_name_id").alias("parent_raw"), F.trim("primary_author").alias("author_raw"), F.col("taxon_status").alias("status_raw"),
        F.substring("place_of_publication", 1, 120).alias("publication_short"), year_of(F.col("first_published")).alias("year"), (F.col("reviewed") == "Y").alias("reviewed"),
        "ipni_id", "powo_id", life.contains("annual").alias("annual"), life.contains("perennial").alias("perennial"),
    )
    area = F.lower(F.coalesce(F.col("area_code_l3"), F.col("region_code_l2").cast("string"), F.col("continent_code_l1").cast("string")))
    out = with_list(out, distribution.filter("introduced = 0"), "plant_name_id", area, "native_to")
    return processed(with_list(out, distribution, "plant_name_id", area, "regions"), "rank_raw")


def powo(taxa: DataFrame) -> DataFrame:
    """Plants online: the taxon file with its 31 given names."""
    life = F.get_json_object("dynamicProperties", "$.lifeform")
    bare = lambda c: F.replace(F.col(c), F.lit(LSID), F.lit(""))
    out = taxa.select(
        bare("taxonID").alias("id_raw"), F.col("scientificName").alias("name_raw"), F.lower("scientificName").alias("name_clean"), F.col("verbatimTaxonRank").alias("rank_raw"),
        *lower_of(taxa, "kingdom", "phylum", "class", "order", "family", "genus"),
        bare("parentNameUsageID").alias("parent_raw"), F.trim("scientificNameAuthorship").alias("author_raw"), F.col("taxonomicStatus").alias("status_raw"),
        publication(F.col("namePublishedIn")).alias("publication_short"), whole(F.substring(F.col("namePublishedInYear").cast("string"), 1, 4)).cast("int").alias("year"),
        F.replace("source", F.lit("wcvp:"), F.lit("")).alias("wcvp_id"), life.contains("annual").alias("annual"), life.contains("perennial").alias("perennial"),
    )
    return processed(out, "rank_raw")


def wfo(classification: DataFrame, references: DataFrame) -> DataFrame:
    """World flora: rows marked as not to process and broken names go, broken authors become null."""
    titles = references.select(F.col("taxonID").alias("id_raw"), matched(F.lower("relation"), r"bhl\.title\.(\d+)").cast("long").alias("bhl_title"))
    titles = titles.filter("bhl_title is not null").groupBy("id_raw").agg(F.min("bhl_title").alias("bhl_title"))
    link, author = F.col("scientificNameID"), F.trim("scientificNameAuthorship")
    shown = F.regexp_replace(F.regexp_extract(F.regexp_replace("namePublishedIn", "^[Ii]n:? ", ""), BEFORE_VOLUME, 1), r"\s+:\s*$", "")
    rows = classification.filter(F.col("doNotProcess_reason").isNull() & ~F.coalesce(F.lower("scientificName").startswith("#name"), F.lit(False)))
    out = rows.select(
        F.col("taxonID").alias("id_raw"), F.col("scientificName").alias("name_raw"), F.lower("scientificName").alias("name_clean"), F.col("taxonRank").alias("rank_raw"),
        *lower_of(rows, "family", "genus"), F.col("parentNameUsageID").alias("parent_raw"), F.when(~author.startswith("#"), author).alias("author_raw"),
        F.col("taxonomicStatus").alias("status_raw"), link.alias("links_raw"), matched(F.col("namePublishedIn"), r"\((\d{4})\)").cast("int").alias("year"),
        F.nullif(F.trim(shown), F.lit("")).alias("publication_short"), F.coalesce(whole(F.col("tropicosId")), whole(link)).alias("tropicos_id"),
        matched(link, r"urn:lsid:ipni\.org:names:([0-9]+-[0-9]+)").alias("ipni_id"),
    )
    return processed(out.join(titles, "id_raw", "left"), "rank_raw")


def tropicos(*specimens: DataFrame) -> DataFrame:
    """Specimen archives: one row a taxon with the earliest year; the rank is read from abbreviations in the name."""
    rows = reduce(DataFrame.unionByName, [s.select("taxonID", "scientificName", "scientificNameAuthorship", "kingdom", "family", "genus", whole(F.col("year")).alias("year")) for s in specimens])
    years = rows.groupBy("taxonID").agg(F.min("year").alias("year"))
    order = [F.col(c).asc_nulls_last() for c in ("scientificName", "scientificNameAuthorship", "kingdom", "family", "genus")]
    one = first_by(rows.drop("year"), ["taxonID"], order).join(years, "taxonID")
    plain = F.lower("scientificName")
    name = F.when(F.col("scientificNameAuthorship").isNull(), plain).otherwise(without_term(plain, F.col("scientificNameAuthorship")))
    short = F.filter(F.regexp_extract_all(name, F.lit(r"\b([a-z]+)\."), F.lit(0)), lambda x: x != "st.")
    abbreviated = F.size(F.regexp_extract_all(name, F.lit(r"\b([a-z]+)\."), F.lit(0))) > 0
    rank = F.when(name.contains("[unranked]"), "unranked").when(abbreviated, F.get(short, F.lit(0))).when(~F.trim(name).contains(" "), "genus").otherwise("species")
    out = one.select(
        whole(F.col("taxonID")).alias("id_raw"), F.col("scientificName").alias("name_raw"), name.alias("name_clean"), F.col("scientificNameAuthorship").alias("author_raw"),
        *lower_of(one, "kingdom", "family", "genus"), F.col("year").cast("int").alias("year"), rank.alias("rank_raw"),
    )
    return processed(out, "rank_raw")


# ---------------------------------------------------------------- fungi


def fungorum(names: DataFrame, taxa: DataFrame, synonyms: DataFrame, references: DataFrame) -> DataFrame:
    """Fungus names: Name, Taxon, Synonym and Reference files."""
    ranks = ["kingdom", "phylum", "class", "order", "family", "genus", "species"]
    placed = first_by(taxa, ["ID"], [F.col("parentID").asc_nulls_last(), *[F.col(f"`{r}`").asc_nulls_last() for r in ranks]])
    placed = placed.select(whole(F.col("ID")).alias("id_raw"), *lower_of(placed, *ranks), F.col("parentID").alias("parent_raw"))
    cited = references.groupBy(whole(F.col("ID")).alias("id_raw")).agg(F.min(publication(F.col("source"))).alias("publication_short"), F.min(whole(F.col("year"))).cast("int").alias("year"))
    out = names.select(
        whole(F.col("ID")).alias("id_raw"), whole(F.col("ID")).alias("fungorum_id"), F.col("scientificName").alias("name_raw"), F.lower("scientificName").alias("name_clean"),
        F.col("authorship").alias("author_raw"), F.col("rank").alias("rank_raw"),
    )
    related = F.struct(F.col("nameID").cast("string").alias("id"), F.col("status").cast("string").alias("type"))
    out = with_list(out.join(placed, "id_raw", "left").join(cited, "id_raw", "left"), synonyms, "taxonID", related, "synonyms")
    return processed(out, "rank_raw")


def mycobank(names: DataFrame) -> DataFrame:
    """Fungus list: the parent is the row of the last name of a classification whose own is its longest beginning."""
    empty = F.trim("Classification").isin("", "-", "?")
    listed = names.filter(F.col("Classification").isNotNull() & ~empty)
    steps = F.split("Classification", ", ")
    child = listed.select(F.col("ID").alias("link"), F.col("`MycoBank #`").alias("id_raw"), F.col("Classification").alias("path"), F.element_at(steps, -1).alias("name"))
    above = listed.select(F.col("`Taxon name`").alias("name"), F.col("`MycoBank #`").alias("parent_raw"), F.col("Classification").alias("parent_path"))
    met = child.join(above, "name").filter(F.col("path").startswith(F.col("parent_path")) & (F.col("parent_raw") != F.col("id_raw")))
    best = first_by(met, ["link"], [F.length("parent_path").desc(), F.col("parent_raw")])
    parents = first_by(best, ["id_raw"], [whole(F.col("link")).asc_nulls_last(), F.length("parent_path").desc(), F.col("parent_raw")]).select("id_raw", "parent_raw")
    out = names.select(
        F.col("`MycoBank #`").alias("id_raw"), F.lower("`Taxon name`").alias("name_clean"), F.col("`Authors (abbreviated)`").alias("author_raw"), F.col("Rank").alias("rank_raw"),
        year_of(F.col("`Year of effective publication`").cast("string")).alias("year"), F.col("`Name status`").alias("status_raw"), F.col("`MycoBank #`").alias("fungorum_id"),
    )
    return processed(out.join(parents, "id_raw", "left"))


# ---------------------------------------------------------------- catalogues


def gbif(taxa: DataFrame, distribution: DataFrame, vernacular: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Backbone: Taxon, Distribution and VernacularName files; plants and fungi only."""
    rows = taxa.filter(F.lower("kingdom").isin(*KINGDOMS))
    author, year = author_and_year(F.col("scientificNameAuthorship"))
    plain = F.lower("scientificName")
    out = rows.select(
        whole(F.col("taxonID")).alias("id_raw"), F.when(F.col("scientificNameAuthorship").isNull(), plain).otherwise(without_term(plain, F.col("scientificNameAuthorship"))).alias("name_clean"),
        whole(F.col("parentNameUsageID")).alias("parent_raw"), whole(F.col("acceptedNameUsageID")).alias("accepted_raw"), author.alias("author_raw"), F.col("taxonRank").alias("rank_raw"),
        *lower_of(rows, "kingdom", "phylum", "class", "order", "family", "genus"), F.col("taxonomicStatus").alias("status_raw"), year.alias("year"),
    )
    place = areas_of(F.col("locationID"), F.col("countryCode"))
    spread = distribution.withColumn("taxonID", whole(F.col("taxonID")))
    out = with_list(out, spread.filter("establishmentMeans = 'native'"), "taxonID", place, "native_to")
    out = with_list(out, spread, "taxonID", place, "regions")
    each = F.explode(F.split(F.regexp_replace("vernacularName", "[;:]", ","), ","))
    return processed(with_tagged_names(out, vernacular.select(whole(F.col("taxonId")).alias("id_raw"), F.col("language").alias("lang"), each.alias("name")), codes))


def col(usages: DataFrame, vernacular: DataFrame, distribution: DataFrame, references: DataFrame, gazetteer: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Catalogue: NameUsage, VernacularName, Distribution files and reference.json; plants and fungi only."""
    c = lambda name: F.col(f"`col:{name}`")
    link = c("link")
    ranks = ["kingdom", "phylum", "subphylum", "class", "subclass", "order", "family", "subfamily", "genus", "species"]
    out = usages.filter(F.lower(c("kingdom")).isin(*KINGDOMS)).select(
        c("ID").alias("id_raw"), F.lower(c("scientificName")).alias("name_clean"), c("parentID").alias("parent_raw"), c("authorship").alias("author_raw"), c("rank").alias("rank_raw"),
        *[F.lower(c(r)).alias(r) for r in ranks], year_of(c("combinationAuthorshipYear")).alias("own_year"), c("notho").isNotNull().alias("hybrid"),
        c("status").alias("status_raw"), c("extinct").cast("string").try_cast("boolean").alias("extinct"), c("nameReferenceID").alias("reference"),
        matched(link, r"www\.indexfungorum\.org/Names/NamesRecord\.asp\?RecordID=(\d+)").cast("long").alias("fungorum_id"), matched(link, r"urn:lsid:ipni\.org:names:(\d+-\d+)").alias("powo_id"),
        matched(link, r"worldfloraonline\.org/(wfo-\d+)").alias("wfo_id"), matched(link, r"https://www\.tropicos\.org/name/(\d+)").cast("long").alias("tropicos_id"),
    )
    issued = F.get(F.flatten(F.col("issued.`date-parts`")), F.lit(0)).cast("int")
    cited = references.groupBy(F.col("id").alias("reference")).agg(
        F.min(F.when(issued >= 0, issued)).alias("issued"), F.min(matched(F.col("title"), r"\((\d{4})\)\s*$").cast("int")).alias("title_year"),
        F.min(publication(F.col("`container-title`"))).alias("publication_short"), F.min(matched(F.lower("DOI"), r"bhl\.title\.(\d+)").cast("long")).alias("bhl_title"),
    )
    out = out.join(cited, "reference", "left").withColumn("year", F.coalesce("issued", "own_year", "title_year")).drop("reference", "issued", "own_year", "title_year")
    kind = F.lower(c("gazetteer"))
    texts = match_areas(distribution.filter(kind == "text").select(c("area").alias("area")), gazetteer)
    native = (c("degreeOfEstablishment") == "native") | (c("establishmentMeans") == "native")
    coded = F.when(kind.isin("tdwg", "iso"), F.replace(F.lower(c("areaID").cast("string")), F.lit("-oo"), F.lit(""))).when(kind == "text", F.col("code"))
    places = distribution.withColumn("area", c("area")).join(texts, "area", "left").select(c("taxonID").alias("taxon"), coded.alias("place"), native.alias("native"))
    out = with_list(out, places.filter("native"), "taxon", F.col("place"), "native_to")
    out = with_list(out, places, "taxon", F.col("place"), "regions")
    return processed(with_tagged_names(out, vernacular.select(c("taxonID").alias("id_raw"), c("language").alias("lang"), F.lower(c("name")).alias("name")), codes))


def ncbi(nodes: DataFrame, names: DataFrame, merged: DataFrame, roots: list[int]) -> DataFrame:
    """Taxonomy dump: nodes (taxid, parent, rank), names (taxid, name, name_class) and merged (old_taxid, new_taxid) below ``roots``.

    An authority counts if it begins with the scientific name and is longer;
    what follows the name is the author. ``merged_from`` lists former ids.
    """
    named = names.withColumn("name_class", F.rtrim(F.regexp_replace("name_class", r"[\t|]+$", "")))
    links = nodes.filter("taxid != parent").select(F.col("taxid").alias("id"), "parent")
    inside = descendants(links, nodes.filter(F.col("taxid").isin(*roots)).select(F.col("taxid").alias("id"))).select(F.col("node").alias("taxid"))
    science = named.filter("name_class = 'scientific name'").groupBy("taxid").agg(F.min("name").alias("name_raw"))
    authority = named.filter("name_class = 'authority'").select("taxid", F.col("name").alias("full"))
    longer = science.join(authority, "taxid").filter(F.col("full").startswith(F.col("name_raw")) & (F.length("full") > F.length("name_raw")))
    author = longer.groupBy("taxid").agg(F.nullif(F.trim(F.min(F.expr("substring(full, length(name_raw) + 1)"))), F.lit("")).alias("author_raw"))
    out = nodes.join(inside, "taxid", "left_semi").join(science, "taxid").join(author, "taxid", "left").select(
        F.col("taxid").alias("id_raw"), "name_raw", F.lower("name_raw").alias("name_clean"), F.col("rank").alias("rank_raw"), F.col("parent").alias("parent_raw"), "author_raw"
    )
    common = named.filter(F.col("name_class").isin("common name", "genbank common name"))
    out = with_list(out, common, "taxid", F.concat(F.lit("en:"), F.trim(F.lower("name"))), "vernacular")
    return processed(with_list(out, merged, "new_taxid", F.col("old_taxid"), "merged_from"))


# ---------------------------------------------------------------- observations, red list, library


def inaturalist(taxa: DataFrame, vernacular: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Observation network: taxa.csv and the per-language VernacularNames files read as one; plants and fungi only."""
    rows = taxa.filter(F.lower("kingdom").isin(*KINGDOMS))
    out = rows.select(
        whole(F.col("id")).alias("id_raw"), whole(F.replace("parentNameUsageID", F.lit("https://www.inaturalist.org/taxa/"), F.lit(""))).alias("parent_raw"),
        F.col("scientificName").alias("name_raw"), F.lit("accepted").alias("status_raw"), F.lower("scientificName").alias("name_clean"), F.col("taxonRank").alias("rank_raw"),
        *lower_of(rows, "kingdom", "phylum", "class", "order", "family", "genus"),
    )
    known = vernacular.filter(F.col("language").rlike("^[a-z]{2,3}([-_][A-Z]{2,3})?$") & (F.col("language") != "und"))
    text = F.regexp_replace(F.replace(F.lower("vernacularName"), F.lit(":"), F.lit(" ")), ",? and allies", "")
    each = known.select(whole(F.col("id")).alias("id_raw"), F.regexp_extract("language", "^[a-z]+", 0).alias("lang"), F.explode(F.split(text, ",")).alias("name"))
    return processed(with_tagged_names(out, each, codes))


# Red-list categories.
THREATS = {
    "least concern": "LC", "data deficient": "DD", "vulnerable": "VU", "endangered": "EN", "near threatened": "NT", "critically endangered": "CR",
    "extinct": "EX", "extinct in the wild": "EW", "conservation dependent": "NT",
}


def iucn(taxa: DataFrame, vernacular: DataFrame, distribution: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Red list: headerless taxon, vernacularname and distribution files; subpopulations (ids with _) go."""
    rows = taxa.filter(~F.col("id").cast("string").contains("_") & F.lower("kingdom").isin(*KINGDOMS))
    plain = F.lower("scientificName")
    out = rows.select(
        whole(F.col("id")).alias("id_raw"), F.col("scientificName").alias("name_raw"),
        F.when(F.col("scientificNameAuthorship").isNull(), plain).otherwise(without_term(plain, F.col("scientificNameAuthorship"))).alias("name_clean"),
        F.col("scientificNameAuthorship").alias("author_raw"), F.col("taxonRank").alias("rank_raw"), F.col("taxonomicStatus").alias("status_raw"),
        *lower_of(rows, "kingdom", "phylum", "class", "order", "family", "genus"), matched(F.col("references"), r"/species/\d+/(\d+)").cast("long").alias("iucn_assessment"),
    )
    name = F.col("vernacularName")
    spaced = F.regexp_replace(F.regexp_replace(F.translate(name, '":;', "   "), r"\s*\(\s*", " ("), r"\s+\)", ")")
    closed = F.when(spaced.rlike(r"\([^)]*$"), F.concat(F.trim(spaced), F.lit(")"))).otherwise(spaced)
    tidy = F.lower(squeeze(F.when(name.contains("(erronously:"), F.regexp_replace(name, r"\(erronously:[^)]*\)", "")).otherwise(closed)))
    spoken = vernacular.filter((F.length("language") == 3) & ~F.lower(name).startswith("species code"))
    out = with_tagged_names(out, spoken.select(whole(F.col("id")).alias("id_raw"), F.lower("language").alias("lang"), tidy.alias("name")), codes)
    threat = F.try_element_at(F.create_map(*[F.lit(x) for pair in THREATS.items() for x in pair]), F.lower("threatStatus"))
    status = distribution.groupBy(whole(F.col("id")).alias("id_raw")).agg(F.min(threat).alias("iucn_status"))
    return processed(out.join(status, "id_raw", "left"))


# Languages of eastern titles, and the four kinds of first mentions.
EASTERN = "CHI JPN ARA HEB OTA URD PER SAN GUJ HIN IND".split()
MENTIONS = {
    "first_mention": "true",
    "first_illustration": "type = 'Illustration'",
    "first_eastern": "eastern",
    "first_eastern_illustration": "type = 'Illustration' and eastern",
}


def bhl(pages: DataFrame, page_names: DataFrame, items: DataFrame, titles: DataFrame, creators: DataFrame) -> DataFrame:
    """Library: the earliest page of every name in each of four kinds of mention, with title and authors.

    A page's year comes from the page, else from its item; pages without one go.
    """
    item = items.groupBy(F.col("ItemID").alias("item_id")).agg(F.min("Year").alias("item_year"), F.min("TitleID").alias("title_id"))
    name = F.trim(F.regexp_replace(F.lower("NameConfirmed"), "[^a-z ×]", ""))
    seen = page_names.select("PageID", name.alias("name_clean")).filter("name_clean != ''").join(pages, "PageID")
    rows = seen.groupBy(F.col("ItemID").alias("item_id"), "name_clean", F.col("PageTypeName").alias("type")).agg(F.min("PageID").alias("id_raw"), F.min(year_of(F.col("Year").cast("string"))).alias("page_year"))
    book = first_by(titles, ["TitleID"], [F.col("ShortTitle").asc_nulls_last(), F.col("FullTitle").asc_nulls_last()]).select(
        F.col("TitleID").alias("title_id"), F.coalesce(F.col("LanguageCode").isin(*EASTERN), F.lit(False)).alias("eastern"), F.substring(F.coalesce("ShortTitle", "FullTitle"), 1, 100).alias("title")
    )
    dated = rows.join(item, "item_id", "left").withColumn("year", F.coalesce("page_year", whole(F.col("item_year")).cast("int"))).filter("year is not null")
    placed = processed(dated.join(book, "title_id", "left").withColumn("eastern", F.coalesce("eastern", F.lit(False))))
    first = first_mentions(placed, "name_clean", "year", "id_raw", MENTIONS).withColumnRenamed("kind", "mention_type")
    about = first_by(placed, ["name_clean", "id_raw"], [F.col("title_id").asc_nulls_last(), F.col("type").asc_nulls_last()]).select("name_clean", "id_raw", "item_id", "type", "title_id", "eastern", "title", "hybrid", "hybridpos")
    authors = joined_titles(creators.select(F.col("TitleID").alias("title_id"), "CreatorName"), "title_id", "CreatorName").withColumnRenamed("titles", "author_raw")
    return first.join(about, ["name_clean", "id_raw"]).join(authors, "title_id", "left")


# ---------------------------------------------------------------- entity dump

# Properties of an entity and the columns they become; ids of ranks and of traits.
ENTITY_IDS = {
    "P1391": "fungorum_id", "P962": "mycobank_id", "P960": "tropicos_id", "P3151": "inaturalist_id", "P7715": "wfo_id", "P685": "ncbi_id", "P846": "gbif_id", "P830": "eol_id",
    "P10585": "col_id", "P627": "iucn_id", "P815": "itis_id", "P1772": "usda_id", "P3606": "bold_id", "P3031": "eppo_id", "P6034": "plantfinder_id", "P1070": "plantlist_id",
    "P4301": "pfaf_id", "P8765": "rhs_id", "P1727": "fna_id", "P1747": "foc_id", "P3101": "apni_id", "P2752": "nzor_id", "P9157": "otol_id", "P13162": "illustration",
}
WHOLE_IDS = ("fungorum_id", "mycobank_id", "tropicos_id", "inaturalist_id", "gbif_id")
ENTITY_RANKS = {
    "Q7432": "species", "Q34740": "genus", "Q68947": "subspecies", "Q767728": "variety", "Q35409": "family", "Q164280": "subfamily", "Q3238261": "subgenus", "Q227936": "tribe",
    "Q3181348": "section", "Q36602": "order", "Q2136103": "superfamily", "Q3965313": "subtribe", "Q4886": "cultivar", "Q279749": "form", "Q5867959": "suborder", "Q3025161": "series",
    "Q5998839": "subsection", "Q37517": "class", "Q5867051": "subclass", "Q5868144": "superorder", "Q2889003": "subvariety", "Q38348": "phylum", "Q112082101": "subform",
    "Q3825509": "form", "Q1153785": "infraorder", "Q4150646": "cultivar", "Q6311258": "parvorder", "Q2007442": "infrafamily", "Q14817220": "supertribe", "Q334460": "infraclass",
    "Q3491997": "subdivision", "Q125838332": "oogenus", "Q3504061": "superclass", "Q10861375": "subsection", "Q21061732": "series", "Q10861426": "section", "Q36732": "kingdom",
    "Q2752679": "subkingdom", "Q113015256": "ichnospecies", "Q1993179": "supersection", "Q855769": "strain", "Q6054237": "magnorder", "Q2111790": "superphylum", "Q6541077": "subcohort",
    "Q13198444": "subseries", "Q2981883": "cohort", "Q19858692": "superkingdom",
}
TRAITS = {
    "edible": [("P279", "Q9323487"), ("P366", "Q2095"), ("P789", "Q654236")],
    "toxic": [("P789", "Q19888591"), ("P279", "Q21028485")],
    "fruit": [("P366", "Q3314483"), ("P279", "Q3314483")],
    "herb": [("P279", "Q207123")],
    "useful": [("P279", "Q11004")],
    "annual": [("P279", "Q192691")],
    "perennial": [("P279", "Q157957")],
    "medicinal": [("P366", "Q188840")],
    "vegetable": [("P366", "Q11004")],
    "psychoactive": [("P366", "Q3706669")],
}
NO_LANGUAGES = ("commons", "species", "wikidata", "mediawiki", "simple")
RANK_IN_NAME = r"category:|subgen\.|[ ]subgen[ ]|ssp\.|[ ]ssp[ ]|subg\.|[ ]subg[ ]|var\.|[ ]var[ ]|subsp\.|[ ]subsp[ ]|fo\.|f\.|sp\. nov\."
_SNAK = "struct<datavalue:struct<value:string>>"


def trait_flags(ids: dict[str, Column], traits: dict[str, list[tuple[str, str]]] = TRAITS) -> dict[str, Column]:
    """A flag for each trait: whether one of its (property, id) pairs is among the arrays ``ids`` of that property."""
    none = F.array().cast("array<string>")
    return {flag: reduce(lambda a, b: a | b, [F.array_contains(F.coalesce(ids[p], none), q) for p, q in pairs]) for flag, pairs in traits.items()}


def wikidata(entities: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Entity dump: rows (id, claims, labels, aliases, sitelinks), all but the id JSON text; entities without a taxon name go.

    ``vernacular`` maps a language to names from page titles, labels, aliases
    and taxon common names, without those that repeat the scientific one.
    """
    plain = [*ENTITY_IDS, "P105", "P171", "P961", "P5037", "P1421", "P8193", "P373", "P935", "P279", "P366", "P789", "P1843"]
    full = f"P225 array<struct<mainsnak:{_SNAK},qualifiers:struct<P574:array<{_SNAK}>,P405:array<{_SNAK}>>,references:array<struct<snaks:struct<P687:array<{_SNAK}>>>>>>"
    kind = ", ".join([full, *[f"{p} array<struct<mainsnak:{_SNAK}>>" for p in plain]])
    read = entities.filter(F.col("id").startswith("Q")).select(
        F.col("id").alias("id_raw"), F.from_json("claims", kind).alias("c"), F.from_json("labels", "map<string,struct<language:string,value:string>>").alias("labels"),
        F.from_json("aliases", "map<string,array<struct<language:string,value:string>>>").alias("aliases"), F.from_json("sitelinks", "map<string,struct<title:string>>").alias("links"),
    )
    value = lambda p: F.get(F.col(f"c.{p}"), F.lit(0))["mainsnak"]["datavalue"]["value"]
    item = lambda text: F.get_json_object(text, "$.id")
    bare = lambda text: F.replace(text, F.lit(LSID), F.lit(""))
    named = F.get(F.col("c.P225"), F.lit(0))
    qualified = lambda p: F.get(named["qualifiers"][p], F.lit(0))["datavalue"]["value"]
    moment = F.replace(F.get_json_object(qualified("P574"), "$.time"), F.lit("+"), F.lit(""))
    year = F.when(moment.rlike(r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T\d{2}:\d{2}:\d{2}Z$"), F.substring(moment, 1, 4).cast("int"))
    ids = {p: F.transform(F.col(f"c.{p}"), lambda s: F.get_json_object(s["mainsnak"]["datavalue"]["value"], "$.id")) for p in ("P279", "P366", "P789")}
    number = lambda p, name: whole(F.regexp_extract(value(p), r"\d+", 0)) if name == "inaturalist_id" else whole(value(p)) if name in WHOLE_IDS else value(p)
    pages = F.map_from_entries(F.transform(F.filter(F.map_entries("links"), lambda x: x["key"].endswith("wiki")), lambda x: F.struct(F.regexp_replace(x["key"], "wiki", "").alias("key"), x["value"]["title"].alias("value"))))
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in ENTITY_RANKS.items() for x in pair]), item(value("P105"))), F.lit("unranked"))
    wide = read.filter(value("P225").isNotNull()).select(
        "id_raw", value("P225").alias("name_raw"), F.lower(value("P225")).alias("name_clean"), item(value("P105")).alias("rank_id"), rank.alias("rank_raw"), item(value("P171")).alias("parent_raw"),
        year.alias("year"), item(qualified("P405")).alias("qauthor"), F.get(F.get(named["references"], F.lit(0))["snaks"]["P687"], F.lit(0))["datavalue"]["value"].alias("bhl_page"),
        bare(value("P961")).alias("ipni_id"), bare(value("P5037")).alias("powo_id"), F.replace(value("P1421"), F.lit("https://npgsweb.ars-grin.gov/gringlobal/"), F.lit("")).alias("grin_id"),
        *[number(p, name).alias(name) for p, name in ENTITY_IDS.items()], item(value("P8193")).alias("hardiness"), F.coalesce(value("P373"), value("P935")).alias("wikicommons"),
        pages.alias("wikipedia_pages"), "labels", "aliases", F.col("c.P1843").alias("spoken"), *[flag.alias(name) for name, flag in trait_flags(ids).items()],
    )
    found = wide.withColumns({
        "page_count": F.size("wikipedia_pages"), "wikicommons": F.coalesce("wikicommons", F.try_element_at("wikipedia_pages", F.lit("commons"))),
        "wikispecies": F.try_element_at("wikipedia_pages", F.lit("species")),
    })
    out = processed(found, "rank_raw")
    return out.drop("labels", "aliases", "spoken").join(_spoken_names(out, codes), "id_raw", "left")


def _spoken_names(taxa: DataFrame, codes: dict[str, str]) -> DataFrame:
    """(id_raw, vernacular) of the entities' names in any language."""
    entry = lambda lang, name: F.struct(lang.alias("lang"), name.alias("name"))
    cut = lambda lang, text: F.transform(F.split(text, "[,;]"), lambda name: entry(lang, name))
    none = F.array().cast("array<struct<lang:string,name:string>>")
    text = lambda s, part: F.get_json_object(s["mainsnak"]["datavalue"]["value"], part)
    titles = F.transform(F.filter(F.map_entries("wikipedia_pages"), lambda x: ~x["key"].isin(*NO_LANGUAGES)), lambda x: entry(x["key"], x["value"]))
    labels = F.transform(F.map_values("labels"), lambda x: entry(x["language"], x["value"]))
    aliases = F.flatten(F.transform(F.flatten(F.map_values("aliases")), lambda x: cut(x["language"], x["value"])))
    common = F.filter(F.flatten(F.transform("spoken", lambda s: cut(text(s, "$.language"), text(s, "$.text")))), lambda x: ~x["lang"].isin("und", "mis"))
    rows = taxa.select("id_raw", "name_clean", F.lower("name_raw").alias("low"), F.inline(F.concat(*[F.coalesce(x, none) for x in (titles, labels, aliases, common)])))
    name = F.lower("name")
    longer = (F.length("low") > 5) & (F.length("name") > 8) & name.startswith(F.col("low")) & (F.abs(F.length("name") - F.length("low")) > 4)
    bad = longer | (name == F.col("name_clean")) | (name == F.col("low")) | name.rlike(RANK_IN_NAME) | F.col("name").contains("×") | (F.trim("name") == "")
    kept = normalise_languages(rows.filter(F.col("name").isNotNull() & F.col("lang").isNotNull() & ~bad), "lang", codes)
    lists = kept.groupBy("id_raw", "lang").agg(F.sort_array(F.collect_set(F.trim("name"))).alias("names"))
    return lists.groupBy("id_raw").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("lang", "names")))).alias("vernacular"))
