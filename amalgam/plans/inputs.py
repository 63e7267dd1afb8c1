"""Queries over scans, sinks, scalars, streams and source extracts.

Each takes whole tables, writes them in the shape in question to a scratch
folder beside the session's checkpoints, and reads them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgam.functions import geo
from amalgam.operators import sampling
from amalgam.plans.registry import Tables, query
from amalgam.session import checkpoint_dir
from amalgam.sources import archives, enrich, extracts, readers, writers
from amalgam.streaming.upserts import RollingTable, windowed_counts


def _scratch(t: Tables, name: str) -> str:
    return f"{checkpoint_dir(t.spark)}/scratch-{uuid.uuid4()}/{name}"


def _lines(df: DataFrame, sep: str, *columns: str) -> DataFrame:
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))


# ---------------------------------------------------------------- scans and sinks


@query("""select p_partkey, p_name, p_size, case when p_size > 40 then null else p_brand end brand from part""")
def scan_tabs(t: Tables):
    """Tab-separated, quoting off, a null token, types given."""
    path = _scratch(t, "tabs")
    rows = t.part.select("p_partkey", F.concat(F.lit('"'), "p_name").alias("p_name"), "p_size", F.when(F.col("p_size") > 40, "NULL").otherwise(F.col("p_brand")).alias("brand"))
    rows.write.option("sep", "\t").option("header", True).option("quote", "\u0000").csv(path)
    found = readers.delimited(t.spark, path, quote=None, null="NULL", schema="p_partkey long, p_name string, p_size int, brand string")
    return found.withColumn("p_name", F.substring("p_name", 2, 100))


@query("select s_suppkey, s_name, s_acctbal from supplier")
def scan_bars(t: Tables):
    """Separated by bars, with a header."""
    path = _scratch(t, "bars")
    t.supplier.select("s_suppkey", "s_name", "s_acctbal").write.option("sep", "|").option("header", True).csv(path)
    return readers.delimited(t.spark, path, "|", schema="s_suppkey long, s_name string, s_acctbal double")


@query("select c_custkey::varchar id, c_name name, case when c_acctbal >= 0 then c_mktsegment end segment, case when c_acctbal >= 5000 then c_nationkey::varchar end nation from customer")
def scan_ragged(t: Tables):
    """No header, names given, rows of two to four fields: missing ones are null."""
    path, balance = _scratch(t, "ragged"), F.col("c_acctbal")
    full, three, two = (_lines(t.customer, "\t", *c) for c in (("c_custkey", "c_name", "c_mktsegment", "c_nationkey"), ("c_custkey", "c_name", "c_mktsegment"), ("c_custkey", "c_name")))
    shapes = [(full, balance >= 5000, 4), (three, (balance >= 0) & (balance < 5000), 3), (two, balance < 0, 2)]
    for k, (_, rule, width) in enumerate(shapes):
        _lines(t.customer.filter(rule), "\t", *["c_custkey", "c_name", "c_mktsegment", "c_nationkey"][:width]).write.text(f"{path}/{k}")
    return readers.headerless(t.spark, f"{path}/*", ["id", "name", "segment", "nation"], quote=None)


@query("select o_orderkey, o_totalprice from orders where o_orderpriority <> '1-URGENT'")
def scan_malformed(t: Tables):
    """Rows whose number is no number are left out."""
    path = _scratch(t, "malformed")
    price = F.when(F.col("o_orderpriority") == "1-URGENT", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    t.orders.select("o_orderkey", price.alias("o_totalprice")).write.option("header", True).csv(path)
    return readers.delimited(t.spark, path, ",", schema="o_orderkey long, o_totalprice double", malformed="drop")


@query("select n_nationkey id, n_name \"name\", case when n_regionkey > 2 then n_regionkey end region from nation")
def scan_bulk_copy(t: Tables):
    """Fields that end in tab, bar, tab and lines that end in tab, bar."""
    path = _scratch(t, "bulk")
    region = F.when(F.col("n_regionkey") > 2, F.col("n_regionkey"))
    _lines(t.nation.withColumn("r", region), "\t|\t", "n_nationkey", "n_name", "r").select(F.concat("value", F.lit("\t|")).alias("value")).write.text(path)
    return readers.bulk_copy(t.spark, path, "id int, name string, region int")


@query("select 'Q' || event_id id, event_type kind, value from events where event_type <> 'error'")
def scan_json_lines(t: Tables):
    """One object a line in array brackets with commas; other ids and broken lines are left out."""
    path = _scratch(t, "lines")
    error = F.col("event_type") == "error"
    key = F.concat(F.when(error, "P").otherwise("Q"), F.col("event_id").cast("string"))
    text = F.concat(F.to_json(F.struct(key.alias("id"), F.col("event_type").alias("kind"), "value")), F.lit(","))
    broken = t.region.select(F.concat(F.lit('{"id": "Q'), F.col("r_name")).alias("value"))
    t.events.select(text.alias("value")).unionAll(broken).unionAll(t.region.select(F.lit("[").alias("value"))).write.text(path)
    return readers.ndjson(t.spark, path, "id string, kind string, value double", starts="Q")


@query("select s_suppkey id, [s_name, s_nationkey::varchar][1] first, len([s_name, s_nationkey::varchar])::bigint n from supplier")
def scan_json_array(t: Tables):
    path = _scratch(t, "array")
    one = t.supplier.select(F.struct(F.col("s_suppkey").alias("id"), F.array("s_name", F.col("s_nationkey").cast("string")).alias("parts")).alias("o")).groupBy().agg(F.to_json(F.collect_list("o")).alias("value"))
    one.write.text(path)
    found = readers.json_array(t.spark, path, "id long, parts array<string>")
    return found.select("id", F.get("parts", F.lit(0)).alias("first"), F.size("parts").cast("long").alias("n"))


@query("select l_returnflag flag, count(*) n, round(sum(l_quantity), 2) quantity from lineitem group by 1")
def scan_parquet_parts(t: Tables):
    """Partitioned parquet with a fixed codec, read by a glob and as a view."""
    path = _scratch(t, "parts")
    writers.write_parquet(t.lineitem.select("l_quantity", F.col("l_returnflag").alias("flag")), path, partitions=["flag"])
    name = f"parts_{uuid.uuid4().hex}"
    readers.parquet(t.spark, path, view=name)
    return t.spark.sql(f"select flag, count(*) n, round(sum(l_quantity), 2) quantity from {name} group by 1")


@query("select p_partkey, p_name, p_type from part")
def scan_zip_members(t: Tables):
    """Members of an archive, unpacked by streams and read as one table, text and parquet."""
    path = _scratch(t, "zip")
    half = F.col("p_size") > 25
    t.part.filter(half).select("p_partkey", "p_name", "p_type").write.option("sep", "\t").csv(f"{path}/text")
    t.part.filter(~half).select("p_partkey", "p_name", "p_type").write.parquet(f"{path}/table")
    members = {f"in/{k}.tsv": f for k, f in enumerate(archives.parts_of(t.spark, f"{path}/text"))}
    members |= {f"in/{k}.parquet": f for k, f in enumerate(archives.parts_of(t.spark, f"{path}/table"))}
    archives.pack(t.spark, members, f"{path}/all.zip")
    text = readers.delimited(t.spark, archives.unpack(t.spark, f"{path}/all.zip", f"{path}/out", ".tsv"), schema="p_partkey long, p_name string, p_type string", header=False)
    return text.unionByName(readers.parquet(t.spark, archives.unpack(t.spark, f"{path}/all.zip", f"{path}/out", ".parquet")))


@query("select doc_id, source from documents where contains(text, 'license') or contains(text, 'License')")
def scan_filtered_gzip(t: Tables):
    """Lines of compressed files that match a pattern."""
    path = _scratch(t, "gz")
    t.documents.select(F.to_json(F.struct("doc_id", "source", "text")).alias("value")).write.option("compression", "gzip").text(path)
    found = readers.filtered_lines(t.spark, path, "[lL]icense")
    parsed = found.select(F.from_json("value", "doc_id long, source string, text string").alias("o")).select("o.*")
    return parsed.filter(F.col("text").rlike("[lL]icense")).select("doc_id", "source")


@query("select doc_id::varchar id, lang from documents where lang in ('de', 'fr')")
def scan_language_files(t: Tables):
    """A file for each language, read at once and kept by language."""
    path = _scratch(t, "langs")
    t.documents.select("doc_id", F.col("lang").alias("language"), F.col("lang").alias("of")).write.partitionBy("of").option("header", True).csv(path)
    return readers.language_files(t.spark, f"{path}/of=*/*.csv", "id string, language string", ["de", "fr"]).select("id", F.col("language").alias("lang"))


@query("select c_custkey, '[\"' || c_mktsegment || '\",\"' || c_nationkey || '\"]' tags from customer")
def sink_text_sidecar(t: Tables):
    """Arrays are JSON in the tab-separated sidecar."""
    path = _scratch(t, "sidecar")
    writers.write_tsv(t.customer.select("c_custkey", F.array("c_mktsegment", F.col("c_nationkey").cast("string")).alias("tags")), path)
    return t.spark.read.option("sep", "\t").option("header", True).option("escape", "\\").schema("c_custkey long, tags string").csv(path)


@query("select o_orderkey, o_totalprice * 2 price from orders")
def sink_replace(t: Tables):
    """A table written over while it is read."""
    path = _scratch(t, "swap")
    writers.write_parquet(t.orders.select("o_orderkey", F.col("o_totalprice").alias("price")), path)
    writers.replace_parquet(t.spark.read.parquet(path).withColumn("price", F.col("price") * 2), path)
    return t.spark.read.parquet(path)


@query("select c_custkey, case when c_acctbal > 0 then '0101000000' end prefix, case when c_acctbal > 0 then 21::bigint end bytes from customer")
def sink_points(t: Tables):
    """Points as well-known binary, null without coordinates."""
    path = _scratch(t, "points")
    x = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 100)
    writers.write_parquet(t.customer.select("c_custkey", geo.point_wkb(x, F.col("c_nationkey").cast("double")).alias("location")), path)
    return t.spark.read.parquet(path).select("c_custkey", F.hex(F.substring("location", 1, 5)).alias("prefix"), F.octet_length("location").cast("long").alias("bytes"))


# ---------------------------------------------------------------- scalars, samples, enrichment, streams


@query(
    """select p_partkey, lower(p_brand) low, lower(p_brand) || chr(9) || p_size mixed, lower(typeof(p_partkey)) kind, upper(p_name) is not null known,
    coalesce(case when p_size = 7 then null else p_size end, 1876)::int mended, try_cast(p_brand as integer) is null no_number from part"""
)
def scalar_extras(t: Tables):
    """Aliases used in the same SELECT, chr, typeof, first non-null, mended and guarded numbers."""
    t.part.createOrReplaceTempView(view := f"part_{uuid.uuid4().hex}")
    out = t.spark.sql(
        f"select p_partkey, lower(p_brand) low, low || char(9) || p_size mixed, typeof(p_partkey) kind, upper(p_name) up, up is not null known, coalesce(nullif(p_size, 7), 1876) mended, try_cast(p_brand as int) is null no_number from {view}"
    )
    return out.drop("up")


@query("select p_type, any_value(b) brand, count(*) n from (select p_type, p_partkey, min(p_brand) over (partition by p_type) b from part) group by 1")
def any_values(t: Tables):
    """A value that is not null for each group, the least so that runs agree."""
    return t.part.groupBy("p_type").agg(F.min("p_brand").alias("brand"), F.count(F.lit(1)).alias("n"))


@query("select count(*) filter (where len(string_split(p_name, ' ')) >= 4) long_names, 0::bigint non_latin, count(*) \"rows\" from part")
def name_report(t: Tables):
    from amalgam.functions.text import validation_report

    return validation_report(t.part.withColumnRenamed("p_name", "name_clean"))


@query("select c_custkey from (select c_custkey, c_acctbal from customer order by case when c_acctbal < 0 then 0 else 1 end, c_acctbal) limit (select count(*) from customer where c_acctbal < 0)")
def stale_first(t: Tables):
    """Never checked rows first: as many as there are, so that no tie is cut."""
    rows = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("checked"))
    never = rows.filter("checked is null").count()
    return sampling.stale_first(rows, "checked", never, "c_custkey").select("c_custkey")


@query("select p_name, case when p_name like 'red %' then 'about ' || replace(p_name, 'red ', 'blue ') when p_name like 'hot %' then null else 'about ' || p_name end abstract from (select distinct p_name from part)")
def enriched_names(t: Tables):
    """Answers of an interface of twenty keys a call, redirects followed, some keys without one."""

    def fetch(keys):
        moved = {k: k.replace("red ", "blue ") for k in keys if k.startswith("red ")}
        return moved, {k: f"about {k}" for k in [*keys, *moved.values()] if not k.startswith("hot ")}

    return enrich.enrich(t.part, "p_name", fetch, "abstract")


@query("select event_type, date_trunc('day', ts) \"start\", count(*) n, round(sum(value), 4) total from events group by 1, 2")
def windowed_events(t: Tables):
    out = windowed_counts(t.events, "ts", "event_type", "value")
    return out.select("event_type", "start", "n", F.round("total", 4).alias("total"))


@query("select user_id, event_id, value from (select *, row_number() over (partition by user_id order by event_id desc) r from events) where r = 1")
def streamed_upserts(t: Tables):
    """The latest event of every user: half of the events in a batch, all of them once more by a stream of files."""
    path = _scratch(t, "rolling")
    rows = t.events.select("user_id", "event_id", "value")
    table = RollingTable(t.spark, f"{path}/table")
    table.apply(rows.filter("value < 20"), "user_id", "event_id")
    rows.repartition(3).write.parquet(f"{path}/in")
    table.follow(t.spark.readStream.schema(rows.schema).parquet(f"{path}/in"), "user_id", "event_id", f"{path}/log").awaitTermination()
    return table.read()


# ---------------------------------------------------------------- extracts

_AREAS = "d as (select l_partkey k, lower(coalesce(case when l_quantity > 10 then l_returnflag || l_linestatus end, l_linenumber::varchar)) area, l_discount < 0.05 native from lineitem)"


@query(
    f"""with {_AREAS} select p_partkey::varchar id_raw, p_name name_clean, case when p_size % 2 = 0 then 'species' else 'variety' end rank_clean, case when p_size < 25 then 'accepted' else 'synonym' end status_clean,
    1700 + p_size "year", p_type = 'PROMO' annual, (select string_agg(distinct area, ',' order by area) from d where k = p_partkey and native) native_to, (select string_agg(distinct area, ',' order by area) from d where k = p_partkey) regions from part"""
)
def extract_wcvp(t: Tables):
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")
    size = F.col("p_size")
    names = t.part.select(
        text("p_partkey").alias("plant_name_id"), F.col("p_name").alias("taxon_name"), F.when(size % 2 == 0, "Species").otherwise("Variety").alias("taxon_rank"), F.col("p_brand").alias("family"), none.alias("genus"),
        none.alias("species"), none.alias("genus_hybrid"), none.alias("species_hybrid"), none.alias("hybrid_formula"), none.alias("parent_plant_name_id"), none.alias("primary_author"),
        F.when(size < 25, "Accepted").otherwise("Homotypic_Synonym").alias("taxon_status"), none.alias("place_of_publication"), F.concat(F.lit("("), (size + 1700).cast("string"), F.lit(")")).alias("first_published"),
        none.alias("reviewed"), none.alias("ipni_id"), none.alias("powo_id"), F.when(F.col("p_type") == "PROMO", "annual").otherwise("perennial").alias("lifeform_description"),
    )
    spread = t.lineitem.select(
        text("l_partkey").alias("plant_name_id"), F.when(F.col("l_quantity") > 10, F.concat("l_returnflag", "l_linestatus")).alias("area_code_l3"), F.col("l_linenumber").alias("region_code_l2"), none.alias("continent_code_l1"),
        F.when(F.col("l_discount") < 0.05, 0).otherwise(1).alias("introduced"),
    )
    out = extracts.wcvp(names, spread)
    return out.select("id_raw", "name_clean", "rank_clean", "status_clean", "year", "annual", F.array_join("native_to", ",").alias("native_to"), F.array_join("regions", ",").alias("regions"))


@query(
    """select ('1' || lpad(c_custkey::varchar, 8, '0'))::bigint id_raw, (1000 + c_nationkey)::bigint parent_raw, lower(trim(replace(c_name, 'Customer#', 'species'))) n, lower(c_mktsegment) author, 'en:' || lower(c_mktsegment) vernacular
    from customer join nation on c_nationkey = n_nationkey where n_regionkey in (1, 2)"""
)
def extract_ncbi(t: Tables):
    """Customers below two regions as the leaves of a taxonomy dump."""
    leaf, nation = F.concat(F.lit("1"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).cast("long"), lambda c: (F.col(c) + 1000).cast("long")
    name = F.replace("c_name", F.lit("Customer#"), F.lit("species"))
    nodes = t.customer.select(leaf.alias("taxid"), nation("c_nationkey").alias("parent"), F.lit("species").alias("rank"))
    nodes = nodes.unionAll(t.nation.select(nation("n_nationkey"), (F.col("n_regionkey") + 100).cast("long"), F.lit("genus"))).unionAll(t.region.select((F.col("r_regionkey") + 100).cast("long"), (F.col("r_regionkey") + 100).cast("long"), F.lit("no rank")))
    kind = lambda text, k: t.customer.select(leaf.alias("taxid"), text.alias("name"), F.lit(f"{k}\t|").alias("name_class"))
    names = kind(name, "scientific name").unionAll(kind(F.concat(name, F.lit(" "), F.lower("c_mktsegment")), "authority")).unionAll(kind(F.col("c_mktsegment"), "common name"))
    merged = t.region.select(F.lit(0).cast("long").alias("old_taxid"), F.lit(-1).cast("long").alias("new_taxid"))
    out = extracts.ncbi(nodes, names, merged, [101, 102])
    return out.select("id_raw", "parent_raw", F.lower("name_raw").alias("n"), F.col("author_raw").alias("author"), F.array_join("vernacular", ",").alias("vernacular"))


@query(
    """with b as (select l_partkey k, l_orderkey page, case when l_quantity > 25 then 1700 + l_linenumber else 1800 + l_suppkey % 50 end y, l_returnflag = 'A' ill, l_linestatus = 'O' east from lineitem),
    m as (select p_name nm, b.* from b join part on p_partkey = k), i as (select min(page) p, nm, y, ill, east from m group by nm, y, ill, east),
    f as (select nm, 'first_mention' kind, min(y) y from m group by 1 union all select nm, 'first_illustration', min(y) from m where ill group by 1 union all select nm, 'first_eastern', min(y) from m where east group by 1
    union all select nm, 'first_eastern_illustration', min(y) from m where ill and east group by 1)
    select nm name_clean, kind mention_type, y "year" from f"""
)
def extract_bhl(t: Tables):
    """Line items as pages: their order is the page, line status the language, return flag the type."""
    line = t.lineitem.withColumn("page", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_extendedprice"))
    year = F.when(F.col("l_quantity") > 25, F.col("l_linenumber") + 1700)
    old = (F.col("l_suppkey") % 50).cast("int")
    item = F.concat_ws("-", old.cast("string"), "l_linestatus")
    pages = line.select(F.col("page").alias("PageID"), item.alias("ItemID"), year.cast("string").alias("Year"), F.when(F.col("l_returnflag") == "A", "Illustration").otherwise("Text").alias("PageTypeName"))
    names = line.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("page").alias("PageID"), F.col("p_name").alias("NameConfirmed"))
    items = line.select(item.alias("ItemID"), (old + 1800).alias("Year"), F.col("l_linestatus").alias("TitleID")).distinct()
    titles = line.select(F.col("l_linestatus").alias("TitleID")).distinct().select("TitleID", F.when(F.col("TitleID") == "O", "CHI").otherwise("LAT").alias("LanguageCode"), F.lit("t").alias("ShortTitle"), F.lit("t").alias("FullTitle"))
    out = extracts.bhl(pages, names, items, titles, titles.select("TitleID", F.lit("someone").alias("CreatorName")))
    return out.select("name_clean", "mention_type", "year")


@query(
    """with s as (select 'S' || s_suppkey nm, s_suppkey id, 'r' || n_regionkey r, 'n' || n_nationkey n from supplier join nation on s_nationkey = n_nationkey)
    select id::bigint id_raw, 100000 + substr(n, 2)::bigint parent_raw, 1800 + id % 100 "year" from s union all select 100000 + n_nationkey, 200000 + n_regionkey, null from nation union all select 200000 + r_regionkey, null, null from region"""
)
def extract_mycobank(t: Tables):
    """Suppliers, nations and regions as a list in which the classification leads to the parent."""
    row = lambda df, id_, name, path, year: df.select(
        id_.cast("long").alias("ID"), id_.cast("long").alias("MycoBank #"), name.alias("Taxon name"), F.lit(None).cast("string").alias("Authors (abbreviated)"), F.lit("gen.").alias("Rank"),
        year.cast("string").alias("Year of effective publication"), F.lit("Legitimate").alias("Name status"), path.alias("Classification"),
    )
    r, n = F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    none = F.lit(None)
    regions = row(t.region, F.col("r_regionkey") + 200000, F.concat(F.lit("r"), F.col("r_regionkey").cast("string")), F.lit("Fungi"), none)
    nations = row(t.nation, F.col("n_nationkey") + 100000, n, F.concat_ws(", ", F.lit("Fungi"), r), none)
    leaves = row(t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")), F.col("s_suppkey"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), F.concat_ws(", ", F.lit("Fungi"), r, n), F.col("s_suppkey") % 100 + 1800)
    return extracts.mycobank(regions.unionAll(nations).unionAll(leaves)).select("id_raw", "parent_raw", "year")
