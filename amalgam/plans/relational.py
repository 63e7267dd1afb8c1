"""Queries over joins, aggregates, windows, set operations and functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from amalgam.functions import arrays, keys, text
from amalgam.operators import dedupe, joins, sampling
from amalgam.plans.registry import Tables, query


@query(
    """select l_returnflag, l_linestatus, round(sum(l_quantity), 2) sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) revenue,
    round(avg(l_discount), 6) avg_disc, min(l_shipdate)::date first_ship, max(l_shipdate)::date last_ship, count(*) n from lineitem group by 1, 2"""
)
def pricing_summary(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.min("l_shipdate").cast("date").alias("first_ship"),
        F.max("l_shipdate").cast("date").alias("last_ship"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    """select o_custkey, count(*) filter (where o_orderstatus = 'F') finished, count(*) filter (where o_totalprice > 100000) large, count(*) n
    from orders group by 1"""
)
def filter_agg(t: Tables):
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count_if(F.col("o_totalprice") > 100000).alias("large"), F.count(F.lit(1)).alias("n")
    )


@query("select p_name, count(*) n from part group by 1 having count(*) > 1")
def having_dupes(t: Tables):
    return dedupe.duplicates(t.part, ["p_name"])


@query(
    """select p_type, p_brand from (select p_type, p_brand, row_number() over (partition by p_type order by n desc, p_brand) r
    from (select p_type, p_brand, count(*) n from part group by 1, 2)) where r = 1"""
)
def mode_by_group(t: Tables):
    return dedupe.mode_by(t.part, ["p_type"], "p_brand")


@query(
    """select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) r from orders) where r = 1"""
)
def distinct_on_latest(t: Tables):
    return keys.first_by(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    """select o_custkey, string_agg(distinct o_orderpriority, '|' order by o_orderpriority) priorities, count(distinct o_orderpriority) n,
    bool_or(o_orderstatus = 'P') any_pending from orders group by 1"""
)
def distinct_lists(t: Tables):
    return t.orders.groupBy("o_custkey").agg(
        F.array_join(F.sort_array(F.collect_set("o_orderpriority")), "|").alias("priorities"),
        F.count_distinct("o_orderpriority").alias("n"),
        F.coalesce(F.bool_or(F.col("o_orderstatus") == "P"), F.lit(False)).alias("any_pending"),
    )


@query(
    """select conv_id, left(string_agg(role || ':' || length(text)::varchar, ', ' order by turn, role, length(text)), 100) outline from conversations group by 1"""
)
def listagg_titles(t: Tables):
    item = F.struct("turn", "role", F.length("text").alias("n"))
    parts = F.transform(F.sort_array(F.collect_list(item)), lambda x: F.concat(x["role"], F.lit(":"), x["n"].cast("string")))
    return t.conversations.groupBy("conv_id").agg(F.substring(F.array_join(parts, ", "), 1, 100).alias("outline"))


@query(
    """select c_nationkey, string_agg(distinct w, ' ' order by w) words from (select c_nationkey, unnest(string_split(lower(c_mktsegment), ' ')) w from customer) group by 1"""
)
def flatten_distinct(t: Tables):
    lists = t.customer.groupBy("c_nationkey").agg(F.collect_list(F.split(F.lower("c_mktsegment"), " ")).alias("l"))
    return lists.select("c_nationkey", F.array_join(arrays.distinct(arrays.flattened(F.col("l"))), " ").alias("words"))


@query("select l_returnflag, median(l_quantity) med, quantile_cont(l_extendedprice, 0.25) q25 from lineitem group by 1")
def exact_percentiles(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.median("l_quantity").alias("med"), F.percentile("l_extendedprice", F.lit(0.25)).alias("q25"))


@query("select event_type, cast(floor(value / 10) * 10 as bigint) bin, count(*) n from events where value is not null group by 1, 2")
def histogram_bins(t: Tables):
    return t.events.filter("value is not null").groupBy("event_type", (F.floor(F.col("value") / 10) * 10).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """select l_suppkey, round(sum(l_discount * l_quantity) / sum(l_quantity), 8) mean_disc, (min(l_tax) + max(l_tax)) / 2 mid_tax, count(distinct l_partkey) parts
    from lineitem group by 1"""
)
def weighted_means(t: Tables):
    q = F.col("l_quantity")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.round(F.sum(F.col("l_discount") * q) / F.sum(q), 8).alias("mean_disc"), ((F.min("l_tax") + F.max("l_tax")) / 2).alias("mid_tax"), F.count_distinct("l_partkey").alias("parts")
    )


@query("select distinct o_orderstatus, o_orderpriority from orders")
def distinct_pairs(t: Tables):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query(
    """select user_id, string_agg(event_type || '=' || n::varchar, ',' order by event_type) counts from (select user_id, event_type, count(*) n from events group by 1, 2) group by 1"""
)
def map_build(t: Tables):
    per = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    m = per.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return m.select("user_id", F.array_join(F.transform(F.sort_array(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("counts"))


@query(
    """select o_orderkey, round(sum(o_totalprice) over (partition by o_custkey), 2) total, round(sum(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey), 2) running,
    row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) nth, min(o_totalprice) over (partition by o_custkey) least,
    count(*) over (partition by o_custkey order by o_orderdate, o_orderkey rows between 2 preceding and current row) near from orders"""
)
def window_functions(t: Tables):
    part = Window.partitionBy("o_custkey")
    order = part.orderBy("o_orderdate", "o_orderkey")
    return t.orders.select(
        "o_orderkey",
        F.round(F.sum("o_totalprice").over(part), 2).alias("total"),
        F.round(F.sum("o_totalprice").over(order), 2).alias("running"),
        F.row_number().over(order).cast("long").alias("nth"),
        F.min("o_totalprice").over(part).alias("least"),
        F.count(F.lit(1)).over(order.rowsBetween(-2, 0)).alias("near"),
    )


@query("select o_orderkey from (select o_orderkey, count(*) over (partition by o_custkey, o_orderpriority) n from orders) where n = 1")
def window_unique_guard(t: Tables):
    n = F.count(F.lit(1)).over(Window.partitionBy("o_custkey", "o_orderpriority"))
    return t.orders.withColumn("n", n).filter("n = 1").select("o_orderkey")


@query(
    """select o_orderkey, o_totalprice from orders order by case when o_orderpriority = '1-URGENT' then 0 else 1 end, o_totalprice desc nulls last, o_orderkey limit 25"""
)
def order_limit(t: Tables):
    first = F.when(F.col("o_orderpriority") == "1-URGENT", 0).otherwise(1)
    return t.orders.orderBy(first, F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("select p_brand, string_agg(p_partkey::varchar, ',' order by r) top from (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) r from part) where r <= 10 group by 1")
def top_k_per_group(t: Tables):
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey"))
    top = t.part.withColumn("r", place).filter("r <= 10")
    return top.groupBy("p_brand").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "p_partkey"))), lambda x: x["p_partkey"].cast("string")), ",").alias("top"))


@query(
    """select 'all' op, count(*) n from (select c_nationkey k from customer union all select s_nationkey from supplier)
    union all select 'distinct', count(*) from (select c_nationkey k from customer union select s_nationkey from supplier)
    union all select 'except', count(*) from (select n_nationkey k from nation except select s_nationkey from supplier)
    union all select 'intersect', count(*) from (select c_nationkey k from customer intersect select s_nationkey from supplier)"""
)
def setop_counts(t: Tables):
    c, s, n = (x.select(F.col(k).alias("k")) for x, k in ((t.customer, "c_nationkey"), (t.supplier, "s_nationkey"), (t.nation, "n_nationkey")))
    found = {"all": c.unionAll(s), "distinct": c.union(s).distinct(), "except": n.subtract(s), "intersect": c.intersect(s)}
    out = None
    for op, frame in found.items():
        one = frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")
        out = one if out is None else out.unionAll(one)
    return out


@query("select c_custkey, n_name, r_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def join_inner(t: Tables):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name")


@query("select c_custkey, n, coalesce(total, 0) total from customer left join (select o_custkey, count(*) n, round(sum(o_totalprice), 2) total from orders group by 1) on c_custkey = o_custkey")
def join_left_enrich(t: Tables):
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return t.customer.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "n", F.coalesce("total", F.lit(0.0)).alias("total"))


@query("select p_partkey from part where p_partkey not in (select l_partkey from lineitem where l_quantity > 40 and l_partkey is not null)")
def anti_not_in(t: Tables):
    return joins.not_in(t.part, t.lineitem.filter("l_quantity > 40"), "p_partkey", "l_partkey").select("p_partkey")


@query("select s_suppkey from supplier s where exists (select 1 from customer c where c.c_nationkey = s.s_nationkey and c.c_acctbal > 9900)")
def semi_exists(t: Tables):
    return t.supplier.join(t.customer.filter("c_acctbal > 9900"), F.col("c_nationkey") == F.col("s_nationkey"), "left_semi").select("s_suppkey")


@query(
    """select c_custkey from customer c where not exists (select 1 from supplier s where s.s_suppkey = c.c_custkey)
    and not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o.o_orderstatus = 'P')"""
)
def anti_not_exists_several(t: Tables):
    out = joins.not_in(t.customer, t.supplier, "c_custkey", "s_suppkey")
    return joins.not_in(out, t.orders.filter("o_orderstatus = 'P'"), "c_custkey", "o_custkey").select("c_custkey")


@query(
    """select coalesce(c.k, s.k) k, c.n customers, s.n suppliers from (select c_nationkey k, count(*) n from customer where c_acctbal > 5000 group by 1) c
    full join (select s_nationkey k, count(*) n from supplier where s_acctbal > 5000 group by 1) s on c.k = s.k"""
)
def full_outer(t: Tables):
    c = t.customer.filter("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers"))
    return c.join(t.supplier.filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("suppliers")), "k", "full")


@query("select a.n_name lower_name, b.n_name upper_name from nation a join nation b on a.n_regionkey = b.n_nationkey")
def self_join_parent(t: Tables):
    a, b = t.nation.alias("a"), t.nation.alias("b")
    return a.join(b, F.col("a.n_regionkey") == F.col("b.n_nationkey")).select(F.col("a.n_name").alias("lower_name"), F.col("b.n_name").alias("upper_name"))


@query(
    """with e as (select event_id, user_id, case when event_id % 7 = 0 then null else event_type end k from events)
    select k, a.n n_even, b.n n_odd from (select k, count(*) n from e where event_id % 2 = 0 group by 1) a
    join (select k kk, count(*) n from e where event_id % 2 = 1 group by 1) b on k is not distinct from kk"""
)
def join_null_safe(t: Tables):
    e = t.events.withColumn("k", F.when(F.col("event_id") % 7 != 0, F.col("event_type")))
    a = e.filter("event_id % 2 = 0").groupBy("k").agg(F.count(F.lit(1)).alias("n_even"))
    b = e.filter("event_id % 2 = 1").groupBy(F.col("k").alias("kk")).agg(F.count(F.lit(1)).alias("n_odd"))
    return a.join(b, F.col("k").eqNullSafe(F.col("kk"))).select("k", "n_even", "n_odd")


@query(
    """select p_partkey, prefix from (select p_partkey, b.p prefix, row_number() over (partition by p_partkey order by length(b.p) desc, b.p) r from part a
    join (select distinct left(p_type, k) p, string_split(p_type, ' ')[1] w from part, (values (6), (9), (14)) v(k)) b
    on string_split(a.p_type, ' ')[1] = b.w and starts_with(a.p_type, b.p)) where r = 1"""
)
def join_longest_prefix(t: Tables):
    word = F.get(F.split("p_type", " "), 0)
    prefixes = t.part.select(word.alias("w"), F.explode(F.array(*[F.substring("p_type", 1, k) for k in (6, 9, 14)])).alias("prefix")).distinct()
    met = t.part.select("p_partkey", "p_type", word.alias("w")).join(prefixes, "w").filter(F.col("p_type").startswith(F.col("prefix")))
    return keys.first_by(met, ["p_partkey"], [F.length("prefix").desc(), F.col("prefix")]).select("p_partkey", "prefix")


@query(
    """select c_custkey, o_orderkey, o_orderdate::date d from customer join (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) r from orders) o
    on c_custkey = o_custkey and r = 1"""
)
def correlated_top_one(t: Tables):
    best = joins.best_match(t.customer, t.orders.withColumn("c_custkey", F.col("o_custkey")), "c_custkey", "c_custkey", [F.desc("o_totalprice"), F.col("o_orderkey")], "o_orderkey")
    return best.join(t.orders, "o_orderkey").select("c_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("d"))


@query("select n_nationkey, (select string_agg(s_suppkey::varchar || ':' || s_name, ';' order by s_suppkey) from supplier where s_nationkey = n_nationkey) suppliers from nation")
def correlated_list(t: Tables):
    item = F.sort_array(F.collect_list(F.struct("s_suppkey", "s_name")))
    per = t.supplier.groupBy("s_nationkey").agg(F.array_join(F.transform(item, lambda x: F.concat_ws(":", x["s_suppkey"].cast("string"), x["s_name"])), ";").alias("suppliers"))
    return t.nation.join(per, F.col("n_nationkey") == F.col("s_nationkey"), "left").select("n_nationkey", "suppliers")


@query("select w, count(*) n from (select unnest(string_split(p_name, ' ')) w from part) group by 1")
def lateral_unnest(t: Tables):
    return t.part.select(F.explode(F.split("p_name", " ")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


@query(
    """with m as (select c_nationkey cur, list(c_custkey) olds from customer where c_custkey % 3 = 0 group by 1), u as (select unnest(olds) k, cur from m)
    select o_orderkey, coalesce(u.cur, o_custkey) cust from orders left join u on o_custkey = u.k"""
)
def containment_join(t: Tables):
    merged = t.customer.filter("c_custkey % 3 = 0").groupBy(F.col("c_nationkey").cast("long").alias("cur")).agg(F.collect_list("c_custkey").alias("olds"))
    return joins.redirect(t.orders.select("o_orderkey", F.col("o_custkey").alias("cust")), "cust", merged, "cur", "olds")


@query(
    """with e as (select o_orderkey, case when o_orderkey % 3 = 0 then null else o_totalprice end price, o_custkey from orders)
    select o_orderkey, coalesce(price, c_acctbal) price from e left join customer on o_custkey = c_custkey"""
)
def update_from(t: Tables):
    left = t.orders.select("o_orderkey", F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"))
    return joins.fill_from(left, t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("price")), "k", ["price"]).select("o_orderkey", "price")


@query(
    """select p_partkey, upper(p_brand) u, replace(p_name, 'a', '_') r, split_part(p_type, ' ', 2) s2, substring(p_name, 2, 5) sub, position('e' in p_name) pos,
    starts_with(p_type, 'PROMO') promo, contains(p_name, 'green') green, concat_ws(':', p_brand, p_size::varchar) cw, translate(p_name, 'aeiou', '12345') tr, length(trim(p_name)) len from part"""
)
def string_functions(t: Tables):
    return t.part.select(
        "p_partkey", F.upper("p_brand").alias("u"), F.replace("p_name", F.lit("a"), F.lit("_")).alias("r"), F.split_part("p_type", F.lit(" "), F.lit(2)).alias("s2"),
        F.substring("p_name", 2, 5).alias("sub"), F.instr("p_name", "e").cast("long").alias("pos"), F.col("p_type").startswith("PROMO").alias("promo"), F.col("p_name").contains("green").alias("green"),
        F.concat_ws(":", "p_brand", F.col("p_size").cast("string")).alias("cw"), F.translate("p_name", "aeiou", "12345").alias("tr"), F.length(F.trim("p_name")).cast("long").alias("len"),
    )


@query(
    r"""select doc_id, md5(regexp_replace(text, '[aeiou]+', '-')) first_only, md5(regexp_replace(text, '[aeiou]+', '-', 'g')) everywhere,
    nullif(regexp_extract(text, '([0-9]{4})', 1), '') yr, regexp_matches(text, '[0-9]{3}') has_number, len(regexp_extract_all(text, '[A-Z][a-z]+')) capitals from documents"""
)
def regex_functions(t: Tables):
    md5 = lambda c: F.md5(c.cast("binary"))
    c = F.col("text")
    return t.documents.select(
        "doc_id", md5(text.replace_first(c, "[aeiou]+", "-")).alias("first_only"), md5(F.regexp_replace(c, "[aeiou]+", "-")).alias("everywhere"),
        F.nullif(F.regexp_extract(c, "([0-9]{4})", 1), F.lit("")).alias("yr"), c.rlike("[0-9]{3}").alias("has_number"),
        F.size(F.regexp_extract_all(c, F.lit("[A-Z][a-z]+"), F.lit(0))).cast("long").alias("capitals"),
    )


@query(
    """select event_id, floor((value - 50) / 10)::bigint b, least(greatest(value, 10), 90) clamp, round(ln(abs(value) + 1), 6) lg, (event_id % 7)::bigint m,
    round_even(value, 0)::bigint even, round(value, 1) r1, try_cast(regexp_extract(props, '([0-9]+)', 1) as bigint) k, year(ts) y, value < 0 neg from events"""
)
def math_functions(t: Tables):
    v = F.col("value")
    return t.events.select(
        "event_id", F.floor((v - 50) / 10).cast("long").alias("b"), F.least(F.greatest(v, F.lit(10.0)), F.lit(90.0)).alias("clamp"), F.round(F.log(F.abs(v) + 1), 6).alias("lg"),
        (F.col("event_id") % 7).alias("m"), F.bround(v, 0).cast("long").alias("even"), F.round(v, 1).alias("r1"),
        F.nullif(F.regexp_extract("props", "([0-9]+)", 1), F.lit("")).try_cast("long").alias("k"), F.year("ts").cast("long").alias("y"), (v < 0).alias("neg"),
    )


@query(
    """with l as (select conv_id, list(role order by turn, role) roles, list(length(text) order by turn, role, length(text)) sizes from conversations group by 1)
    select conv_id, roles[1] first_role, len(roles)::bigint n, array_to_string(list_sort(list_distinct(roles)), ',') kinds, list_contains(roles, 'system') has_system,
    array_to_string(sizes[1:3], ',') head, list_sum(list_filter(sizes, lambda x: x > 40))::bigint long_chars from l"""
)
def list_ops(t: Tables):
    roles = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])
    sizes = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", F.length("text").alias("n")))), lambda x: x["n"])
    lists = t.conversations.groupBy("conv_id").agg(roles.alias("roles"), sizes.alias("sizes"))
    long_ = F.filter("sizes", lambda x: x > 40)
    return lists.select(
        "conv_id", F.get("roles", 0).alias("first_role"), F.size("roles").cast("long").alias("n"), F.array_join(arrays.distinct(F.col("roles")), ",").alias("kinds"),
        arrays.contains(F.col("roles"), "system").alias("has_system"), F.array_join(F.slice("sizes", 1, 3).cast("array<string>"), ",").alias("head"),
        F.when(F.size(long_) > 0, F.aggregate(long_, F.lit(0).cast("long"), lambda a, x: a + x)).alias("long_chars"),
    )


@query(
    """with w as (select p_brand, w, count(*) n, min(p_partkey * 1000 + i) first from (select p_brand, p_partkey, unnest(string_split(p_name, ' ')) w, generate_subscripts(string_split(p_name, ' '), 1) i from part) group by 1, 2)
    select p_brand, string_agg(w, ' ' order by n desc, first) words from (select *, row_number() over (partition by p_brand order by n desc, first) r from w) where r <= 10 group by 1"""
)
def freq_sort(t: Tables):
    words = t.part.select("p_brand", "p_partkey", F.posexplode(F.split("p_name", " ")).alias("i", "w"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", "i", "w"))), lambda x: x["w"])
    lists = words.groupBy("p_brand").agg(ordered.alias("l"))
    return lists.select("p_brand", F.array_join(arrays.by_frequency(F.col("l"), 10), " ").alias("words"))


@query("select event_id, json_extract_string(props, '$.k')::bigint k, json_extract_string(props, '$.missing') missing from events")
def json_props(t: Tables):
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"), F.get_json_object("props", "$.missing").alias("missing"))


@query("select c_custkey, '{\"name\":\"' || c_name || '\",\"segment\":\"' || c_mktsegment || '\",\"nation\":' || c_nationkey::varchar || ',\"none\":null}' j from customer")
def json_pack(t: Tables):
    packed = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.lit(None).cast("string").alias("none"))
    return t.customer.select("c_custkey", F.to_json(packed, {"ignoreNullFields": "false"}).alias("j"))


@query(
    """with m as (select user_id, event_type, count(*) n, string_agg(event_id::varchar, ',' order by event_id) ids from events where value > 30 group by 1, 2)
    select user_id, string_agg(event_type, ',' order by event_type) kinds, count(*) size, max(case when event_type = 'click' then n end) clicks from m where n >= 2 group by 1"""
)
def map_ops(t: Tables):
    per = t.events.filter("value > 30").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = per.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    kept = maps.withColumn("m", F.map_filter("m", lambda k, v: v >= 2)).filter(F.size("m") > 0)
    return kept.select("user_id", F.array_join(F.sort_array(F.map_keys("m")), ",").alias("kinds"), F.size("m").cast("long").alias("size"), F.try_element_at("m", F.lit("click")).alias("clicks"))


@query(
    """with p as (select user_id, event_type, count(*) n from events group by 1, 2), m as (select user_id, user_id % 10 g, count(*) size from p group by 1)
    select g, user_id, size from (select *, row_number() over (partition by g order by size desc, user_id) r from m) where r = 1"""
)
def map_longest(t: Tables):
    per = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    best = F.min_by(F.struct("user_id", "m"), F.struct(-F.size("m"), F.col("user_id")))
    return per.groupBy((F.col("user_id") % 10).alias("g")).agg(best.alias("b")).select("g", F.col("b.user_id").alias("user_id"), F.size("b.m").cast("long").alias("size"))


@query(
    """with h as (select c_custkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || lower(concat_ws(':', c_mktsegment, c_name))::blob) h from customer)
    select c_custkey, substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||lower(to_hex((('0x'||substr(h,17,1))::int & 3) | 8))||substr(h,18,3)||'-'||substr(h,21,12) id, md5(c_custkey::varchar) m from h"""
)
def uuid_keys(t: Tables):
    return t.customer.select("c_custkey", keys.uuid5(keys.name_key(F.col("c_mktsegment"), F.col("c_name"))).alias("id"), F.md5(F.col("c_custkey").cast("string").cast("binary")).alias("m"))


@query(
    """select o_orderkey, stratum from (select o_orderkey, case when o_totalprice < 50000 then 'small' when o_totalprice < 200000 then 'middle' else 'large' end stratum,
    row_number() over (partition by stratum order by md5('s' || o_orderkey::varchar), o_orderkey) r from orders) where r <= 50"""
)
def stratified_sample(t: Tables):
    bucket = F.when(F.col("o_totalprice") < 50000, "small").when(F.col("o_totalprice") < 200000, "middle").otherwise("large")
    return sampling.stratified(t.orders, bucket, "o_orderkey", 50, "s").select("o_orderkey", "stratum")


@query(
    """select c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') segment, c_acctbal between 0 and 5000 middling, c_mktsegment in ('BUILDING', 'MACHINERY') heavy,
    (c_acctbal > 0)::int + (c_nationkey > 10)::int score, c_name like '%1' ends_one from customer"""
)
def predicates(t: Tables):
    return t.customer.select(
        "c_custkey", F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.lit("none")).alias("segment"), F.col("c_acctbal").between(0, 5000).alias("middling"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("heavy"), ((F.col("c_acctbal") > 0).cast("int") + (F.col("c_nationkey") > 10).cast("int")).alias("score"), F.col("c_name").like("%1").alias("ends_one"),
    )
