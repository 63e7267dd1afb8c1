"""Queries over the merge, vote, hierarchy, tile, diff and text operators.

The tables stand in for reference datasets: parts sold by many suppliers are
named by three "authorities", customers, nations and regions form a hierarchy,
events get coordinates from their ids, and two versions of orders make snapshots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgam.functions import arrays, geo, keys, ranks, text
from amalgam.operators import acceptance, areas, checks, cluster, dedupe, diff, joins, tiles, tree, vernacular, vote
from amalgam.plans.registry import Tables, query

# ---------------------------------------------------------------- votes

_BALLOTS = """
a as (select l_partkey k, min(l_returnflag) v from lineitem group by 1), b as (select l_partkey k, max(l_returnflag) v from lineitem where l_quantity > 25 group by 1),
c as (select l_partkey k, min_by(l_returnflag, (l_shipdate, l_orderkey, l_linenumber, l_returnflag)) v from lineitem where l_discount > 0.03 group by 1),
pool as (select p_partkey, p_name, a.v v1, b.v v2, c.v v3 from part left join a on p_partkey = a.k left join b on p_partkey = b.k left join c on p_partkey = c.k),
votes as (select p_partkey, v, count(*) n, min(pos) pos from (select p_partkey, v1 v, 1 pos from pool union all select p_partkey, v2, 2 from pool union all select p_partkey, v3, 3 from pool)
where v is not null group by 1, 2), won as (select p_partkey, v from (select *, row_number() over (partition by p_partkey order by n desc, pos) r from votes) where r = 1)
"""


def _authorities(t: Tables) -> list[tuple[str, DataFrame, str]]:
    line = t.lineitem
    first = F.min_by("l_returnflag", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag"))
    frames = [
        line.groupBy(F.col("l_partkey").alias("id_raw")).agg(F.min("l_returnflag").alias("flag")),
        line.filter("l_quantity > 25").groupBy(F.col("l_partkey").alias("id_raw")).agg(F.max("l_returnflag").alias("flag")),
        line.filter("l_discount > 0.03").groupBy(F.col("l_partkey").alias("id_raw")).agg(first.alias("flag")),
    ]
    return [(n, f, "p_partkey") for n, f in zip("abc", frames, strict=True)]


@query(f"with {_BALLOTS} select p.p_partkey, p.p_name, w.v flag_consensus from part p left join won w using (p_partkey)")
def vote_attr(t: Tables):
    return vote.consensus(t.part.select("p_partkey", "p_name"), _authorities(t), "flag")


@query(f"with {_BALLOTS} select p_partkey from pool where len(list_distinct([v1, v2, v3])) > 1")
def vote_ambiguous(t: Tables):
    pools = vote.consensus(t.part.select("p_partkey"), _authorities(t), "flag", keep_pool=True)
    return pools.filter(vote.ambiguous(F.col("flag_pool"))).select("p_partkey")


@query(
    """with a as (select p_partkey k, case when p_size > 1700 then null when p_partkey % 9 = 0 then 1600 else 1750 + p_size end y from part), b as (select p_partkey k, 1800 + p_size % 3 y from part where p_partkey % 2 = 0)
    select p.p_partkey, coalesce(case when a.y between 1700 and year(current_date) then a.y end, b.y)::bigint year_consensus from part p left join a on p.p_partkey = a.k left join b on p.p_partkey = b.k"""
)
def vote_admission(t: Tables):
    a = t.part.select(F.col("p_partkey").alias("id_raw"), F.when(F.col("p_size") <= 1700, F.when(F.col("p_partkey") % 9 == 0, 1600).otherwise(1750 + F.col("p_size"))).alias("year"))
    b = t.part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id_raw"), (1800 + F.col("p_size") % 3).alias("year"))
    out = vote.consensus(t.part.select("p_partkey"), [("a", a, "p_partkey"), ("b", b, "p_partkey")], "year")
    return out.select("p_partkey", F.col("year_consensus").cast("long"))


# ---------------------------------------------------------------- priority union and ids

_SOURCES = """
a as (select case when c_acctbal < 3000 then c_custkey end x, null::bigint y, 'n' || (c_custkey * 7 % 900)::varchar nm from customer),
b as (select c_custkey x, case when c_acctbal < 6000 then c_custkey * 10 end y, 'n' || (c_custkey * 11 % 1900)::varchar nm from customer),
c as (select null::bigint x, c_custkey * 20 y, 'n' || (c_custkey * 13 % 2900)::varchar nm from customer)
"""


def _sources(t: Tables) -> list[tuple[str, DataFrame]]:
    key, none = F.col("c_custkey"), F.lit(None).cast("long")
    name = lambda k, m: F.concat(F.lit("n"), (key * k % m).cast("string")).alias("nm")
    c = t.customer
    return [
        ("a", c.select(F.when(F.col("c_acctbal") < 3000, key).alias("x"), none.alias("y"), name(7, 900))),
        ("b", c.select(key.alias("x"), F.when(F.col("c_acctbal") < 6000, key * 10).alias("y"), name(11, 1900))),
        ("c", c.select(none.alias("x"), (key * 20).alias("y"), name(13, 2900))),
    ]


_UNION = f"""with {_SOURCES},
ab as (select 'a' source, * from a union all select 'b', * from b where not exists (select 1 from a where a.x = b.x) and not exists (select 1 from a where a.nm = b.nm)),
abc as (select * from ab union all select 'c', * from c where not exists (select 1 from ab where ab.y = c.y) and not exists (select 1 from ab where ab.nm = c.nm))"""


@query(f"{_UNION} select source, x, y, nm from abc")
def priority_union(t: Tables):
    return joins.priority_union(_sources(t), ["x", "y", "nm"]).select("source", "x", "y", "nm")


@query(
    f"""{_UNION}, l as (select x, min(y) y from b where x is not null group by 1), m as (select nm, min(y) y from b group by 1),
    one as (select source, abc.x, coalesce(abc.y, l.y) y, nm from abc left join l on abc.x = l.x)
    select source, x, coalesce(one.y, m.y) y, one.nm from one left join m on one.nm = m.nm"""
)
def cross_fill(t: Tables):
    rows = joins.priority_union(_sources(t), ["x", "y", "nm"])
    return joins.cross_fill(rows, _sources(t)[1][1], [("x", "y"), ("nm", "y")]).select("source", "x", "y", "nm")


@query(
    """select p_partkey, l_suppkey best from (select p_partkey, l_suppkey, row_number() over (partition by p_partkey order by case when l_returnflag = 'R' then 0 else 1 end, l_quantity desc nulls last, l_suppkey) r
    from part join lineitem on p_partkey = l_partkey) where r = 1"""
)
def best_match_id(t: Tables):
    candidates = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("best"), "l_returnflag", "l_quantity")
    order = [F.when(F.col("l_returnflag") == "R", 0).otherwise(1), F.desc_nulls_last("l_quantity"), F.col("best")]
    return joins.best_match(t.part.select("p_partkey"), candidates, "p_partkey", "p_partkey", order, "best")


@query(
    """with t as (select p_name nm, min(p_partkey) target from part where p_partkey % 2 = 0 group by 1), c as (select p_name nm, min(p_partkey) candidate from part where p_partkey % 2 = 1 group by 1)
    select target, candidate, nm from t join c using (nm)"""
)
def name_fallback(t: Tables):
    half = lambda rest, label: t.part.filter(F.col("p_partkey") % 2 == rest).select(F.col("p_partkey").alias(label), F.col("p_name").alias("nm"))
    return joins.name_fallback(half(0, "target"), half(1, "candidate"), "target", "candidate", "nm")


@query(
    """with known as (select c_custkey k from customer where c_acctbal >= 0), syn as (select c_custkey s, min(c_custkey - 1) a from customer where c_mktsegment = 'BUILDING' group by 1),
    r as (select o_orderkey, o_custkey cust_raw, coalesce(a, o_custkey) cust from orders left join syn on o_custkey = s)
    select o_orderkey, cust_raw, k cust from r left join known on cust = k"""
)
def id_polish(t: Tables):
    synonyms = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("s"), (F.col("c_custkey") - 1).alias("a"))
    resolved = joins.resolve_synonyms(t.orders.select("o_orderkey", F.col("o_custkey").alias("cust")), "cust", synonyms, "s", "a")
    return joins.keep_known(resolved, "cust", t.customer.filter("c_acctbal >= 0"), "c_custkey").select("o_orderkey", "cust_raw", "cust")


@query("with d as (select event_id, user_id, value * 2 v from events where event_type <> 'view') select event_id, user_id, value v from events where event_id not in (select event_id from d) union all select * from d")
def upsert_events(t: Tables):
    base = t.events.select("event_id", "user_id", F.col("value").alias("v"))
    return joins.upsert(base, t.events.filter("event_type <> 'view'").select("event_id", "user_id", (F.col("value") * 2).alias("v")), "event_id")


_SOURCE = """src as (select p_partkey id_raw, p_name name_clean, case when p_size < 20 then 'accepted' when p_size < 35 then 'synonym' when p_size < 45 then 'problematic' end status_clean,
case when p_retailprice > 1000 then [100000 + p_partkey, 200000 + p_partkey] end former from part),
mine as (select o_orderkey k, case o_orderpriority when '1-URGENT' then null when '2-HIGH' then 100000 + o_custkey when '3-MEDIUM' then 300000 + o_custkey else o_custkey end id, p_name nm, o_orderstatus <> 'F' accepted
from orders left join part on p_partkey = o_custkey)"""


@query(
    f"""with {_SOURCE}, moved as (select old, min(id_raw) new from (select id_raw, unnest(former) old from src) group by 1),
    one as (select k, coalesce(new, id) id, nm, accepted from mine left join moved on id = old), two as (select k, case when id in (select id_raw from src) then id end id, nm, accepted from one),
    current as (select name_clean, min(id_raw) to_id from src where status_clean = 'accepted' group by 1),
    three as (select k, coalesce(to_id, id) id, nm, accepted from two left join (select id_raw, to_id from src join current using (name_clean) where status_clean <> 'accepted') s on id = s.id_raw),
    best as (select name_clean, id_raw best from (select *, row_number() over (partition by name_clean order by case status_clean when 'accepted' then 0 when 'synonym' then 1 else 2 end, id_raw) r from src) where r = 1)
    select k, coalesce(id, best) id from three left join best on nm = name_clean where accepted union all select k, id from mine where not accepted"""
)
def polish_ids(t: Tables):
    size, price = F.col("p_size"), F.col("p_retailprice")
    status = F.when(size < 20, "accepted").when(size < 35, "synonym").when(size < 45, "problematic")
    source = t.part.select(F.col("p_partkey").alias("id_raw"), F.col("p_name").alias("name_clean"), status.alias("status_clean"), F.when(price > 1000, F.array(F.col("p_partkey") + 100000, F.col("p_partkey") + 200000)).alias("former"))
    named = t.orders.join(t.part.select(F.col("p_partkey").alias("o_custkey"), F.col("p_name").alias("nm")), "o_custkey", "left")
    cust, priority = F.col("o_custkey"), F.col("o_orderpriority")
    held = F.when(priority == "2-HIGH", cust + 100000).when(priority == "3-MEDIUM", cust + 300000).when(priority != "1-URGENT", cust)
    rows = named.select(F.col("o_orderkey").alias("k"), held.alias("id"), "nm", (F.col("o_orderstatus") != "F").alias("accepted"))
    return joins.polish_ids(rows, "id", "nm", source, status="status_clean", former="former").select("k", "id")


# ---------------------------------------------------------------- duplicates and acceptance


@query(
    """select p_name, p_partkey, m p_retailprice from (select p_name, p_partkey, max(p_retailprice) over (partition by p_name) m, row_number() over (partition by p_name
    order by (case when p_size > 25 then 1 else 0 end + case when p_retailprice > 1000 then 1 else 0 end) desc, p_partkey) r from part) where r = 1"""
)
def merge_duplicates(t: Tables):
    rows = t.part.select("p_name", "p_partkey", "p_retailprice", F.when(F.col("p_size") > 25, 1).alias("q1"), F.when(F.col("p_retailprice") > 1000, 1).alias("q2"))
    return dedupe.merge_duplicates(rows, "p_name", ["q1", "q2"], [F.col("p_partkey")], ["p_retailprice"]).select("p_name", "p_partkey", "p_retailprice")


@query("select min(doc_id) doc_id, count(*) copies from documents group by md5(text)")
def duplicate_texts(t: Tables):
    return t.documents.groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).drop("h")


_TAXA = """taxa as (select p_partkey k, p_name nm, p_brand brand, p_partkey % 4 <> 1 accepted, (p_partkey % 3)::int n_by, (p_partkey % 2)::int n_syn, case when p_partkey % 5 = 0 then null else 1700 + p_size end y,
case when p_partkey % 2 = 0 then p_type end typ from part)"""


@query(
    f"""with {_TAXA}, rivals as (select *, row_number() over (partition by nm order by n_by desc, n_syn, y nulls last, k) r, count(*) over (partition by nm) n from taxa where accepted),
    modes as (select nm, typ from (select nm, typ, row_number() over (partition by nm order by count(*) desc, typ) r from rivals where typ is not null group by nm, typ) where r = 1)
    select t.k, coalesce(r.r = 1, false) accepted, case when r.r = 1 and r.n > 1 then coalesce(t.typ, m.typ) else t.typ end typ from taxa t left join rivals r using (k) left join modes m on m.nm = t.nm"""
)
def dedupe_accepted(t: Tables):
    k = F.col("p_partkey")
    names = lambda n: F.transform(F.sequence(F.lit(1), n), lambda i: i.cast("string"))
    listed = lambda n: F.when(n > 0, names(n))
    taxa = t.part.select(
        k.alias("k"), F.col("p_name").alias("nm"), (k % 4 != 1).alias("accepted"), listed((k % 3).cast("int")).alias("accepted_by"), listed((k % 2).cast("int")).alias("considered_synonym"),
        F.when(k % 5 != 0, 1700 + F.col("p_size")).alias("year"), F.when(k % 2 == 0, F.col("p_type")).alias("typ"),
    )
    return dedupe.dedupe_accepted(taxa, ["nm"], "k", modes=["typ"]).select("k", "accepted", "typ")


@query(
    """with v as (select o_custkey k, case when min(o_orderstatus) = 'F' then 'accepted' else 'synonym' end a, case when max(o_orderpriority) > '4' then 'accepted' end b from orders group by 1)
    select c_custkey, concat_ws(',', case when a = 'accepted' then 'first' end, case when b = 'accepted' then 'second' end) accepted_by, coalesce(a = 'synonym', false) synonym,
    coalesce(a = 'accepted', false) or coalesce(b = 'accepted', false) accepted from customer left join v on c_custkey = k"""
)
def acceptance_arrays(t: Tables):
    per = t.orders.groupBy(F.col("o_custkey").alias("id_raw")).agg(F.min("o_orderstatus").alias("s"), F.max("o_orderpriority").alias("p"))
    first = per.select("id_raw", F.when(F.col("s") == "F", "accepted").otherwise("synonym").alias("status_clean"))
    second = per.select("id_raw", F.when(F.col("p") > "4", "accepted").alias("status_clean"))
    rows = t.customer.select("c_custkey", F.lit("x").alias("kingdom"))
    out = acceptance.decide(rows, [("first", first, "c_custkey"), ("second", second, "c_custkey")])
    return out.select("c_custkey", F.array_join("accepted_by", ",").alias("accepted_by"), "synonym", "accepted")


# ---------------------------------------------------------------- hierarchies

_NODES = """nodes as (select 'c' || c_custkey id, 'n' || c_nationkey parent, 'SPECIES' rank, c_name nm from customer union all select 'n' || n_nationkey, 'r' || n_regionkey, 'GENUS', n_name from nation
union all select 'r' || r_regionkey, null, 'FAMILY', r_name from region)"""


def _nodes(t: Tables) -> DataFrame:
    tag = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    node = lambda id_, parent, rank, name: [id_.alias("id"), parent.alias("parent"), F.lit(rank).alias("rank"), F.col(name).alias("nm")]
    return (
        t.customer.select(*node(tag("c", "c_custkey"), tag("n", "c_nationkey"), "SPECIES", "c_name"))
        .unionAll(t.nation.select(*node(tag("n", "n_nationkey"), tag("r", "n_regionkey"), "GENUS", "n_name")))
        .unionAll(t.region.select(*node(tag("r", "r_regionkey"), F.lit(None).cast("string"), "FAMILY", "r_name")))
    )


_CLOSURE = f"with recursive {_NODES}, up(node, ancestor, level) as (select id, parent, 1 from nodes where parent is not null union all select up.node, nodes.parent, up.level + 1 from up join nodes on up.ancestor = nodes.id where nodes.parent is not null)"


@query(f"{_CLOSURE} select node, ancestor, level from up")
def tree_closure(t: Tables):
    return tree.closure(_nodes(t))


@query(f"{_CLOSURE} select node, max(case when rank = 'FAMILY' then nm end) family, max(case when rank = 'GENUS' then nm end) genus from up join nodes on ancestor = id group by 1")
def closest_by_rank(t: Tables):
    near = tree.nearest_by_rank(tree.closure(_nodes(t)), _nodes(t), "id", "rank", "nm", ["FAMILY", "GENUS"])
    return near.select("node", F.col("FAMILY").alias("family"), F.col("GENUS").alias("genus"))


_HIGH = "select p_partkey k, case when p_partkey % 3 = 0 then p_brand end a, case when p_partkey % 2 = 0 then left(p_type, 8) end b, p_name c, p_partkey d from part"


@query(
    f"""with h as ({_HIGH}),
    ab as (select b, a from (select b, a, row_number() over (partition by b order by count(*) desc, a) r from h where a is not null and b is not null group by b, a) where r = 1),
    h1 as (select k, coalesce(h.a, ab.a) a, h.b, c from h left join ab on h.b = ab.b),
    ca as (select c, a from (select c, a, row_number() over (partition by c order by count(*) desc, a) r from h1 where a is not null group by c, a) where r = 1),
    h2 as (select k, coalesce(h1.a, ca.a) a, b, h1.c from h1 left join ca on h1.c = ca.c),
    cb as (select c, b from (select c, b, row_number() over (partition by c order by count(*) desc, b) r from h2 where b is not null group by c, b) where r = 1)
    select k, a, coalesce(h2.b, cb.b) b from h2 left join cb on h2.c = cb.c"""
)
def rank_backfill(t: Tables):
    k = F.col("p_partkey")
    rows = t.part.select(k.alias("k"), F.when(k % 3 == 0, F.col("p_brand")).alias("a"), F.when(k % 2 == 0, F.substring("p_type", 1, 8)).alias("b"), F.col("p_name").alias("c"), k.alias("d"))
    return tree.backfill(rows, ["a", "b", "c", "d"]).select("k", "a", "b")


@query(
    """with h as (select p_partkey k, case when p_size > 10 then p_brand end family, case when p_retailprice > 950 then p_type end genus, p_name nm, case when p_size % 3 = 0 then 'GENUS' else 'SPECIES' end rank from part),
    g as (select k, family, coalesce(genus, case when rank = 'SPECIES' and contains(nm, ' ') then split_part(nm, ' ', 1) end) genus from h),
    m as (select genus, family from (select genus, family, row_number() over (partition by genus order by count(*) desc, family) r from g where genus is not null and family is not null group by 1, 2) where r = 1)
    select k, coalesce(g.family, m.family) family, g.genus from g left join m using (genus)"""
)
def complete_ranks(t: Tables):
    size = F.col("p_size")
    rank = F.when(size % 3 == 0, "GENUS").otherwise("SPECIES")
    rows = t.part.select(F.col("p_partkey").alias("k"), F.when(size > 10, F.col("p_brand")).alias("family"), F.when(F.col("p_retailprice") > 950, F.col("p_type")).alias("genus"), F.col("p_name").alias("species"), F.col("p_name").alias("nm"), rank.alias("rank"))
    return tree.complete_ranks(rows, ["family", "genus", "species"], "nm", "rank").select("k", "family", "genus")


@query(
    """with x as (select p_partkey id, p_name nm, case when p_size < 40 then p_partkey * 7 % 2500 end parent, p_retailprice > 930 accepted from part),
    ok as (select id from x where accepted), byname as (select nm, min(id) other from x where accepted group by 1)
    select x.id, case when not x.accepted or x.parent in (select id from ok) then x.parent else b.other end parent from x left join x p on x.parent = p.id left join byname b on p.nm = b.nm"""
)
def parent_repair(t: Tables):
    k = F.col("p_partkey")
    rows = t.part.select(k.alias("id"), F.col("p_name").alias("name"), F.when(F.col("p_size") < 40, k * 7 % 2500).alias("parent"), (F.col("p_retailprice") > 930).alias("accepted"))
    return tree.repair_parents(rows).select("id", "parent")


@query(f"with {_NODES} select n.id, count(c.id) child_count from nodes n left join nodes c on c.parent = n.id group by 1")
def child_counts(t: Tables):
    return tree.with_child_count(_nodes(t)).select("id", "child_count")


@query(
    f"""with {_NODES}, l0 as (select id, parent, case when left(id, 1) = 'c' then substr(id, 2)::bigint % 40 = 7 else false end acc, case when left(id, 1) = 'c' then (substr(id, 2)::bigint % 3)::varchar end by_ from nodes),
    n as (select parent id, string_agg(distinct by_, ',' order by by_) bys from l0 where acc group by 1), r as (select l0.parent id, string_agg(distinct b, ',' order by b) bys from (select n.id, unnest(string_split(bys, ',')) b from n) x join l0 on l0.id = x.id where l0.parent is not null group by 1)
    select l0.id, l0.acc or n.id is not null or r.id is not null accepted, coalesce(case when l0.acc then by_ end, n.bys, r.bys, case when left(l0.id, 1) = 'c' then by_ end) accepted_by from l0 left join n on l0.id = n.id left join r on l0.id = r.id"""
)
def soft_cascade(t: Tables):
    number = F.substring(F.col("id"), 2, 20).cast("long")
    leaf = F.col("id").startswith("c")
    rows = _nodes(t).select("id", "parent", (leaf & (number % 40 == 7)).alias("accepted"), F.when(leaf, F.array((number % 3).cast("string"))).alias("accepted_by"))
    return tree.cascade(rows).select("id", "accepted", F.array_join("accepted_by", ",").alias("accepted_by"))


@query(
    """with g as (select split_part(p_name, ' ', 1) nm, min(p_partkey) k from part where p_partkey % 3 = 0 group by 1)
    select p.p_partkey k, g.k parent from part p join g on split_part(p.p_name, ' ', 1) = g.nm where p.p_partkey % 3 <> 0 and len(string_split(p.p_name, ' ')) = 2"""
)
def orphan_link(t: Tables):
    k, genus = F.col("p_partkey"), F.col("p_partkey") % 3 == 0
    rows = t.part.select(
        k.alias("k"), F.when(genus, F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise(F.col("p_name")).alias("nm"), F.lit("x").alias("kingdom"),
        F.when(genus, "GENUS").otherwise("SPECIES").alias("rank"), genus.alias("accepted"), F.when(genus, F.lit(-1)).cast("long").alias("parent"),
    )
    return tree.orphans_to_parents(rows, "k", "nm", "kingdom", "rank", [])


@query("with s as (select p_name nm, min(p_partkey) k from part where p_size <= 25 group by 1) select p_partkey k, s.k parent from part join s on p_name = s.nm where p_size > 25")
def orphan_species(t: Tables):
    """Names of three words go to the species of their first two."""
    low, k = F.col("p_size") > 25, F.col("p_partkey")
    rows = t.part.select(
        k.alias("k"), F.when(low, F.concat_ws(" ", "p_name", F.lower("p_type"))).otherwise(F.col("p_name")).alias("nm"), F.lit("x").alias("kingdom"),
        F.when(low, "VARIETY").otherwise("SPECIES").alias("rank"), (~low).alias("accepted"), F.when(~low, F.lit(-1)).cast("long").alias("parent"),
    )
    return tree.orphans_to_parents(rows, "k", "nm", "kingdom", "rank", [])


@query(f"with recursive {_NODES}, d(node, root) as (select id, id from nodes where id in ('r1', 'n2') union select nodes.id, d.root from d join nodes on nodes.parent = d.node) select node, min(root) root from d group by 1")
def lineage_scope(t: Tables):
    nodes = _nodes(t)
    return tree.descendants(nodes, nodes.filter(F.col("id").isin("r1", "n2")).select("id"))


# ---------------------------------------------------------------- tiles and histograms

_POINTS = "pts as (select user_id k, round((event_id * 37 % 36000) / 100.0 - 180, 3) lng, round((event_id * 91 % 17000) / 100.0 - 85, 3) lat, (value * 13)::double elev from events)"
_TILE = """(floor(least(greatest(((lng + 180.0) / 360.0) * 1024, 0.0), 1023.0)) * 1024 + floor(least(greatest(((1.0 - ln(tan(radians(least(greatest(lat, -85.05112878), 85.05112878)))
+ 1.0 / cos(radians(least(greatest(lat, -85.05112878), 85.05112878)))) / pi()) / 2.0) * 1024, 0.0), 1023.0)))::bigint"""
_SEED = f"""{_POINTS}, seed as (select k, {_TILE} tile_id, (min(lng) + max(lng)) / 2 center_lng, (min(lat) + max(lat)) / 2 center_lat, count(*) n from pts where not (lng = 0 and lat = 0) and not (lng = 1 and lat = 1) group by 1, 2)"""


def _points(t: Tables) -> DataFrame:
    e = F.col("event_id")
    return t.events.select(
        F.col("user_id").alias("k"), F.round((e * 37 % 36000) / 100.0 - 180, 3).alias("lng"), F.round((e * 91 % 17000) / 100.0 - 85, 3).alias("lat"), (F.col("value") * 13).alias("elev")
    )


def _seed(t: Tables) -> DataFrame:
    return tiles.tile_counts(tiles.usable_points(_points(t)), "k")


@query(f"with {_SEED} select k, tile_id, round(center_lng, 6) center_lng, round(center_lat, 6) center_lat, n from seed")
def tile_count(t: Tables):
    return _seed(t).select("k", "tile_id", F.round("center_lng", 6).alias("center_lng"), F.round("center_lat", 6).alias("center_lat"), F.col("count").alias("n"))


@query(
    f"""with {_SEED}, one as (select 100000 + k % 10 k, tile_id, sum(n)::bigint n from seed group by 1, 2), two as (select 200000 k, tile_id, sum(n)::bigint n from one group by 1, 2)
    select k, count(*) tiles, sum(n)::bigint n from (select k, tile_id, n from seed union all select * from one union all select * from two) group by 1"""
)
def tile_rollup(t: Tables):
    seed = _seed(t)
    users = seed.select("k").distinct()
    edges = users.select("k", (100000 + F.col("k") % 10).alias("parent"))
    edges = edges.unionAll(edges.select(F.col("parent").alias("k"), F.lit(200000).cast("long").alias("parent")).distinct())
    return tiles.guarded_rollup(seed, edges, "k").groupBy("k").agg(F.count(F.lit(1)).alias("tiles"), F.sum("count").alias("n"))


_GUARD = 2
_KEYED = "case when {n} > 2 then 'u:' || tile_id || '#' || {k} else 'm:' || tile_id end"


@query(
    f"""with {_SEED}, s as (select k, tile_id, center_lng x, center_lat y, n, {_KEYED.format(n="n", k="k")} mk from seed),
    a as (select 100000 + k % 10 k, tile_id, mk, min_by(x, (-n, x, y)) x, min_by(y, (-n, x, y)) y, sum(n)::bigint n from s group by 1, 2, 3),
    a2 as (select k, tile_id, x, y, n, case when mk like 'u:%' then mk else {_KEYED.format(n="n", k="k")} end mk from a),
    b as (select 200000 k, tile_id, mk, min_by(x, (-n, x, y)) x, min_by(y, (-n, x, y)) y, sum(n)::bigint n from a2 group by 1, 2, 3),
    b2 as (select k, tile_id, x, y, n, case when mk like 'u:%' then mk else {_KEYED.format(n="n", k="k")} end mk from b)
    select k, tile_id, mk merge_key, round(x, 6) center_lng, round(y, 6) center_lat, n from (select * from s union all by name select * from a2 union all by name select * from b2)"""
)
def tile_rollup_guarded(t: Tables):
    """Centres, counts and merge keys of the rollup, with a guard of two points so that tiles are kept apart."""
    seed = _seed(t)
    users = seed.select("k").distinct()
    edges = users.select("k", (100000 + F.col("k") % 10).alias("parent"))
    edges = edges.unionAll(edges.select(F.col("parent").alias("k"), F.lit(200000).cast("long").alias("parent")).distinct())
    out = tiles.guarded_rollup(seed, edges, "k", guard=_GUARD)
    return out.select("k", "tile_id", "merge_key", F.round("center_lng", 6).alias("center_lng"), F.round("center_lat", 6).alias("center_lat"), F.col("count").alias("n"))


@query(
    f"""with {_POINTS}, p as (select k, lng, lat, count(*) n from pts group by 1, 2, 3), s as (select 100000 + k % 10 k, lng, lat, sum(n) n from p group by 1, 2, 3),
    g as (select 300000 k, lng, lat, sum(n) n from s where k < 100005 group by 1, 2, 3) select k, count(*) points, sum(n)::bigint n, round(sum(lng * n), 3) lng from (select * from p union all select * from s union all select * from g) group by 1"""
)
def raw_rollup(t: Tables):
    """Points of species-level parents; edges to other ranks move nothing."""
    points = _points(t).select("k", "lng", "lat")
    users = points.select("k").distinct()
    up = users.select("k", (100000 + F.col("k") % 10).alias("parent"), F.lit("SPECIES").alias("parent_rank"))
    top = up.select(F.col("parent").alias("k")).distinct().select("k", F.lit(300000).cast("long").alias("parent"), F.when(F.col("k") < 100005, "SPECIES").otherwise("GENUS").alias("parent_rank"))
    out = tiles.raw_rollup(points, up.unionAll(top), "k", ["SPECIES", "SUBSPECIES", "VARIETY", "FORM"])
    return out.groupBy("k").agg(F.count(F.lit(1)).alias("points"), F.sum("count").alias("n"), F.round(F.sum(F.col("lng") * F.col("count")), 3).alias("lng"))


@query(
    f"""with {_SEED}, t as (select *, round(center_lng * 10000)::bigint || ':' || round(center_lat * 10000)::bigint || ':' || n item from seed)
    select k, string_agg(item, ' ' order by n < 20, n desc, tile_id) habitat from t group by 1"""
)
def geo_package_habitat(t: Tables):
    """The habitat JSON of the package, item by item and in its order."""
    items = F.from_json("habitat", "array<struct<lng:double,lat:double,occ:bigint>>")
    tenth = lambda x: F.round(x * 10000).cast("long").cast("string")
    text = F.array_join(F.transform(items, lambda i: F.concat_ws(":", tenth(i["lng"]), tenth(i["lat"]), i["occ"].cast("string"))), " ")
    return tiles.package(_seed(t), "k").select("k", text.alias("habitat"))


@query(
    f"""with {_POINTS}, b as (select k, (floor(elev / 100) * 100)::bigint bin, count(*) n from pts where elev is not null group by 1, 2),
    pr as (select k, '[' || string_agg('{{"elevation":' || bin || ',"occ":' || n || '}}', ',' order by bin) || ']' elevation_profile from b group by 1),
    r as (select k, bin, sum(n) over (partition by k order by bin) run, sum(n) over (partition by k) total from b), m as (select k, min(bin)::smallint elevation from r where run >= (total + 1) / 2 group by 1),
    c as (select k, count(*) centroids from (select distinct k, lng::decimal(8, 4), lat::decimal(8, 4) from pts) group by 1)
    select distinct p.k, elevation_profile, elevation, c.centroids from pts p left join pr using (k) left join m using (k) left join c using (k) where not (lng = 0 and lat = 0) and not (lng = 1 and lat = 1)"""
)
def geo_package_profile(t: Tables):
    """The profile JSON, the median and the number of distinct points of the package."""
    points = _points(t)
    bins = tiles.histogram(points, "k", "elev")
    out = tiles.package(_seed(t), "k", centroids=points, bins=bins, medians=tiles.histogram_median(bins, "k"))
    return out.select("k", "elevation_profile", "elevation", F.json_array_length("centroids").cast("long").alias("centroids"))


@query(
    f"""with {_SEED}, one as (select k, (floor(floor(tile_id / 1024) / 2) * 1024 + floor((tile_id % 1024) / 2))::bigint tile_id, 1 zoom_out, sum(n)::bigint n from seed group by 1, 2),
    h as (select k from seed group by 1 having count(*) > 60) select k, tile_id, zoom_out, n from one where k in (select k from h) union all select k, tile_id, 0, n from seed where k not in (select k from h)"""
)
def tile_coarsen(t: Tables):
    return tiles.coarsen(_seed(t), "k", target=60, rounds=1).select("k", "tile_id", "zoom_out", F.col("count").alias("n"))


@query(f"with {_SEED} select k, max(n) max, round(avg(n), 6) avg, sum(n)::bigint observations, count(*) cells from seed group by 1")
def geo_package(t: Tables):
    out = tiles.package(_seed(t), "k")
    return out.select("k", "max", F.round("avg", 6).alias("avg"), "observations", F.json_array_length("habitat").cast("long").alias("cells"))


@query(
    f"""with {_POINTS}, b as (select k, (floor(elev / 100) * 100)::bigint bin, count(*) n from pts where elev is not null group by 1, 2), g as (select k % 10 k, bin, sum(n) n from b group by 1, 2),
    c as (select k, bin, sum(n) over (partition by k order by bin) run, sum(n) over (partition by k) total from g) select k, min(bin) median from c where run >= (total + 1) / 2 group by 1"""
)
def weighted_median(t: Tables):
    bins = tiles.histogram(_points(t), "k", "elev").groupBy((F.col("k") % 10).alias("k"), "bin").agg(F.sum("count").alias("count"))
    return tiles.histogram_median(bins, "k")


@query(
    f"""with {_POINTS}, b as (select k, (floor(elev / 100) * 100)::bigint bin, count(*) n from pts where elev is not null group by 1, 2)
    select k, bin, n from b union all select 100000 + k % 10, bin, sum(n)::bigint from b group by 1, 2"""
)
def hist_rollup(t: Tables):
    bins = tiles.histogram(_points(t), "k", "elev")
    edges = bins.select("k").distinct().select("k", (100000 + F.col("k") % 10).alias("parent"))
    return tiles.histogram_rollup(bins, edges, "k").select("k", "bin", F.col("count").alias("n"))


@query(
    f"""with {_POINTS}, a as (select k, avg(lng) lng, avg(lat) lat from pts group by 1)
    select x.k, round(2 * 6371 * asin(least(1, sqrt(pow(sin((radians(y.lat) - radians(x.lat)) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin(radians(y.lng - x.lng) / 2), 2)))), 3) km
    from a x join a y on y.k = x.k + 1"""
)
def haversine_pairs(t: Tables):
    a = _points(t).groupBy("k").agg(F.avg("lng").alias("lng"), F.avg("lat").alias("lat"))
    b = a.select((F.col("k") - 1).alias("k"), F.col("lng").alias("lng2"), F.col("lat").alias("lat2"))
    return a.join(b, "k").select("k", F.round(geo.haversine_km(F.col("lng"), F.col("lat"), F.col("lng2"), F.col("lat2")), 3).alias("km"))


@query(
    f"""with {_SEED}, m as (select k, avg(lng) lng, avg(lat) lat from pts group by 1), d as (select k, center_lng, center_lat from (select *, row_number() over (partition by k order by n desc, tile_id) r from seed) where r = 1),
    e as (select 2 * 6371 * asin(least(1, sqrt(pow(sin((radians(d.center_lat) - radians(m.lat)) / 2), 2) + cos(radians(m.lat)) * cos(radians(d.center_lat)) * pow(sin(radians(d.center_lng - m.lng) / 2), 2)))) km from m join d using (k))
    select round(quantile_cont(km, 0.5), 3) p50, round(quantile_cont(km, 0.95), 3) p95, round(quantile_cont(km, 0.99), 3) p99 from e"""
)
def haversine_percentiles(t: Tables):
    """How far the densest tile of a key is from the mean of its points."""
    mean = _points(t).groupBy("k").agg(F.avg("lng").alias("lng"), F.avg("lat").alias("lat"))
    km = geo.haversine_km(F.col("lng"), F.col("lat"), F.col("center_lng"), F.col("center_lat"))
    found = mean.join(tiles.densest_tile(_seed(t), "k"), "k").select(km.alias("km")).agg(*geo.percentiles(F.col("km")))
    return found.select(*[F.round(c, 3).alias(c) for c in found.columns])


@query()
def centroids_raw(t: Tables):
    """Representative points of every label; no SQL form, tested by its invariants."""
    rows = t.embeddings.select("label", (F.col("embedding")[0] * 60).alias("lng"), (F.col("embedding")[1] * 60).alias("lat"))
    return cluster.centroids(rows, "label")


@query()
def centroids_weighted(t: Tables):
    """Representative tiles of every user, weighted by their counts; no SQL form."""
    return cluster.centroids(_seed(t), "k", "center_lng", "center_lat", "count")


@query(f"with {_SEED} select k, case when count(*) < 60 or sum(n) >= 70 and k % 29 <= 12 then 'raw' else 'tiles' end mode from seed group by 1")
def centroid_modes(t: Tables):
    stats = _seed(t).groupBy("k").agg(F.count(F.lit(1)).alias("tiles"), F.sum("count").alias("raw")).withColumn("rank", F.col("k") % 29)
    return cluster.modes(stats, "k", "rank", "raw", few_tiles=60, many_points=70)


# ---------------------------------------------------------------- snapshots

_SNAPSHOTS = """cur as (select case when o_orderkey % 50 = 3 then o_orderkey + 10000000 else o_orderkey end id, o_orderstatus st, case when o_orderkey % 20 = 1 then o_totalprice + 1 else o_totalprice end price, o_custkey cust
from orders where o_orderpriority <> '1-URGENT'), prev as (select o_orderkey id, o_orderstatus st, o_totalprice price, o_custkey cust from orders where o_orderpriority <> '2-HIGH')"""


def _snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    k, o = F.col("o_orderkey"), t.orders
    rest = [F.col("o_orderstatus").alias("st")]
    cur = o.filter("o_orderpriority <> '1-URGENT'").select(
        F.when(k % 50 == 3, k + 10000000).otherwise(k).alias("id"), *rest, F.when(k % 20 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("price"), F.col("o_custkey").alias("cust")
    )
    return cur, o.filter("o_orderpriority <> '2-HIGH'").select(k.alias("id"), *rest, F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("cust"))


_TAGGED = f"""with {_SNAPSHOTS}, j as (select coalesce(c.id, p.id) id, c.id ci, p.id pi, c.st st, c.price price, c.cust cust, p.st pst, p.price pprice, p.cust pcust from cur c full join prev p on c.id = p.id),
tagged as (select case when pi is null then 'new' when ci is null then 'deleted' when st is distinct from pst or price is distinct from pprice then 'changed' end category, id, st, price, cust, pst, pprice, pcust,
concat_ws(',', case when ci is not null and pi is not null and st is distinct from pst then 'st' end, case when ci is not null and pi is not null and price is distinct from pprice then 'price' end) fields from j)"""


@query(f"{_TAGGED} select category, id::varchar id, fields from tagged where category is not null")
def snapshot_diff(t: Tables):
    return diff.changes(*_snapshots(t), "id", ["st", "price"]).select("category", "id", F.array_join("fields", ",").alias("fields"))


@query(
    f"""{_TAGGED}, n as (select * from (select *, count(*) over (partition by st, price, cust) c from tagged where category = 'new') where c = 1), d as (select * from (select *, count(*) over (partition by pst, pprice, pcust) c from tagged where category = 'deleted') where c = 1),
    r as (select n.id, d.id old from n join d on n.st is not distinct from d.pst and n.price is not distinct from d.pprice and n.cust is not distinct from d.pcust)
    select category, id::varchar id, null::varchar old_id, fields from tagged where category is not null and not (category = 'new' and id in (select id from r)) and not (category = 'deleted' and id in (select old from r))
    union all select 'changed', id::varchar, old::varchar, 'id_raw' from r"""
)
def rekey_diff(t: Tables):
    found = diff.changes(*_snapshots(t), "id", ["st", "price"], context=["cust"], rekeys=True)
    return found.select("category", "id", "old_id", F.array_join("fields", ",").alias("fields"))


@query(
    f"""{_TAGGED}, c as (select count(*) filter (where category = 'new') n_new, count(*) filter (where category = 'changed') n_changed, count(*) filter (where category = 'deleted') n_deleted from tagged)
    select c.*, (select count(*) from cur) cur_scope, (select count(*) from prev) prev_scope, greatest(n_new, n_changed, n_deleted) / (select count(*) from prev) > 0.1 suspicious,
    greatest(n_new, n_changed, n_deleted) > case when greatest(n_new, n_changed, n_deleted) / (select count(*) from prev) > 0.1 then 200 else 2000 end truncated from c"""
)
def diff_summary(t: Tables):
    cur, prev = _snapshots(t)
    return diff.summary(diff.changes(cur, prev, "id", ["st", "price"]), cur, prev)


@query(
    """select 'orders_floor' name, case when (select count(*) from orders) >= 100 then 'passed' else 'failed' end status union all
    select 'no_negative_quantity', case when exists (select 1 from lineitem where l_quantity < 0) then 'failed' else 'passed' end union all
    select 'nations_have_regions', case when exists (select 1 from nation where n_regionkey not in (select r_regionkey from region)) then 'failed' else 'passed' end union all
    select 'absent_column', 'skipped'"""
)
def sentinel_checks(t: Tables):
    rules = [
        checks.Check("orders_floor", lambda s: t.orders.groupBy().count().filter("count >= 100"), "any", "too few orders"),
        checks.Check("no_negative_quantity", lambda s: t.lineitem.filter("l_quantity < 0"), "none", "negative quantities"),
        checks.Check("nations_have_regions", lambda s: joins.not_in(t.nation, t.region, "n_regionkey", "r_regionkey"), "none", "dangling nations"),
        checks.Check("absent_column", lambda s: t.orders.filter("no_such_column = 1"), "none", "never runs"),
    ]
    return checks.run_checks(t.spark, rules).select("name", "status")


# ---------------------------------------------------------------- names and texts


@query(
    r"""select doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), ' (notho)?(ser|sect|subsect|subgen|sub|bb|ab|mut|var|subvar|convar|race|subsp|subspec|ssp|forma|form|subf|f|fo|fma|unr|lus|lusus|prol|proles|sp nov|sp\. nov|f\.sp\.|\[unranked\])(\.?)(\s|$)', ' ', 'g'),
    '["ʽ‛‟′″‴’‘]', '''', 'g'), '[^a-z -'']', '', 'g'), ' {2,}', ' ', 'g'), '\t+', ' ', 'g'))) h from documents"""
)
def text_normalise(t: Tables):
    return t.documents.select("doc_id", F.md5(text.clean_name(F.lower("text")).cast("binary")).alias("h"))


@query(
    """with r as (select p_partkey, p_brand, lower(p_type) nm, lower(split_part(p_type, ' ', 1)) term from part)
    select p_partkey, case when contains(nm, term) and term <> '' then trim(regexp_replace(replace(nm, term, ''), '\\s+', ' ', 'g')) else nm end nm from r"""
)
def strip_term(t: Tables):
    return t.part.select("p_partkey", text.without_term(F.lower("p_type"), F.split_part("p_type", F.lit(" "), F.lit(1))).alias("nm"))


@query(
    """with r as (select c_custkey, case c_custkey % 7 when 0 then 'Subsp.' when 1 then 'VAR.' when 2 then 'species' when 3 then 'nope' when 4 then 'fam.' when 5 then 'gen.' end rank_raw,
    case c_custkey % 4 when 0 then 'Accepted' when 1 then 'homotypic synonym' when 2 then 'Invalid' end status_raw from customer)
    select c_custkey, case rank_raw when 'Subsp.' then 'subspecies' when 'VAR.' then 'variety' when 'species' then 'species' when 'fam.' then 'family' when 'gen.' then 'genus' end rank_clean,
    case status_raw when 'Accepted' then 'accepted' when 'homotypic synonym' then 'synonym' when 'Invalid' then 'problematic' end status_clean, status_clean = 'synonym' synonym, status_clean = 'accepted' accepted from r"""
)
def rank_status(t: Tables):
    pick = lambda n, words: F.try_element_at(F.create_map(*[x for i, w in enumerate(words) for x in (F.lit(i), F.lit(w))]), (F.col("c_custkey") % n).cast("int"))
    rows = t.customer.select("c_custkey", pick(7, ["Subsp.", "VAR.", "species", "nope", "fam.", "gen."]).alias("rank_raw"), pick(4, ["Accepted", "homotypic synonym", "Invalid"]).alias("status_raw"))
    return text.with_rank_and_status(rows).select("c_custkey", "rank_clean", "status_clean", "synonym", "accepted")


@query(
    """with r as (select p_partkey, case when p_partkey % 3 = 0 then replace(p_name, ' ', ' x ') when p_partkey % 3 = 1 then '×' || p_name else p_name end nm, case when p_partkey % 10 = 2 then 'nothosp.' else 'species' end rk from part),
    m as (select p_partkey, replace(nm, ' x ', ' × ') nm, rk from r)
    select p_partkey, contains(nm, '×') or rk like 'notho%' hybrid, nullif(position('×' in nm) - 1, -1)::bigint hybridpos, replace(replace(nm, '× ', ''), '×', '') nm from m"""
)
def hybrid_names(t: Tables):
    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, F.replace("p_name", F.lit(" "), F.lit(" x "))).when(k % 3 == 1, F.concat(F.lit("×"), F.col("p_name"))).otherwise(F.col("p_name"))
    rows = t.part.select("p_partkey", name.alias("nm"), F.when(k % 10 == 2, "nothosp.").otherwise("species").alias("rank_raw"))
    return text.with_hybrids(rows, "nm").select("p_partkey", "hybrid", F.col("hybridpos").cast("long").alias("hybridpos"), "nm")


@query(
    """select c_custkey, trim(regexp_replace(a, ',\\s*\\(?[0-9]{4}\\)?\\s*$', '')) author, nullif(regexp_extract(a, ',\\s*\\(?([0-9]{4})\\)?\\s*$', 1), '')::int y
    from (select c_custkey, c_name || case when c_custkey % 2 = 0 then ', ' || (1700 + c_custkey % 300)::varchar when c_custkey % 5 = 0 then ', (1753) ' else '' end a from customer)"""
)
def author_year_split(t: Tables):
    k = F.col("c_custkey")
    a = F.concat("c_name", F.when(k % 2 == 0, F.concat(F.lit(", "), (1700 + k % 300).cast("string"))).when(k % 5 == 0, F.lit(", (1753) ")).otherwise(F.lit("")))
    author, year = text.author_and_year(a)
    return t.customer.select("c_custkey", author.alias("author"), year.alias("y"))


_AREAS = "areas as (select distinct case n_nationkey % 5 when 0 then n_name when 1 then n_name || ' (south)' when 2 then n_name || '; elsewhere' when 3 then 'Somewhere, ' || n_name else substr(n_name, 1, 2) end area from nation)"


@query(
    f"""with {_AREAS}, g as (select trim(regexp_replace(lower(n_name), '[^a-z0-9]+', ' ', 'g')) f, min(n_nationkey::varchar) code from nation group by 1),
    c as (select area, area cand, 0 p from areas union all select area, trim(regexp_replace(area, '\\([^)]*\\)', '', 'g')), 1 from areas union all select area, trim(split_part(area, ';', 1)), 2 from areas where contains(area, ';')
    union all select area, trim(unnest(string_split(area, ','))), 3 from areas union all select area, trim(regexp_extract(area, '([^,]+)$', 1)), 4 from areas where contains(area, ',')),
    m as (select area, code, row_number() over (partition by area order by p, length(cand) desc, code) r from c join g on trim(regexp_replace(lower(cand), '[^a-z0-9]+', ' ', 'g')) = f)
    select area, code from m where r = 1 union all select area, lower(area) from areas where regexp_matches(area, '^[A-Za-z]{{2}}$') and area not in (select area from m)"""
)
def area_match(t: Tables):
    k, n = F.col("n_nationkey") % 5, F.col("n_name")
    area = F.when(k == 0, n).when(k == 1, F.concat(n, F.lit(" (south)"))).when(k == 2, F.concat(n, F.lit("; elsewhere"))).when(k == 3, F.concat(F.lit("Somewhere, "), n)).otherwise(F.substring(n, 1, 2))
    return areas.match_areas(t.nation.select(area.alias("area")), t.nation.select(n.alias("name"), F.col("n_nationkey").cast("string").alias("code")))


@query(
    """with p as (select l_partkey nm, year(l_shipdate) y, l_orderkey k, l_returnflag f from lineitem)
    select nm, 'first' kind, k, y from (select *, row_number() over (partition by nm order by y, k) r from p) where r = 1
    union all select nm, 'first_returned', k, y from (select *, row_number() over (partition by nm order by y, k) r from p where f = 'R') where r = 1"""
)
def first_mention(t: Tables):
    pages = t.lineitem.select(F.col("l_partkey").alias("nm"), F.year("l_shipdate").cast("long").alias("y"), F.col("l_orderkey").alias("k"), "l_returnflag")
    return areas.first_mentions(pages, "nm", "y", "k", {"first": "true", "first_returned": "l_returnflag = 'R'"})


@query("select c_custkey, coalesce(case lang when 'ger' then 'de' when 'fre' then 'fr' when 'zh-hans' then 'zh' end, lang) lang from (select c_custkey, case c_custkey % 4 when 0 then 'ger' when 1 then 'fre' when 2 then 'zh-hans' else 'xx' end lang from customer)")
def language_codes(t: Tables):
    k = F.col("c_custkey") % 4
    rows = t.customer.select("c_custkey", F.when(k == 0, "GER").when(k == 1, "fre").when(k == 2, "zh-Hans").otherwise("xx").alias("lang"))
    return vernacular.normalise_languages(rows, "lang", {"ger": "de", "fre": "fr", "zh-hans": "zh"})


@query(
    """with w as (select p_brand, list(distinct split_part(p_name, ' ', 2)) ws from part group by 1)
    select p_brand, list_contains(ws, 'green') green, list_contains(ws, 'blue') or list_contains(ws, 'azure') bluish, len(ws)::bigint n from w"""
)
def trait_flags(t: Tables):
    w = t.part.groupBy("p_brand").agg(F.collect_set(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("ws"))
    ws = F.col("ws")
    return w.select("p_brand", arrays.contains(ws, "green").alias("green"), (arrays.contains(ws, "blue") | arrays.contains(ws, "azure")).alias("bluish"), F.size("ws").cast("long").alias("n"))


@query("with n as (select distinct p_name from part) select a.p_name a, b.p_name b, levenshtein(a.p_name, b.p_name) d from n a join n b on split_part(a.p_name, ' ', 1) = split_part(b.p_name, ' ', 1) and a.p_name < b.p_name where levenshtein(a.p_name, b.p_name) < 6")
def lev_pairs(t: Tables):
    n = t.part.select("p_name", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("w")).distinct()
    a, b = n.withColumnRenamed("p_name", "a"), n.withColumnRenamed("p_name", "b")
    d = F.levenshtein("a", "b")
    return a.join(b, "w").filter("a < b").filter(d < 6).select("a", "b", d.cast("long").alias("d"))


@query()
def lev_cluster(t: Tables):
    """Clustered spellings of the words of each conversation; order-dependent, tested against a plain loop."""
    words = t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", r"\s+")).alias("i", "name"))
    names = words.select(F.col("conv_id").alias("k"), F.when(F.col("turn") % 2 == 0, "en").otherwise("de").alias("lang"), "name", F.struct("turn", "i").alias("o"))
    out = vernacular.reduce_names(names, "k", "o")
    return out.select("k", F.to_json("vernacular").alias("vernacular"), "common_name")


@query(
    f"""with r as (select c_custkey k, case c_custkey % 6 when 0 then 'GENUS' when 1 then 'species' when 2 then 'KINGDOM' when 3 then 'form' when 4 then 'bogus' end rk from customer)
    select k, (case upper(rk) {' '.join(f"when '{r}' then {i}" for i, r in enumerate(ranks.RANKS))} end)::bigint ordinal from r"""
)
def rank_order(t: Tables):
    k = F.col("c_custkey") % 6
    rk = F.when(k == 0, "GENUS").when(k == 1, "species").when(k == 2, "KINGDOM").when(k == 3, "form").when(k == 4, "bogus")
    return t.customer.select(F.col("c_custkey").alias("k"), ranks.rank_ordinal(rk).cast("long").alias("ordinal"))


@query("select c_custkey k, md5(lower(concat_ws(':', c_mktsegment, nullif(c_nationkey::varchar, '7'), c_name))) h from customer")
def name_keys(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("k"), F.md5(keys.name_key(F.col("c_mktsegment"), F.nullif(F.col("c_nationkey").cast("string"), F.lit("7")), F.col("c_name")).cast("binary")).alias("h"))


@query("select doc_id, length(text)::bigint n, len(string_split(text, chr(10)))::bigint n_lines from documents where contains(text, 'the') and not regexp_matches(text, '[0-9]')")
def text_filter(t: Tables):
    return t.documents.filter(F.col("text").contains("the") & ~F.col("text").rlike("[0-9]")).select("doc_id", F.length("text").cast("long").alias("n"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
