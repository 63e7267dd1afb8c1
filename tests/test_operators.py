import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from amalgam.operators import acceptance, areas, checks, cluster, dedupe, diff, joins, sampling, tiles, tree, vernacular, vote
from amalgam.plans import catalog


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_priority_union_null_keys_never_match(spark):
    a = spark.createDataFrame([("1", "x", "rosa"), (None, "y", None)], "a_id string, b_id string, nm string")
    b = spark.createDataFrame([("1", "new"), (None, None), (None, "rosa"), ("2", "tulipa")], "a_id string, nm string")
    got = joins.priority_union([("a", a), ("b", b)], ["a_id", "b_id", "nm"])
    assert rows(got.select("source", "a_id", "nm")) == sorted([("a", "1", "rosa"), ("a", None, None), ("b", None, None), ("b", "2", "tulipa")], key=repr)


def test_fill_from_keeps_existing_and_takes_one(spark):
    left = spark.createDataFrame([(1, "old"), (2, None), (None, None)], "k int, v string")
    right = spark.createDataFrame([(1, "n"), (2, "b"), (2, "a"), (None, "z")], "k int, v string")
    assert rows(joins.fill_from(left, right, "k", ["v"]).select("k", "v")) == sorted([(1, "old"), (2, "a"), (None, None)], key=repr)


def test_redirect_and_known(spark):
    data = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id long")
    merged = spark.createDataFrame([(9, [1, 5]), (8, [1]), (7, None)], "cur long, old array<long>")
    out = joins.redirect(data, "id", merged, "cur", "old")
    assert rows(out) == sorted([(8,), (2,), (3,), (None,)], key=repr)
    known = spark.createDataFrame([(8,), (2,), (None,)], "k long")
    assert rows(joins.keep_known(out, "id", known, "k")) == sorted([(8,), (2,), (None,), (None,)], key=repr)


def test_vote_admission_trim_and_fallback(spark):
    base = spark.createDataFrame([("1", "orig"), ("2", "orig"), ("3", "orig")], "a_id string, name_clean string")
    a = spark.createDataFrame([("1", "one two three four"), ("2", " rosa "), ("3", None)], "id_raw string, name_clean string")
    b = spark.createDataFrame([("1", "short name"), ("2", "tulipa"), ("2", "tulipa")], "id_raw string, name_clean string")
    got = vote.consensus(base, [("a", a, "a_id"), ("b", b, "a_id"), ("c", b.select("id_raw"), "a_id")], "name_clean", "name_clean")
    assert {r.a_id: r.name_consensus for r in got.collect()} == {"1": "short name", "2": "rosa", "3": "orig"}
    ranks = spark.createDataFrame([("1", "species"), ("2", "greek")], "id_raw string, rank_clean string")
    assert {r.a_id: r.rank_consensus for r in vote.consensus(base, [("r", ranks, "a_id")], "rank_clean").collect()} == {"1": "SPECIES", "2": None, "3": None}


def test_parent_votes_prefer_the_accepted_row(spark):
    data = [("m1", "x", "rosa", True, "10"), ("m2", "x", "rosa", False, "20"), ("m3", "x", "rosa alba", True, "30")]
    base = spark.createDataFrame(data, "id_meso string, kingdom string, name_consensus string, accepted boolean, a_id string")
    a = spark.createDataFrame([("30", "20"), ("10", None), ("20", "99")], "id_raw string, parent_raw string")
    assert rows(vote.parent_votes(base, [("a", a, "a_id")])) == [("m3", "a", "m1")]


def test_acceptance_lists_and_popular(spark):
    base = spark.createDataFrame([("1", "plantae", 9, "SPECIES"), ("2", "fungi", 9, "GENUS"), ("3", "plantae", None, None)], "a_id string, kingdom string, pages int, rank_consensus string")
    a = spark.createDataFrame([("1", "synonym"), ("2", "accepted"), ("3", "accepted")], "id_raw string, status_clean string")
    got = acceptance.decide(base, [("a", a, "a_id")], lists={"plantae": ["a"]}, popular=("wiki", "pages", 6, "SPECIES"))
    assert {r.a_id: (r.accepted_by, r.considered_synonym, r.synonym, r.accepted) for r in got.collect()} == {
        "1": ([], ["a"], True, False), "2": ([], [], False, False), "3": (["a"], [], False, True)
    }


def test_dedupe_accepted_null_lists(spark):
    data = [(1, "n", True, ["a"], None, 1800, None, ["x"]), (2, "n", True, ["a", "b"], ["c"], 1900, None, None), (3, "n", True, ["a", "b"], None, 1950, "t", ["y", "x"]), (4, "n", False, None, None, None, "z", ["q"]), (5, "o", True, None, None, None, None, None)]
    df = spark.createDataFrame(data, "k int, nm string, accepted boolean, accepted_by array<string>, considered_synonym array<string>, year int, typ string, areas array<string>")
    got = {r.k: (r.accepted, r.typ, r.areas) for r in dedupe.dedupe_accepted(df, ["nm"], "k", ["typ"], ["areas"]).collect()}
    assert got == {1: (False, None, ["x"]), 2: (False, None, None), 3: (True, "t", ["x", "y"]), 4: (False, "z", ["q"]), 5: (True, None, None)}


def test_closure_with_a_circle_and_self_parent(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "d"), ("e", "a"), ("f", None)], "id string, parent string")
    got = {(r.node, r.ancestor): r.level for r in tree.closure(edges).collect()}
    assert got["e", "a"] == 1 and got["e", "c"] == 3 and got["a", "a"] == 3 and ("d", "d") not in got and len(got) == 12


def test_cascade_reaches_the_root(spark):
    data = [("s", "g", True, ["x"]), ("g", "f", False, []), ("f", None, False, None), ("q", "f", False, ["z"])]
    df = spark.createDataFrame(data, "id string, parent string, accepted boolean, accepted_by array<string>")
    assert {r.id: (r.accepted, r.accepted_by) for r in tree.cascade(df).collect()} == {"s": (True, ["x"]), "g": (True, ["x"]), "f": (True, ["x"]), "q": (False, ["z"])}


def test_child_count_drops_dangling(spark):
    df = spark.createDataFrame([("a", "zz"), ("b", "a"), ("c", "a")], "id string, parent string")
    assert {r.id: (r.parent, r.child_count) for r in tree.with_child_count(df).collect()} == {"a": (None, 2), "b": ("a", 0), "c": ("a", 0)}


def test_vernacular(spark):
    assert vernacular.cluster_names(["becherprimel", "becher-primel", "becherprimel", "gift-primel", "becher primel"]) == ["becherprimel"] * 3 + ["gift-primel", "becherprimel"]
    assert vernacular.distance("kitten", "sitting", 9) == 3 and vernacular.distance("", "abc", 2) == 2
    data = [("k", "en", "Dog Rose", 1), ("k", "en", "dog rose ", 2), ("k", "en", "briar", 3), ("k", "de", "Hundsrose", 1), ("k", "de", "Rosa canina", 2), ("k", None, "x", 1), ("m", "fr", "Rosa canina", 1)]
    names = spark.createDataFrame(data, "k string, lang string, name string, o int")
    science = spark.createDataFrame([("k", "rosa canina"), ("m", "rosa canina")], "k string, sci string")
    got = vernacular.reduce_names(names, "k", "o", science).collect()
    assert [(r.k, r.vernacular, r.common_name) for r in got] == [("k", {"en": ["dog rose", "briar"], "de": ["hundsrose"]}, "dog rose")]
    tagged = spark.createDataFrame([("k", ["en:a:b", "de:c"])], "k string, v array<string>")
    assert rows(vernacular.unpack(tagged, "k", "v")) == [("k", "de", "c"), ("k", "en", "a:b")]


def test_clusters_equal_a_plain_loop():
    def plain(names, within):
        counts = {n: names.count(n) for n in names}
        left, usual = list(counts), {}
        while left:
            near = [n for n in left if n == left[0] or vernacular.distance(left[0], n, within) < within]
            usual |= dict.fromkeys(near, max(near, key=counts.__getitem__))
            left = [n for n in left if n not in usual]
        return [usual[n] for n in names]

    rng = random.Random(3)
    for within in [0, 1, 2, 3, 4] * 60:
        names = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 40))]
        assert vernacular.cluster_names(names, within) == plain(names, within)


def test_clusters_compare_few_names(monkeypatch):
    """Names about the length at which the index changes cluster as by comparing all, with few comparisons."""
    rng, calls, plain = random.Random(5), [0], vernacular.distance

    def counted(a, b, limit):
        calls[0] += 1
        return plain(a, b, limit)

    def by_all(names, within=3):
        left, usual = list(dict.fromkeys(names)), {}
        while left:
            near = [n for n in left if n == left[0] or plain(left[0], n, within) < within]
            usual |= dict.fromkeys(near, max(near, key=names.count))
            left = [n for n in left if n not in usual]
        return [usual[n] for n in names]

    monkeypatch.setattr(vernacular, "distance", counted)
    names = ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd"]) for _ in range(rng.randint(1, 9))) for _ in range(900)]
    names += [n[:3] + n[4:] + "x" for n in names[:300]]
    assert vernacular.cluster_names(names) == by_all(names)
    assert calls[0] < 3_000


def test_lists_are_clustered_in_many_tasks(spark):
    names = spark.range(400).select((F.col("id") % 40).alias("k"), F.lit("en").alias("lang"), F.concat(F.lit("name"), "id").alias("name"), F.col("id").alias("o"))
    out = vernacular.reduce_names(names, "k", "o")
    assert out.count() == 40
    clustering = out._jdf.queryExecution().executedPlan().toString().split("_clustered", 1)[1]
    assert "hashpartitioning(k#" in clustering and f", {4 * spark.sparkContext.defaultParallelism}), REPARTITION_BY_NUM" in clustering


def test_lev_cluster_takes_every_line_and_any_white_space(spark, tmp_path):
    rows = [(1, 0, "harbour\nlantern\tmeadow"), (1, 1, "Fenster  Garten\n\nBirnbaum"), (2, 0, None)]
    spark.createDataFrame(rows, "conv_id long, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.k: (json.loads(r.vernacular), r.common_name) for r in catalog.QUERIES["lev_cluster"](spark, str(tmp_path)).collect()}
    assert got == {1: ({"en": ["harbour", "lantern", "meadow"], "de": ["fenster", "garten", "birnbaum"]}, "harbour")}


def test_tiles_guard_and_coarsening(spark):
    seed = spark.createDataFrame([(1, 10, 0.0, 0.0, 60), (2, 10, 1.0, 1.0, 5), (3, 10, 2.0, 2.0, 7)], "k long, tile_id long, center_lng double, center_lat double, count long")
    edges = spark.createDataFrame([(1, 9), (2, 9), (3, 9), (9, 8)], "k long, parent long")
    got = tiles.guarded_rollup(seed, edges, "k", guard=50).filter("k >= 8")
    assert rows(got.select("k", "count", "center_lng")) == sorted([(9, 60, 0.0), (9, 12, 2.0), (8, 60, 0.0), (8, 12, 2.0)], key=repr)
    many = spark.range(64).select(F.lit(1).alias("k"), (F.floor(F.col("id") / 8) * 1024 + F.col("id") % 8).alias("tile_id"), F.lit(0.0).alias("center_lng"), F.lit(0.0).alias("center_lat"), F.when(F.col("id") == 0, 99).otherwise(1).cast("long").alias("count"))
    out = tiles.coarsen(many, "k", target=20, guard=50).collect()
    assert sum(r["count"] for r in out) == 162 and any(r["count"] == 99 and r.zoom_out == 0 for r in out) and len(out) == 17


def test_usable_points_and_medians(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (1, 1.0, 1.0), (1, None, 2.0), (1, 5.12345, 6.0)], "k int, lng double, lat double")
    assert rows(tiles.usable_points(points)) == [(1, 5.123, 6.0)]
    bins = spark.createDataFrame([(1, -100, 1), (1, 0, 1), (1, 100, 1), (2, 50, 4)], "k int, bin int, count long")
    assert rows(tiles.histogram_median(bins, "k")) == [(1, 0), (2, 50)]
    exact, derived = (spark.createDataFrame(d, "k int, m int") for d in ([(1, 5)], [(1, 9), (2, 7)]))
    assert rows(tiles.exact_over_derived(exact, derived, "k", "m")) == [(1, 5), (2, 7)]


def test_representatives_are_members_and_repeat():
    rng = np.random.default_rng(1)
    for n in (1, 3, 4, 50, 900, 7000):
        xy = np.round(rng.normal(size=(n, 2)) * 30, 3)
        w = rng.integers(1, 9, n).astype(float)
        got = cluster.representatives(xy, w)
        assert len(set(got.tolist())) == len(got) and (len(got) == n if n <= 3 else 1 <= len(got) <= 10)
        assert got.tolist() == cluster.representatives(xy, w).tolist()
    assert len(cluster.representatives(np.zeros((9, 2)), np.ones(9))) == 1
    assert [cluster.centres_wanted(n, 10**6) for n in (5, 100, 1000, 6000, 11000, 10**6)] == [3, 4, 5, 6, 7, 10]


def test_diff_rekeys_and_scope(spark):
    kinds = "id string, a int, b string, accepted boolean"
    prev = spark.createDataFrame([("1", 1, "x", True), ("2", 2, "y", True), ("3", 3, "z", True), ("4", 4, None, True), ("5", 5, "p", True), ("6", 5, "p", True), ("7", 7, "s", False)], kinds)
    cur = spark.createDataFrame([("1", 1, "x", True), ("2", 9, "Y", True), ("40", 4, None, True), ("50", 5, "p", True), ("60", 5, "p", True), ("7", 7, "s", True), ("3", 3, "z", False)], kinds)
    got = {(r.category, r.id): (r.old_id, r.fields) for r in diff.changes(cur, prev, "id", ["a", "b", "absent"], "accepted", rekeys=True).collect()}
    assert got == {
        ("changed", "2"): (None, ["a", "b"]), ("changed", "40"): ("4", ["id_raw"]), ("new", "50"): (None, []), ("new", "60"): (None, []), ("deleted", "5"): (None, []),
        ("deleted", "6"): (None, []), ("new", "7"): (None, []), ("deleted", "3"): (None, []),
    }
    found = diff.changes(cur, prev, "id", ["a", "b"], "accepted")
    assert tuple(diff.summary(found, cur, prev, "accepted").select("n_new", "n_changed", "n_deleted", "suspicious", "truncated").first()) == (4, 1, 4, True, False)
    assert diff.samples(found, 1).count() == 3 and diff.first_release(cur, "id", "accepted").count() == 6


def test_checks_areas_sampling(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert checks.content_hash(df) == checks.content_hash(df.orderBy(F.desc("k"))) != checks.content_hash(df.filter("k = 1"))
    gaz = spark.createDataFrame([("Côte d'Ivoire", "ivo"), ("Brazil", "bra"), ("Brazil", "abr"), ("Rio & Sul", "ris")], "name string, code string")
    data = [("Cote dIvoire",), ("Brazil (south)",), ("Rio and Sul; Peru",), ("Lima, Brazil",), ("PE",), ("nowhere",), (None,), (" ",)]
    got = dict(areas.match_areas(spark.createDataFrame(data, "area string"), gaz).collect())
    assert got == {"Cote dIvoire": "ivo", "Brazil (south)": "abr", "Rio and Sul; Peru": "ris", "Lima, Brazil": "abr", "PE": "pe"}
    stale = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "k int, checked int")
    assert [r.k for r in sampling.stale_first(stale, "checked", 2, "k").collect()] == [1, 3]
    assert dedupe.duplicates(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]).first().n == 2


def test_at_most_three_representatives(spark):
    """Ten far-apart heaps of weight 6,000: the three heaviest stand for the set, whatever the number of clusters."""
    rows = [("a", float(20 * i), float(10 * (i % 3)), 6000 + 100 * i) for i in range(10)] + [("a", 20.0 * i + 0.5, 10.0 * (i % 3), 10) for i in range(10)]
    rows += [("b", 0.0, 0.0, 900), ("b", 1.0, 0.0, 800), ("b", 0.0, 1.0, 700), ("b", 50.0, 50.0, 600)]
    points = spark.createDataFrame(rows, "k string, lng double, lat double, w long")
    got = {}
    for r in cluster.centroids(points, "k", weight="w").collect():
        got.setdefault(r.k, []).append((r.nth, r.lng, r.lat))
    assert [p[1:] for p in sorted(got["a"])] == [(180.0, 0.0), (160.0, 20.0), (140.0, 10.0)]
    assert 1 <= len(got["b"]) <= 3
    with pytest.raises(Exception, match="roll them up"):
        cluster.centroids(points, "k", weight="w", most_points=5).collect()


def test_raw_rollup_of_a_circle_is_refused(spark):
    points = spark.createDataFrame([("a", 1.0, 2.0)], "k string, lng double, lat double")
    edges = spark.createDataFrame([("a", "b", "SPECIES"), ("b", "c", "SPECIES"), ("c", "d", "GENUS")], "k string, parent string, parent_rank string")
    assert {(r.k, r["count"]) for r in tiles.raw_rollup(points, edges, "k", ["SPECIES"]).collect()} == {("a", 1), ("b", 1), ("c", 1)}
    circle = edges.unionAll(spark.createDataFrame([("c", "a", "SPECIES")], edges.schema))
    with pytest.raises(RuntimeError):
        tiles.raw_rollup(points, circle, "k", ["SPECIES"], levels=4)


def test_geo_of_accepted_rows(spark):
    packed = tiles.package(
        spark.createDataFrame([(1, 7, 10.5, -3.25, 30), (1, 8, 11.0, 4.0, 5), (1, 9, 12.0, 5.0, 40)], "k long, tile_id long, center_lng double, center_lat double, count long"), "k",
        centroids=spark.createDataFrame([(1, 1.00001, 2.0), (1, 1.0, 2.0)], "k long, lng double, lat double"),
        bins=spark.createDataFrame([(1, 200, 3), (1, 100, 4)], "k long, bin long, count long"), medians=spark.createDataFrame([(1, 100)], "k long, median long"),
    )
    rows = spark.createDataFrame([(1, True), (1, False), (2, True)], "k long, accepted boolean")
    got = {(r.k, r.accepted): r.geo and json.loads(r.geo) for r in tiles.with_geo(rows, packed, "k").collect()}
    assert got[1, False] is None and got[2, True] is None
    one = got[1, True]
    assert [h["occ"] for h in one["habitat"]] == [40, 30, 5] and one["centroids"] == [[1.0, 2.0]] and one["maxhab"] == 40 and one["observations"] == 75 and one["elevation"] == 100
    assert one["hypsogram"] == [{"elevation": 100, "occ": 4}, {"elevation": 200, "occ": 3}]


def test_polished_ids_and_parents(spark):
    source = spark.createDataFrame([(1, "rosa", "accepted", None), (2, "poa", "synonym", [9]), (3, "rosa", "synonym", None), (4, None, None, None)], "id_raw long, name_clean string, status_clean string, former array<long>")
    rows = spark.createDataFrame([("a", 9, "poa", True), ("b", 77, "rosa", True), ("c", 3, "x", True), ("d", None, "none", True), ("e", 77, "rosa", False), ("f", None, "poa", True)], "k string, id long, nm string, accepted boolean")
    got = {r.k: r.id for r in joins.polish_ids(rows, "id", "nm", source, status="status_clean", former="former").collect()}
    assert got == {"a": 2, "b": 1, "c": 1, "d": None, "e": 77, "f": 2}
    taxa = spark.createDataFrame([(1, "a", 2, True), (2, "g", None, False), (3, "g", None, True), (4, "b", 99, True), (5, "c", 2, False), (6, "d", 3, True)], "id long, name string, parent long, accepted boolean")
    assert {r.id: r.parent for r in tree.repair_parents(taxa).collect()} == {1: 3, 2: None, 3: None, 4: None, 5: 2, 6: 3}


def test_endless_hierarchies_are_said(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(9)], "id long, parent long")
    with pytest.raises(RuntimeError):
        tree.closure(chain, levels=4)
    assert tree.closure(chain, levels=9).count() == 45
