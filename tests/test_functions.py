import uuid

from pyspark.sql import functions as F

from amalgam.functions import arrays, geo, keys, ranks, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in KINDS.items() if k in values)) if values else spark.range(1)
    return row.select(column.alias("v")).first().v


KINDS = {"s": "string", "l": "array<string>", "n": "array<int>", "ll": "array<array<string>>"}


def test_list_mode_ties_and_nulls(spark):
    assert one(spark, arrays.list_mode(F.col("l")), l=["b", None, "a", "a", "b"]) == "b"
    assert one(spark, arrays.list_mode(F.col("l")), l=[None, None]) is None
    assert one(spark, arrays.list_mode(F.col("l")), l=[]) is None
    assert one(spark, arrays.by_frequency(F.col("l"), 2), l=["x", "y", "y", "z", None, "x", "z"]) == ["x", "y"]


def test_null_rules_of_lists(spark):
    assert one(spark, arrays.distinct(F.col("l")), l=["b", None, "a", "b"]) == ["a", "b"]
    assert one(spark, arrays.contains(F.col("l"), "a"), l=["b", None]) is False
    assert one(spark, arrays.contains(F.lit(None).cast("array<string>"), "a")) is False
    assert one(spark, arrays.flattened(F.col("ll")), ll=[["a"], None, ["b"]]) == ["a", "b"]
    assert one(spark, arrays.joined(F.lit(None).cast("array<string>"), F.col("l")), l=["a"]) == ["a"]
    assert one(spark, arrays.any_value(F.col("l")), l=[None, "q"]) == "q"


def test_uuid5_equals_pythons(spark):
    names = ["plantae:species:rosa.canina:l.:1753", "", "Ünï→code", "x" * 300]
    got = spark.createDataFrame([(n,) for n in names], "s string").select("s", keys.uuid5(F.col("s")).alias("u")).collect()
    assert all(r.u == str(uuid.uuid5(uuid.NAMESPACE_URL, r.s)) for r in got)


def test_names(spark):
    rows = [
        ("Rosa x alba L.", "L.", "species", "rosa alba", True, 5),
        ("rosa canina subsp. alba", None, "subspecies", "rosa canina alba", False, None),
        ("×Hedera pink", None, "genus", "edera pink", True, 0),
        ("rosa  ‘red’\tx", None, None, "rosa 'red' x", False, None),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "name_clean string, author_raw string, rank_raw string")
    got = {r.name_clean: (r.hybrid, r.hybridpos) for r in text.normalise_names(df).collect()}
    assert got["rosa alba"] == (True, 5)
    assert got["rosa canina alba"] == (False, None)
    assert (True, 0) in got.values()
    empty = spark.createDataFrame([("123", None, None), (None, None, None)], df.schema)
    assert [r.name_clean for r in text.normalise_names(empty).collect()] == [None]


def test_replace_first_author_year_fold(spark):
    assert one(spark, text.replace_first(F.col("s"), "a+", "-"), s="baab aab\naa") == "b-b aab\naa"
    assert one(spark, text.fold(F.col("s")), s=" São Tomé & Príncipe. ") == "sao tome and principe"
    author, year = text.author_and_year(F.lit("(L.) Mill., 1768"))
    assert (one(spark, author), one(spark, year)) == ("(L.) Mill.", 1768)
    assert one(spark, text.year_of(F.lit("Sp. Pl. 1753 (ed. 2)"))) == 1753 and one(spark, text.year_of(F.lit("no"))) is None


def test_ranks(spark):
    assert one(spark, ranks.rank_label(F.lit("NothoSUBSP."))) == "subspecies"
    assert one(spark, ranks.status_label(F.lit("Heterotypic_Synonym"))) == "synonym"
    assert one(spark, ranks.rank_label(F.lit("nonsense"))) is None and one(spark, ranks.rank_label(F.lit(None).cast("string"))) is None
    assert one(spark, ranks.rank_ordinal(F.lit("species"))) == 18 and len(ranks.RANKS) == 29


def test_geo_edges(spark):
    points = [(-180.0, 89.9), (180.0, -89.9), (0.0, 0.0), (13.4, 52.5)]
    got = [r.v for r in spark.createDataFrame(points, "x double, y double").select(geo.tile_id(F.col("x"), F.col("y")).alias("v")).collect()]
    assert got[0] == 0 and got[1] == 1023 * 1024 + 1023 and got[2] == 512 * 1024 + 512
    assert one(spark, F.round(geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(180.0), F.lit(0.0)), 1)) == 20015.1
    assert one(spark, geo.parent_tile(F.lit(5 * 1024 + 7))) == 2 * 1024 + 3
