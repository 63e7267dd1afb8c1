import gzip
import json
import zipfile
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from amalgam.functions import geo
from amalgam.operators import checks, diff
from amalgam.plans import profile, release
from amalgam.sources import archives, enrich, readers, releases, writers
from amalgam.streaming.upserts import RollingTable, windowed_counts


def test_delimited_variants(spark, tmp_path):
    p = tmp_path / "a.tsv"
    p.write_text('id\tname\tyear\n1\t"rosa\t1753\n2\tNULL\n3\ttulipa\t1800\textra\n')
    assert [tuple(r) for r in readers.delimited(spark, str(p), quote=None, null="NULL").collect()][:2] == [("1", '"rosa', "1753"), ("2", None, None)]
    strict = readers.delimited(spark, str(p), quote=None, schema="id int, name string, year int", malformed="drop")
    assert [r.id for r in strict.collect()] == [1]
    q = tmp_path / "b.csv"
    q.write_text("x|y\nz|\n")
    assert [tuple(r) for r in readers.headerless(spark, str(q), ["a", "b"], "|").collect()] == [("x", "y"), ("z", None)]
    assert readers.delimited(spark, str(p), rows=1).count() == 1


def test_bulk_copy(spark, tmp_path):
    p = tmp_path / "nodes.dmp"
    p.write_text("1\t|\troot\t|\t\t|\n2\t|\ta | b\t|\t7\t|\n")
    got = readers.bulk_copy(spark, str(p), "id int, name string, n int").collect()
    assert [tuple(r) for r in got] == [(1, "root", None), (2, "a | b", 7)]


def test_json(spark, tmp_path):
    p = tmp_path / "dump.json"
    p.write_text('[\n{"id":"Q1","n":1},\n{"id":"P2","n":2},\nnot json,\n{"id":"Q3","m":{}}\n]\n')
    assert sorted(r.id for r in readers.ndjson(spark, str(p), "id string, n int", "Q").collect()) == ["Q1", "Q3"]
    q = tmp_path / "list.json"
    q.write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    assert readers.json_array(spark, str(q)).count() == 2


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("in/Taxon.tsv", "id\tname\n1\trosa\n2\n")
        z.writestr("other.txt", "no")
    assert [tuple(r) for r in readers.zip_delimited(spark, str(tmp_path / "s.zip"), "Taxon.tsv", ["id", "name"]).collect()] == [("1", "rosa"), ("2", None)]
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "p"))
    part = next((tmp_path / "p").glob("*.parquet"))
    with zipfile.ZipFile(tmp_path / "q.zip", "w") as z:
        z.write(part, "one.parquet")
    assert readers.zip_parquet(spark, str(tmp_path / "q.zip"), "id long").count() == 5
    two = gzip.compress(b"alpha\nbeta\n") + gzip.compress(b"gamma\n")
    (tmp_path / "m.gz").write_bytes(two)
    assert len(readers.gzip_members(two)) == 2
    assert sorted(r.value for r in readers.filtered_lines(spark, str(tmp_path / "m.gz"), "^(alpha|gamma)").collect()) == ["alpha", "gamma"]


def test_language_files_and_values(spark, tmp_path):
    for lang in ("en", "xx"):
        (tmp_path / f"VernacularNames-{lang}.csv").write_text(f"id,vernacularName,language\n1,rose,{lang}\n")
    assert readers.language_files(spark, str(tmp_path / "Vern*.csv"), "id string, vernacularName string, language string", ["en"]).count() == 1
    readers.values(spark, [(1, "a")], "k int, v string", "inline_values")
    assert spark.sql("select * from inline_values").count() == 1
    with pytest.raises(RuntimeError):
        readers.spreadsheet(spark, "x.xlsx")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], "k int, l array<string>")
    path = str(tmp_path / "out")
    writers.write_parquet(df, path)
    writers.replace_parquet(spark.read.parquet(path).withColumn("k", F.col("k") + 1), path)
    assert spark.read.parquet(path).first().k == 2
    writers.write_tsv(df, str(tmp_path / "t"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).first().l == '["a","b"]'


def test_releases(tmp_path):
    s = releases.LocalStorage(tmp_path)
    for f in ("gbif.20240101.zip", "gbif.20240301.zip", "gbifx.20240201.zip"):
        s.write_bytes(f"raw/{f}", b"x")
    assert [d for d, _ in releases.dated(s.list_files("raw"), "gbif")] == [20240101, 20240301]
    assert releases.delete_older(s, "raw", "gbif", 20240301) == ["gbif.20240101.zip"] and s.exists("raw/gbifx.20240201.zip")
    a, b = releases.release_version([20240101, 20240105]), releases.release_version([20240201])
    for v in (a, b):
        s.write_json(f"rel/{v}/manifest.json", {"version": v})
    assert releases.latest_release(s, "rel") == b and releases.previous_release(s, b, "rel") == a and releases.previous_release(s, a, "rel") is None
    assert releases.Source("x", downloaded=2, processed=1).stale() and not releases.Source("x").stale()
    now = datetime(2024, 1, 2, tzinfo=UTC)
    assert releases.may_request({}, now) and not releases.may_request({"last_request": "2024-01-01T12:00:00+00:00"}, now)
    s.copy("raw/gbif.20240301.zip", "b/c.zip")
    s.delete("b")
    assert s.size("raw/gbif.20240301.zip") == 1 and not s.exists("b/c.zip")


def test_rolling_table_in_batch_and_stream(spark, tmp_path):
    t = RollingTable(spark, str(tmp_path / "roll"))
    kinds = "k int, ts int, v string"
    assert t.read() is None
    t.apply(spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], kinds), "k", "ts")
    spark.createDataFrame([(2, 5, "d"), (3, 1, "e")], kinds).write.parquet(str(tmp_path / "in"))
    q = t.follow(spark.readStream.schema(kinds).parquet(str(tmp_path / "in")), "k", "ts", str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, 2, "b"), (2, 5, "d"), (3, 1, "e")] and t.version() == 2


def test_windowed_counts(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert windowed_counts(events, "ts", "event_type", "value").agg(F.sum("n")).first()[0] == events.count()


def test_fuse_end_to_end(spark, tmp_path):
    kinds = "id_raw string, a_id string, name_clean string, kingdom string, rank_clean string, author_raw string, year int, status_clean string, parent_raw string"
    a = [("1", None, "rosa", "plantae", "genus", "l.", 1753, "accepted", None), ("2", None, "rosa canina", "plantae", "species", "l.", 1753, "accepted", "1"), ("3", None, "rosa alba", "plantae", "species", None, 1650, "synonym", "1")]
    b = [("x", "2", "rosa canina", "plantae", "species", "l.", 1753, "accepted", None), ("y", None, "tulipa", "plantae", "genus", None, 1800, None, None), ("z", None, "tulipa gesneriana", "plantae", "species", None, None, "accepted", "y")]
    frames = [spark.createDataFrame(d, kinds) for d in (a, b)]
    out = release.fuse([release.Authority("first", frames[0].drop("a_id"), "a_id"), release.Authority("second", frames[1], "b_id")])
    got = {r.name_consensus: r for r in out.collect()}
    assert set(got) == {"rosa", "rosa canina", "rosa alba", "tulipa", "tulipa gesneriana"}
    assert got["rosa canina"].a_id == "2" and got["rosa canina"].b_id == "x" and got["rosa canina"].accepted_by == ["first", "second"]
    assert got["rosa canina"].parent == got["rosa"].id_meso and got["rosa"].child_count == 2
    assert got["tulipa"].accepted and not got["rosa alba"].accepted and got["rosa alba"].year_consensus is None
    ranked = {r.name_consensus: r.genus for r in release.with_higher_ranks(out).collect()}
    assert ranked["rosa canina"] == "rosa" and ranked["tulipa gesneriana"] == "tulipa"
    storage = releases.LocalStorage(tmp_path)
    version = release.package(out, storage, [20240101, 20240202])
    assert spark.read.parquet(str(tmp_path / version / f"{version}.parquet")).count() == 5
    checked = checks.run_checks(spark, [checks.Check("rows", lambda s: out, "any", "no rows")])
    found = diff.release_changes(out, None, "id_meso", ["name_consensus"])
    later = release.package(out, storage, [20240101, 20250202], geo=out.select("id_meso"), changes=found, checks=checked, csv=True)
    manifest = release.lookup(storage)
    assert manifest["version"] == later and manifest["diff"]["kind"] == "first" and manifest["diff"]["counts"] == {"new": 5, "changed": 0, "deleted": 0}
    assert manifest["litmus"] == [{"name": "rows", "status": "passed", "message": None}] and spark.read.parquet(str(tmp_path / later / manifest["geo"])).count() == 5
    assert release.lookup(storage, "previous")["version"] == version and release.lookup(storage, version)["version"] == version and release.lookup(storage, "none") is None


def test_unchanged_snapshots(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, "y")], "id long, p string, q string")
    b = a.select("q", "id", "p").orderBy(F.desc("id"))
    assert diff.release_changes(a, b, "id", ["p", "q"])[0] == "unchanged" and diff.release_changes(a, b, "id", ["p", "q"])[1].count() == 0
    c = spark.createDataFrame([(1, None, "x"), (2, None, "y")], "id long, p string, q string")
    kind, found = diff.release_changes(a, c, "id", ["p", "q"])
    assert kind == "diff" and [(r.id, r.category, r.fields) for r in found.collect()] == [("1", "changed", ["p", "q"])]


def test_unpack_streams_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("in/../Taxon.tsv", "id\tname\n1\trosa\n")
        z.writestr("deep/er/big.tsv", "x\n" * 200_000)
        z.writestr("deep/", "")
        z.writestr("other.txt", "no")
    got = archives.unpack(spark, str(tmp_path / "s.zip"), str(tmp_path / "out"), ".tsv")
    assert [g.rsplit("/", 1)[1] for g in got] == ["deep__er__big.tsv", "in__..__Taxon.tsv"]
    assert spark.read.text(got).count() == 200_002
    archives.pack(spark, {"a": got[1]}, str(tmp_path / "p.zip"))
    with zipfile.ZipFile(tmp_path / "p.zip") as z:
        assert z.read("a") == b"id\tname\n1\trosa\n"
    archives.remove(spark, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_enrichment_tries_again_and_follows_redirects(spark):
    calls = []

    def fetch(keys):
        calls.append(len(keys))
        if len(calls) < 3:
            raise OSError("busy")
        return {"a": "b", "b": "a", "c": "d"}, {"d": "D", "e": "E"}

    assert enrich.answers(["a", "c", "e", "x"], fetch, wait=0.0) == [None, "D", "E", None] and calls == [4, 4, 4]
    assert enrich.answers(["e"], lambda keys: (_ for _ in ()).throw(OSError()), tries=2, wait=0.0) == [None]
    rows = spark.createDataFrame([("k%d" % i,) for i in range(50)] * 2 + [(None,)], "name string")
    found = enrich.enrich(rows, "name", lambda keys: ({}, {k: str(len(keys)) for k in keys}), per_call=7, tasks=2)
    got = {r.name: r.answer for r in found.collect()}
    assert len(got) == 50 and all(1 <= int(v) <= 7 for v in got.values())


def test_profile():
    assert profile.profile([], {}) == profile.Profile()
    got = profile.profile(["--force", "--no-geo", "--rows", "10", "--sources", "gbif", "col"], {"AMALGAM_ROWS": "5", "AMALGAM_CSV": "yes", "AMALGAM_DIFF": "0"})
    assert (got.force, got.geo, got.rows, got.sources, got.csv, got.diff, got.limit()) == (True, False, 10, ("gbif", "col"), True, False, 10)
    assert got.wants("col") and not got.wants("ncbi") and profile.Profile().wants("ncbi") and profile.profile([], {"AMALGAM_SOURCES": "a,b"}).sources == ("a", "b")


def test_state(tmp_path):
    state = releases.State(releases.LocalStorage(tmp_path))
    assert state.of("gbif") == releases.Source("gbif")
    state.update("gbif", downloaded=20240101, citation="c")
    state.update("col", downloaded=1)
    state.update("gbif", processed=20240101, citation=None)
    assert state.of("gbif") == releases.Source("gbif", downloaded=20240101, processed=20240101) and not state.of("gbif").stale()
    assert state.advance("gbif", 10) and not state.advance("gbif", 9) and state.of("gbif").extra["last_key"] == 10 and state.of("col").downloaded == 1


def test_points_as_binary(spark):
    import struct

    df = spark.createDataFrame([(1.5, -2.0), (None, 1.0)], "x double, y double")
    assert [r[0] for r in df.select(geo.point_wkb(df.x, df.y)).collect()] == [bytearray(struct.pack("<BIdd", 1, 1, 1.5, -2.0)), None]
