import random

import corpus_pipeline
from amalgam.llm import bpe, queries
from tests.llm.test_linededup import brute as clean_of
from tests.llm.test_simhash import kept_by_hand

V = bpe.vocabulary(*queries.tokenizer())


def make():
    rng = random.Random(6)
    syllables = {"en": "the and ing er on th ou re".split(), "de": "der sch ung en zu ein keit be".split()}
    rows = []
    for i in range(80):
        lang = rng.choice(["en", "de"])
        lines = [" ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 30))) for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(lines), lang, rng.choice(["a", "b", None]), 0))
    shared = " ".join(["the", "shared", "der", "on"] * 20)
    rows += [(100, rows[3][1], "en", "a", 0), (101, rows[3][1] + " x", "en", "b", 0), (102, "123 456", None, "a", 0), (103, None, "en", "a", 0)]
    rows += [(104 + k, f"the start of number {k}\n{shared}\nthe end", None, "c", 0) for k in range(3)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_take_effect(spark):
    docs = spark.createDataFrame(make(), SCHEMA)
    inputs = {r.doc_id: r.text for r in docs.collect()}
    known = corpus_pipeline.identify(spark, docs, "").cache()
    ids = {r.doc_id for r in known.collect()}
    assert known.columns == docs.columns and ids == set(inputs) - {102, 103}
    lines = corpus_pipeline.dedup_lines(spark, known, "").cache()
    want = clean_of([(d, inputs[d]) for d in ids])
    got = {r.doc_id: r for r in lines.collect()}
    assert {d: r.text for d, r in got.items()} == {d: t for (d, _), t in want.items()}
    assert all(r.n_chars == len(r.text) for r in got.values()) and lines.columns == docs.columns
    near = corpus_pipeline.dedup_near(spark, lines, "").cache()
    kept = {r.doc_id for r in near.collect()}
    assert kept == {d for d, _ in kept_by_hand([(d, r.text) for d, r in got.items()])}
    mixed = corpus_pipeline.mix(spark, near, "").cache()
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= kept
    times = {r.doc_id: 0 for r in near.collect()}
    for r in mixed.collect():
        times[r.doc_id] += 1
    assert max(times.values()) <= 3
    last = corpus_pipeline.tokenize(spark, mixed, "").collect()
    assert len(last) == sum(times.values())
    assert all(r.ids == V.encode(got[r.doc_id].text) for r in last)


def test_run_equals_its_stages(spark, tmp_path):
    spark.createDataFrame(make(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(str, docs.collect()))


def test_odd_rows_and_names_that_clash(spark):
    """Null and repeated ids, rows repeated whole, null and empty texts, and columns named like the stages' own."""
    rows = make()[:30] + [(5, "another text of an id that is taken, der sch ung en zu", "de", "a", 0), (None, "the and ing er on th", "en", None, 0), (None, None, None, None, None), (None, "", None, None, 0)]
    rows += [rows[3], rows[3]]
    names = "own_key row_key mixed_key mixed_turn removed __k __id cls hash key".split()
    docs = spark.createDataFrame([(*r, *names) for r in rows], SCHEMA + "".join(f", {n} string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns[5:] == names
    left = docs.collect()
    assert left and all(list(r)[5:] == names for r in left)
    assert {r.doc_id for r in left} <= {r[0] for r in rows}


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
