import zlib

import numpy as np
import pytest

from amalgam.llm import langid, queries


def brute(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    if not words:
        return None
    run = "\0" + "\0".join(words) + "\0"
    out = np.zeros(langid.DIMS)
    for a, b, c in zip(run, run[1:], run[2:], strict=False):
        x, y, z = (langid._letter(ord(k), 0).astype(int) for k in (a, b, c))
        out += np.roll(x, 2) * np.roll(y, 1) * z
    return out


@pytest.mark.parametrize("text", ["The cat", "a", "ÉTÉ 12 ß!", "x-y  z\n\nQ", "long words " * 900])
def test_bundle_matches_definition(text):
    assert np.array_equal(langid.bundle(langid.trigrams(text)), brute(text))


def test_forgetting_keeps_results(monkeypatch):
    monkeypatch.setattr(langid, "KNOWN", 50)
    grams = langid._Grams()
    for text in ("the quick brown fox jumps", "der schnelle braune fuchs", "the quick brown fox jumps"):
        keys = np.unique(langid.trigrams(text))
        again = np.empty((len(keys), langid.DIMS), np.int8)
        langid._Grams._bind(keys, again)
        assert np.array_equal(grams.vectors(keys), again)


ROWS = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the river that", "en"), ("das haus und der fluss nicht", "de")] * 30)]


def test_train_and_predict(spark):
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 !!", "de"), (None, "der fluss und das", None), (903, "THE RIVER AND", None)]
    docs = spark.createDataFrame(ROWS + odd, "doc_id long, text string, lang string").withColumn("score", docs_score())
    protos = langid.train(docs.repartition(5))
    for lang in ("en", "de"):
        want = sum(v for _, t, x in ROWS + odd if x == lang and t and (v := brute(t)) is not None)
        assert np.allclose(protos[lang], want / np.linalg.norm(want))
    got = {r.id: r for r in langid.predict(docs, protos).collect()}
    assert len(got) == len(ROWS) + len(odd)
    assert all(got[i].lang_pred == lang for i, _, lang in ROWS)
    assert [got[i].lang_pred for i in (900, 901, 902, None, 903)] == ["und", "und", "und", "de", "en"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[900].score == 0
    kept = langid.keep_identified(docs, protos)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) + 2


def docs_score():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.train(docs) == {}
    assert [tuple(r) for r in langid.predict(docs, {}).collect()] == [(1, "und", 0.0)]
    assert langid.predict(docs.limit(0), {}).count() == 0


def test_query_holds_out_and_is_accurate(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op5_langid(spark, sf).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
