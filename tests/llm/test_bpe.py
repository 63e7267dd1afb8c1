import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from amalgam.llm import bpe, common, queries

PATH, PATTERN = queries.tokenizer()
V = bpe.vocabulary(PATH, PATTERN)
ORACLE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=V.ranks, special_tokens={})
ALPHABETS = ["ab", "aé ", "abcdefgh", "\n \t", "the of", "éèçà", "日本語", "0123 ", "'strevmld", "=-_/", "\x00\U0001f600 "]


def texts(seed, n):
    rng = random.Random(seed)
    for k in range(n):
        letters = rng.choice(ALPHABETS)
        yield "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 30, 100, 700, 3000 if k % 20 == 0 else 50])))


def test_encode_is_the_librarys():
    for text in texts(3, 400):
        assert V.encode(text) == ORACLE.encode_ordinary(text)
        assert V.decode(V.encode(text)) == text.encode()


def test_long_matches():
    for text in ("a" * 20_001, "ab" * 5000, "thequick" * 3000, " " * 4097, "é" * 999):
        assert V.encode(text) == ORACLE.encode_ordinary(text)


def test_merges_agree():
    rng = random.Random(4)
    for _ in range(40):
        data = "".join(rng.choice("abcdet h") for _ in range(400)).encode()
        assert V._merge_long(data) == V.merge(data)


def test_bad_vocabulary(tmp_path):
    path = tmp_path / "v"
    path.write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        bpe.vocabulary(str(path), PATTERN)


def test_documents(spark):
    rows = [(i, t, i) for i, t in enumerate(texts(8, 60))] + [(100, None, 1), (None, "x", 2), (3, "dup", 3), (3, "dup", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    want = sorted((-1 if d is None else d, ORACLE.encode_ordinary(t or "")) for d, t, _ in rows)
    assert sorted((-1 if r.id is None else r.id, r.ids) for r in bpe.encode(docs, PATH, PATTERN).collect()) == want
    back = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, PATTERN)
    assert sorted(bytes(r.bytes) for r in back.collect()) == sorted((t or "").encode() for _, t, _ in rows)
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_query(spark, tmp_path):
    rows = [(1, "Hello there, world"), (2, None), (3, "é" * 100)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op4_bpe(spark, str(tmp_path)).collect():
        text = dict(rows)[r.doc_id] or ""
        ids = ORACLE.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert public_tokenizers.path("byte_bpe_multi_50k.tiktoken") == PATH


def test_memory_is_bounded_and_freed(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 20_000)
    own = bpe.Vocabulary(V.ranks, PATTERN)
    for text in texts(9, 100):
        assert own.encode(text) == ORACLE.encode_ordinary(text)
    for memo in (own.memo, own._leaves, own._windows):
        assert memo.held <= 20_000 and len(memo) < 100
    bpe.vocabulary(PATH, PATTERN)
    common.turn_to("another module")
    assert bpe.vocabulary.cache_info().currsize == 0
