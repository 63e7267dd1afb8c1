import hashlib
import random

import pytest
import xxhash

from amalgam.llm import common, linededup, queries


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def turn(x, by):
    return ((x << by) | (x >> (64 - by))) & (2**64 - 1) if by else x


def cut(text, window=2, divisor=2, alone=16):
    """(first line, chunk text) of every chunk."""
    lines = text.split("\n")
    hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    words = [len(x.split()) for x in lines]
    out, at = [], 0
    for i in range(len(lines)):
        r = 0
        for j in range(window):
            r ^= turn(hs[i - j], j) if i >= j else 0
        end = i + 1 == len(lines)
        if end or words[i] >= alone or words[i + 1] >= alone or signed(r) % divisor == 0:
            out.append((at, "\n".join(lines[at : i + 1])))
            at = i + 1
    return out


def brute(rows, least=16):
    """{(id, text): clean text}; chunks compared as text, matches extended and joined line by line."""
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash_of(r))))
    first, out = {}, {}
    for d, t in docs:
        if t is None:
            out[d, t] = None
            continue
        pieces, lines = cut(t), t.split("\n")
        bounds = [at for at, _ in pieces] + [len(lines)]
        units = [(at, bounds[k + 1], k) for k, (at, _) in enumerate(pieces)]
        units += [(b - 2, b, k) for _, b, k in units if b >= 2 and len(lines[b - 1].split()) < 16 and bounds[k] != b - 2]
        covered = set()
        for i, (a, b, k) in enumerate(units):
            context = lines[bounds[max(k - 1, 0)] : a], lines[b : bounds[min(k + 2, len(bounds) - 1)]]
            unit = i >= len(pieces), "\n".join(lines[a:b])
            if unit not in first:
                first[unit] = context
                continue
            back = on = 0
            while back < min(len(context[0]), len(first[unit][0])) and context[0][-1 - back] == first[unit][0][-1 - back]:
                back += 1
            while on < min(len(context[1]), len(first[unit][1])) and context[1][on] == first[unit][1][on]:
                on += 1
            covered |= set(range(a - back, b + on))
        gone, i = set(), 0
        while i < len(lines):
            run = []
            while i in covered:
                run.append(i)
                i += 1
            if sum(len(lines[j].split()) for j in run) >= least:
                gone |= set(run)
            i += 1
        out[d, t] = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t
    return out


def xxhash_of(row):
    """xxhash64 of (id, text) as Spark has it: the text seeded by the hash of the id, 42 for a null."""
    seed = 42 if row[0] is None else xxhash.xxh64_intdigest(row[0].to_bytes(8, "little", signed=True), 42)
    return seed if row[1] is None else xxhash.xxh64_intdigest(row[1].encode(), seed)


def make(seed, n=120):
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice(["ab", "cd", "éf", "gh", "ij"]) for _ in range(rng.choice([0, 1, 4, 9, 15, 16, 40])))
    passages = [[line() for _ in range(rng.randint(1, 7))] for _ in range(6)] + [["w%d" % i for i in range(60)]]
    rows = []
    for i in range(n):
        parts = [line() for _ in range(rng.randint(0, 9))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = rng.choice(passages)
        rows.append((i, "\n".join(parts)))
    return rows + [(n, None), (n + 1, ""), (n + 2, rows[4][1]), (n + 3, rows[4][1]), (None, rows[9][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_documents(spark, seed):
    rows = make(seed)
    rows += [(9, rows[20][1]), (9, rows[21][1]), (None, rows[22][1])]  # texts that share an id, or have none
    doubled = rows + [rows[3], rows[4]]
    docs = spark.createDataFrame([(d, t, "x", "y", "z") for d, t in doubled], "doc_id long, text string, key string, own_key string, `removed` string")
    want = brute(rows)
    got = linededup.dedup_lines(docs.repartition(6)).collect()
    assert len(got) == len(doubled)
    assert any(r.removed for r in got)
    for r in got:
        assert r.clean == want[r.id, r.text], r
    cleaned = linededup.clean_documents(docs)
    assert cleaned.columns == docs.columns
    assert {(r.key, r.own_key, r.removed) for r in cleaned.collect()} == {("x", "y", "z")}
    assert sorted(str(r.text) for r in cleaned.collect()) == sorted(str(want[d, t]) for d, t in doubled)


def test_hot_chunk_in_parts(spark, monkeypatch):
    monkeypatch.setattr(linededup, "PART", 5)
    monkeypatch.setattr(common, "HOT_SHARE", 2)
    passage = " ".join(["word"] * 60)
    rows = [(i, f"start {i}\n{passage}\nend {i}") for i in range(40)]
    got = {r.id: r.clean for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: t if i == 0 else f"start {i}\nend {i}" for i, t in rows}


@pytest.mark.parametrize("lines, words, around", [(4, 15, 40), (5, 12, 40), (7, 8, 40), (5, 12, 6), (12, 5, 6)])
def test_passages_of_short_lines_go(spark, lines, words, around):
    rng = random.Random(lines * words)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, whole, removed = [], 0, 0
    for i in range(0, 60, 2):
        passage = [" ".join(word() for _ in range(words)) for _ in range(lines)]
        for k in (i, i + 1):
            edge = [[" ".join(word() for _ in range(around)) for _ in range(rng.randint(1, 4))] for _ in "ab"]
            rows.append((k, "\n".join(edge[0] + passage + edge[1])))
        whole += lines
    got = {r.id: r for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for r in got.values():
        removed += sum(c.n for c in r.removed)
        assert not r.removed or r.id % 2 == 1
        assert all(c.n <= lines for c in r.removed)
    assert removed >= 0.85 * whole, (removed, whole)


def test_shift_resistance():
    rng = random.Random(9)
    body = [" ".join(rng.choice("abcdef") for _ in range(6)) for _ in range(200)]
    a = {c for _, c in cut("\n".join(body))}
    b = {c for _, c in cut("\n".join(["new"] + body[:100] + ["inserted", "lines"] + body[100:]))}
    assert len(a & b) >= len(a) - 6


def test_empty_and_query(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert linededup.dedup_lines(docs).count() == 0
    rows = make(5, 30)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {d: hashlib.sha256((c or "").encode()).hexdigest() for (d, _), c in brute(rows).items()}
    assert {r.doc_id: r.clean_sha256 for r in queries.op2_linededup(spark, str(tmp_path)).collect()} == want
