"""Line deduplication by content-defined chunks of lines, with DataFrame functions only.

A text's lines are hashed, and a rolling (cyclic polynomial) hash over the last
``WINDOW`` line hashes cuts the text after about every ``DIVISOR``-th line; a
line of ``ALONE`` words or more is cut off on either side, so that a passage of
one line is a chunk whatever surrounds it. Where a cut falls thus depends on
the lines just beside it alone, so inserted or removed lines shift the cuts
around them and no others. A chunk that occurs more than once in all documents
is kept where its first occurrence is (least id, then position); every other
occurrence is compared byte by byte with it. So are, as chunks of their own,
the ``WINDOW`` lines before each cut that the rolling hash made: a repeated
passage has them in common even where the lines around it made its first and
last cuts differ. A match is extended over the equal lines next to it, back to
the start of the chunk before and on to the end of the chunk after. Matches
that touch or overlap in a document are one repeated passage, which goes if it
has ``LEAST`` words or more; shorter ones are too common to mean a copy and
stay.

Only hashes are shuffled for all chunks; those of hot hashes meet their first
occurrence by a broadcast of these alone. Texts travel once, to meet the
list of their chunks in question, and then the repeated chunks alone travel to
be compared, in parts of at most ``PART`` occurrences of a chunk.

Defined results: a null text has no lines and stays null, an empty one has one
empty line; rows repeated whole are one document (none loses text to its
double); ids may be null, and different texts of one id are different
documents; an empty table gives no rows; other columns are ignored
(:func:`clean_documents` keeps them, whatever their names).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amalgam.llm.common import cut, join_counted

WINDOW = 2
DIVISOR = 2
ALONE = 16
LEAST = 16
PART = 512
WORD = r"\S+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def _turn(value: Column, by: int) -> Column:
    return F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by)) if by else value


def chunks(text: Column, window: int = WINDOW, divisor: int = DIVISOR, alone: int = ALONE) -> Column:
    """array<struct<at, n, hash, before, after, line_before, line_after>> of every chunk and cut.

    First line (from 0), lines, hash, how many lines to look at around it, and the hashes of the two next to it.
    """

    def measured(line: Column) -> Column:
        return F.struct(F.xxhash64(line).alias("hash"), F.regexp_count(line, F.lit(WORD)).alias("words"))

    def rolled(lines: Column, i: Column) -> Column:
        parts = [F.coalesce(_turn(F.get(lines, i - j)["hash"], j), F.lit(0)) for j in range(window)]
        out = parts[0]
        for part in parts[1:]:
            out = out.bitwiseXOR(part)
        return out

    def cut_after(lines: Column, i: Column) -> Column:
        long_line = F.coalesce(F.get(lines, i)["words"] >= alone, F.lit(True)) | F.coalesce(F.get(lines, i + 1)["words"] >= alone, F.lit(True))
        return long_line | (F.pmod(rolled(lines, i), F.lit(divisor)) == 0)

    def cut_up(lines: Column) -> Column:
        n = F.size(lines)
        ends = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | cut_after(lines, i))
        return _let(ends, lambda e: F.concat(
            F.transform(e, lambda end, k: chunk(lines, e, k, F.coalesce(F.get(e, k - 1) + 1, F.lit(0)), end, 0)),
            F.filter(
                F.transform(e, lambda end, k: F.when(
                    (F.get(lines, end)["words"] < alone) & (F.coalesce(F.get(e, k - 1), F.lit(-1)) != end - window) & (end + 1 >= window),
                    chunk(lines, e, k, end + 1 - window, end, 1),
                )),
                lambda c: c.isNotNull(),
            ),
        ))

    def chunk(lines: Column, e: Column, k: Column, at: Column, end: Column, kind: int) -> Column:
        return F.struct(
            at.alias("at"), (end + 1 - at).alias("n"),
            F.xxhash64(F.transform(F.slice(lines, at + 1, end + 1 - at), lambda line: line["hash"]), F.lit(kind)).alias("hash"),
            F.greatest(at - F.coalesce(F.get(e, k - 2) + 1, F.lit(0)), F.lit(0)).alias("before"),
            (F.coalesce(F.get(e, k + 1), end) - end).alias("after"),
            F.get(lines, at - 1)["hash"].alias("line_before"), F.get(lines, end + 1)["hash"].alias("line_after"),
        )

    return F.when(text.isNotNull(), _let(F.transform(lines_of(text), measured), cut_up))


def _equal_run(a: Column, b: Column, at_end: bool) -> Column:
    """How many lines two arrays have in common at their end or start."""
    n = F.least(F.size(a), F.size(b))
    place = (lambda x, i: F.get(x, F.size(x) - 1 - i)) if at_end else F.get
    differ = F.array_position(F.transform(F.sequence(F.lit(0), n - 1), lambda i: place(a, i) != place(b, i)), True)
    return F.when(n == 0, 0).when(differ == 0, n).otherwise(differ - 1).cast("int")


def _same_row(a: str, b: str) -> Column:
    """Equal keys and ids; rows are dealt out by the key alone, which holds the id."""
    left, right = F.col(f"{a}.id"), F.col(f"{b}.id")
    return (F.col(f"{a}.key") == F.col(f"{b}.key")) & F.coalesce(left == right, left.isNull() & right.isNull())


def repeated_passages(docs: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """(docs by key, found): the documents, and rows (id, key, repeated) of their repeated passages of any length.

    ``docs`` has the columns id and text; ``key`` tells apart texts of equal
    ids; ``repeated`` is a sorted array of (at, n, first_id).
    """
    keyed = docs.select("id", F.xxhash64("id", "text").alias("key"), "text")
    found = cut(keyed.select("id", "key", F.inline(chunks(F.col("text"), **how))))
    place = F.struct("id", "key", "at")
    beside = ["line_before", "line_after"]
    firsts = found.groupBy("hash").agg(F.min(F.struct("id", "key", "at", *beside)).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("times"))
    firsts = firsts.filter(F.struct("first.id", "first.key", "first.at") != F.col("last"))
    firsts = cut(firsts.select("hash", "first", "times", F.ceil(F.col("times") / PART).cast("int").alias("parts")))
    met = join_counted(found, firsts, "hash", "times", found.count())
    later = place != F.struct("first.id", "first.key", "first.at")
    # lines around a later occurrence travel only if those next to it have equal hashes in both places
    around = [F.when(~later | (F.col(line) == F.col("first")[line]), F.col(n)).otherwise(0).alias(n) for n, line in zip(["before", "after"], beside, strict=True)]
    here = met.select("id", "key", F.struct("at", "n", "hash", *around, later.alias("later"), "parts").alias("c"))
    asked = here.groupBy("id", "key").agg(F.collect_set("c").alias("asked"))
    read = keyed.alias("a").join(asked.alias("b"), _same_row("a", "b")).select("a.id", "a.key", lines_of(F.col("a.text")).alias("lines"), F.explode("asked").alias("c"))
    at, n = F.col("c.at"), F.col("c.n")
    texts = read.select(
        "id", "key", "c.at", "c.n", "c.hash", "c.later", "c.parts",
        F.struct(
            F.slice("lines", at + 1, n).alias("chunk"),
            F.slice("lines", at + 1 - F.col("c.before"), F.col("c.before")).alias("before"),
            F.slice("lines", at + 1 + n, F.col("c.after")).alias("after"),
        ).alias("x"),
    )
    later = texts.filter("later").withColumn("part", F.pmod(F.xxhash64("id", "key", "at"), F.col("parts")).cast("int"))
    first = (
        texts.filter("not later").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("hash", "part", F.col("id").alias("first_id"), F.col("x").alias("y"))
        .dropDuplicates(["hash", "part"])
    )
    equal = later.join(first, ["hash", "part"]).filter(F.when(F.col("x.chunk") == F.col("y.chunk"), True))  # no join key
    back, on = _equal_run(F.col("x.before"), F.col("y.before"), True), _equal_run(F.col("x.after"), F.col("y.after"), False)
    spread = equal.select("id", "key", "first_id", (F.col("at") - back).alias("at"), (F.col("at") + F.col("n") + on).alias("end")).distinct()
    in_text = Window.partitionBy("id", "key").orderBy("at", "end")  # the repeated chunks of one document
    starts = F.coalesce(F.col("at") > F.max("end").over(in_text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    passages = (
        spread.withColumn("starts", starts.cast("int")).withColumn("passage", F.sum("starts").over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("id", "key", "passage").agg(F.min("at").alias("at"), F.max("end").alias("end"), F.min("first_id").alias("first_id"))
    )
    return keyed, passages.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("at", (F.col("end") - F.col("at")).alias("n"), "first_id"))).alias("repeated"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, **how) -> DataFrame:
    """(id, text, clean, removed): each document, its text without repeated passages, and what was removed.

    ``removed`` is an array of (at, n, first_id): first line, lines, and the
    least id of the documents that keep its chunks; ``clean`` is empty if all
    was removed.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    keyed, found = repeated_passages(rows, **how)
    both = keyed.alias("a").join(found.alias("b"), _same_row("a", "b"), "left").select("a.id", "a.text", F.coalesce("b.repeated", F.array().cast("array<struct<at:int,n:int,first_id:bigint>>")).alias("repeated"))
    return both.select("id", "text", _without(F.col("text"), F.col("repeated"), least).alias("done")).select("id", "text", "done.clean", "done.removed")


def _without(text: Column, repeated: Column, least: int) -> Column:
    """struct(clean, removed): the lines of ``text`` outside the repeated passages of ``least`` words or more, and these."""

    def kept(lines: Column, removed: Column) -> Column:
        last = F.size(removed)
        gaps = F.transform(
            F.sequence(F.lit(0), last),
            lambda k: _let(
                F.coalesce(F.get(removed, k - 1)["at"] + F.get(removed, k - 1)["n"], F.lit(0)),
                lambda a: F.slice(lines, a + 1, F.coalesce(F.get(removed, k)["at"], F.size(lines)) - a),
            ),
        )
        return F.array_join(F.flatten(gaps), "\n")

    def long(lines: Column) -> Column:
        words = lambda c: F.aggregate(F.slice(lines, c["at"] + 1, c["n"]), F.lit(0), lambda n, line: n + F.regexp_count(line, F.lit(WORD)))
        return _let(F.filter(repeated, lambda c: words(c) >= least), lambda gone: F.struct(F.when(F.size(gone) == 0, text).otherwise(kept(lines, gone)).alias("clean"), gone.alias("removed")))

    return F.when(F.size(repeated) == 0, F.struct(text.alias("clean"), repeated.alias("removed"))).otherwise(_let(lines_of(text), long))


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, **how) -> DataFrame:
    """``docs`` with the text of every row cleaned; all columns and rows stay."""
    id_, text = F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")
    keyed, found = repeated_passages(docs.select(id_, text), **how)
    both = keyed.alias("a").join(found.alias("b"), _same_row("a", "b"), "left")
    clean = F.when(F.col("b.repeated").isNull(), F.col("a.text")).otherwise(_without(F.col("a.text"), F.col("b.repeated"), least)["clean"])
    cleaned = both.select("a.id", "a.key", clean.alias("clean")).dropDuplicates(["key", "id"])
    # the other columns meet the clean texts; the texts themselves don't travel again
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]
    rest = docs.select(id_, F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).alias("key"), *others)
    joined = rest.alias("a").join(cleaned.alias("b"), _same_row("a", "b"))
    return joined.select(*[F.col("b.clean" if c == text_col else f"a.c{i}").alias(c) for i, c in enumerate(docs.columns)])
