"""Mixing sources to target weights by entropy balancing.

A mix takes document i of source s at a rate w_i >= 0 (a rate of 2.3: two
copies and a third with a chance of 0.3). Of all rates that give every source
its target of words, none above ``most`` copies, the ones closest to taking
each document once (in relative entropy) are exponentially tilted in the
document's size: w_i = min(most, exp(lambda_s * x_i)), x_i the size over the
source's mean size; a source whose target is ``most`` times its size takes every
document so often and needs no tilt. Lambda is found by Newton steps on the dual's gradient,
one aggregation over the (source, size) histogram each, kept inside a bracket
that every step narrows. Rates are rounded to whole copies by error diffusion
from long to short documents within blocks of bounded size, so that a block
misses its words by about half of its shortest document at most.

Sizes are words, runs of code points other than ASCII white space. Nothing is
drawn at random: reruns agree.

Defined results: null texts have size 0 and are never taken; a null source is a
source of its own, after all others; rows repeated whole are taken equally
often, and so are different texts of one id, size and source; sources without
words have target 0; an empty table gives no rows; other columns are ignored
(:func:`mix_documents` keeps them, whatever their names).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amalgam.llm.common import cut, free_name, small

#: No document is taken more often.
MOST = 3
#: Documents of a block of the rounding, on average.
BLOCK = 2_000
#: Sources up to which their tilts are broadcast; with more they are joined by a shuffle.
FEW = 20_000
WORDS = r"[^\x20\x09-\x0D]+"


def size_of(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")


def _source_key(source_col: str) -> Column:
    """A key that is never null and sorts as the source does, null last."""
    return F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), F.col(source_col).cast("string")))


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """``df`` with rows numbered from 0 by ``order``; rows of one range meet in a task, not all rows."""
    ranges = cut(df.repartitionByRange(order).withColumn("__task", F.spark_partition_id()))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    start = ranges.groupBy("__task").agg(F.count(F.lit(1)).alias("n")).select("__task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy("__task").orderBy(order)) - 1
    return ranges.join(start, "__task").withColumn(name, (within + F.col("__start")).cast("long")).drop("__task", "__start")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """(key, source_size, target) from (key, size) rows.

    Sources by key weigh ``weights`` in turn and share all words by weight; no
    target passes ``most`` times its source's size, the excess is shared again.
    """
    by_source = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    weight = F.array(*map(F.lit, weights))
    ranked = cut(numbered(by_source, "key", "rank").withColumn("weight", F.get(weight, F.col("rank") % len(weights)).cast("double")))
    cap = F.col("source_size") * float(most)
    total, w_all = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    share, n_capped = (float(total) / w_all if w_all else 0.0), 0
    while total:
        over = cap <= F.col("weight") * F.lit(share)
        n, capped, open_w = ranked.agg(F.count_if(over), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if n == n_capped or not open_w:
            break
        n_capped, share = n, (float(total) - (capped or 0.0)) / open_w
    return ranked.select("key", "source_size", F.least(cap, F.col("weight") * F.lit(share)).alias("target"))


def tilts(sizes: DataFrame, targets: DataFrame, most: int = MOST, rounds: int = 60, close: float = 1e-9) -> DataFrame:
    """(key, mean, lam): the tilt of each source that has words, from (key, size, rows) counts.

    RuntimeError if a source misses its target by more than ``close`` after ``rounds`` steps.
    """
    full = targets.filter("source_size > 0")
    counts = cut(sizes.filter("size > 0").groupBy("key", "size").agg(F.sum("rows").alias("rows")))
    scale = counts.groupBy("key").agg((F.sum(F.col("size") * F.col("rows")) / F.sum("rows")).alias("mean"), F.min("size").alias("least"))
    least_x = F.col("least") / F.col("mean")
    state = cut(
        full.join(scale, "key").select(
            "key", "mean", "target",
            F.lit(0.0).alias("lam"),
            F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) / least_x).alias("low"),
            (F.log(F.lit(float(most))) / least_x).alias("high"),
        )
    )
    few = F.broadcast if state.count() <= FEW else lambda df: df
    for _ in range(rounds):
        x = F.col("size") / F.col("mean")
        z = F.col("lam") * x
        top = F.log(F.lit(float(most)))
        words = F.col("rows") * F.col("size") * F.exp(F.least(z, top))
        slope = F.when(z < top, words * x).otherwise(0.0)
        sums = counts.join(few(state), "key").groupBy("key").agg(F.sum(words).alias("f"), F.sum(slope).alias("df"))
        step = F.col("lam") + F.log(F.col("target") / F.col("f")) * F.col("f") / F.col("df")
        under = F.col("f") < F.col("target")
        moved = state.join(sums, "key").withColumns({
            "gap": F.abs(F.col("f") / F.col("target") - 1),
            "low": F.when(under, F.col("lam")).otherwise(F.col("low")),
            "high": F.when(under, F.col("high")).otherwise(F.col("lam")),
            "step": F.when(F.col("df") > 0, step),
        })
        middle = (F.col("low") + F.col("high")) / 2
        inside = F.col("step").isNotNull() & (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        state = cut(moved.select("key", "mean", "target", F.when(F.col("gap") <= close, F.col("lam")).when(inside, F.col("step")).otherwise(middle).alias("lam"), "low", "high", "gap"))
        if (state.agg(F.max("gap")).first()[0] or 0.0) <= close:
            break
        state = state.drop("gap")
    else:
        raise RuntimeError(f"tilts did not settle in {rounds} rounds")
    return state.select("key", "mean", "lam")


def _round(sizes: list[int], rows: list[int], rates: list[float], most: int) -> list[int]:
    """Copies next to the rates, longest documents first, that carry the missed words on."""
    missed, out = 0.0, []
    for size, n, rate in zip(sizes, rows, rates, strict=True):
        want, whole = rate * size * n, size * n
        copies = min(most, max(0, round((missed + want) / whole))) if whole else 0
        missed += want - whole * copies
        out.append(copies)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """(key, id, size, rows, source_size, target, copies): how often each distinct (id, size, source) is taken.

    ``rows`` says how many equal rows there are; ``copies`` holds for each of them.
    """
    base = docs.select(_source_key(source_col).alias("key"), F.col(id_col).cast("long").alias("id"), size_of(text_col).alias("size"))
    items = cut(base.groupBy("key", "id", "size").agg(F.count(F.lit(1)).alias("rows")))
    targets = cut(source_targets(items.select("key", (F.col("size") * F.col("rows")).alias("size")), weights, most))
    tilt = tilts(items, targets.filter(F.col("target") < F.col("source_size") * float(most)), most)
    parts = items.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    plan = cut(targets.join(tilt, "key", "left").join(parts, "key"))
    top = float(np.log(most))
    rate = F.when(F.col("size") > 0, F.coalesce(F.exp(F.least(F.lit(top), F.col("lam") * F.col("size") / F.col("mean"))), F.lit(float(most)))).otherwise(0.0)
    block = F.pmod(F.xxhash64("id", "size"), F.col("parts"))
    rated = items.join(small(plan, FEW), "key").select("key", "id", "size", "rows", "source_size", "target", rate.alias("rate"), block.alias("block"))

    def block_copies(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("id", "ascending")])
        copies = _round(*(group.column(c).to_pylist() for c in ("size", "rows", "rate")), most)
        return group.drop_columns(["rate", "block"]).append_column("copies", pa.array(copies, pa.int64()))

    return rated.groupBy("key", "block").applyInArrow(
        block_copies, "key string, id long, size long, rows long, source_size long, target double, copies long"
    )


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept."""
    key, id_, size, copies, turn = free_name(docs, "mixed_key", "mixed_id", "mixed_size", "mixed_copies", "mixed_turn")
    taken = mix(docs, id_col, text_col, source_col, **how).filter("copies > 0").select(
        F.col("key").alias(key), F.col("id").alias(id_), F.col("size").alias(size), F.col("copies").cast("int").alias(copies)
    )
    same = F.col(id_).eqNullSafe(F.col(f"`{id_col}`").cast("long")) & (F.col(key) == _source_key(source_col)) & (F.col(size) == size_of(text_col))
    often = docs.join(taken, same).withColumn(turn, F.explode(F.array_repeat(F.lit(0), F.col(copies))))
    return often.select(*[F.col(f"`{c}`") for c in docs.columns])


def rows_of(mixed: DataFrame) -> DataFrame:
    """One row for each document: equal rows again apart."""
    return mixed.withColumn("__r", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))).drop("__r")
