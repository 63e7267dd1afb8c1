"""A training corpus from `documents`: language ID, line dedup, near-dedup, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of their input. Stages that find nothing to do return
their input's rows; an empty input passes through all of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgam.llm import bpe, langid, linededup, mixing, simhash
from amalgam.llm.queries import tokenizer
from amalgam.session import checkpoint_dir, table


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones of three folds in four teach."""
    prototypes = langid.train(docs.filter(~langid.held_out()))
    return langid.keep_identified(docs, prototypes)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that an earlier one has; n_chars follows the text."""
    clean = linededup.clean_documents(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else clean


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are linked by a similarity of 0.8 or more."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document."""
    found = bpe.round_trip(docs, *tokenizer())
    return found.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("bytes", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language_id", identify),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("mixing", mix),
    ("bpe", tokenize),
]

#: Rolling 64-bit hashes, fingerprints and merges have no DuckDB form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs, behind = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if behind:
            _remove(spark, behind)
        behind = path
    return STAGES[-1][1](spark, docs, sf_dir)


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
