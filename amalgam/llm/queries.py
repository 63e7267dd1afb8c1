"""The registered queries of the training-data operators, one per operator, and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amalgam.llm import bpe, htmltext, langid, linededup, mixing, secretscan, sharding, simhash, topk, winnow
from amalgam.llm.common import cut, table


def tokenizer() -> tuple[str, str]:
    """Path of the rank file and the pattern that splits a text."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.compare_with_next(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op2_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("removed").cast("long").alias("removed_chunks"),
        F.aggregate("removed", F.lit(0), lambda n, c: n + c["n"]).cast("long").alias("removed_lines"),
        F.array_sort(F.array_distinct(F.transform("removed", lambda c: c["first_id"]))).alias("kept_in"),
        F.coalesce(F.length("clean"), F.lit(0)).cast("long").alias("clean_chars"),
        F.sha2(F.coalesce("clean", F.lit("")).cast("binary"), 256).alias("clean_sha256"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.rows_of(mixing.mix(table(spark, sf_dir, "documents")))
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.round_trip(table(spark, sf_dir, "documents"), *tokenizer())
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = langid.train(docs.filter(~langid.held_out()))
    found = langid.predict(docs, prototypes)
    return found.select(
        F.col("id").alias("doc_id"),
        F.coalesce(langid.held_out("id"), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    candidates = cut(secretscan.candidates(docs, path_col="source"))
    asked = candidates.select("candidate").unionAll(secretscan.all_findings(spark).select("candidate")).select(F.explode(secretscan.words_in(F.col("candidate"))).alias("word"))
    words = cut(secretscan.dictionary(docs, asked=asked))
    model = secretscan.train(secretscan.training(spark, words))
    found = secretscan.score(candidates, model, words)
    return found.filter("probability >= 0.5").select(
        F.col("id").alias("doc_id"),
        "nth",
        F.length("candidate").cast("long").alias("n_chars"),
        F.sha2(F.col("candidate").cast("binary"), 256).alias("secret_sha256"),
        "probability",
    )


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shards(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


QUERIES = {"op1_winnowing": op1_winnowing, "op2_linededup": op2_linededup, "op3_mixing": op3_mixing, "op4_bpe": op4_bpe, "op5_langid": op5_langid, "op6_simhash": op6_simhash, "op7_secrets": op7_secrets, "op8_html": op8_html, "op9_sharding": op9_sharding, "op10_topk": op10_topk}
ORACLES = {
    "op10_topk": """
    with v as (
        select vec_id id, list_transform(embedding, lambda x: floor(256 * x::double)) q from embeddings
        where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (select a.id query_id, b.id vec_id, list_dot_product(a.q, b.q)::bigint score from v a join v b on a.id <> b.id where a.id % 50 = 0)
    select query_id, rank::int rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s) where rank <= 5
    """,
}
