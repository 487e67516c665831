"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.llm import bpe, clustering, collocations, decontamination, exact_dedup, mixing, quality, simhash, suffix_dedup, token_counts, topk, toxicity, url_filter
from navloom.llm.common import read, read_texts
from navloom.llm.labelled import fold

#: Tokens beyond which a text is too long for the context of a model.
TOKEN_LIMIT = 4096
#: Score from which a text counts as label 1.
CUT = 0.3


def _sha256_of_ids(ids) -> F.Column:
    return F.sha2(F.concat_ws(" ", ids.cast("array<string>")), 256)


def _predicted() -> F.Column:
    return (F.col("score") >= CUT).cast("int").alias("predicted")


def byte_ranks() -> bytes:
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return file.read()


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = byte_ranks()
    encoded = bpe.encode(read_texts(spark, folder), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha256_of_ids(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    order = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    counted = token_counts.count_tokens(read_texts(spark, folder), order)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(read_texts(spark, folder))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read_texts(spark, folder)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_texts(spark, folder)).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge(read(spark, folder, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = read_texts(spark, folder), fold(F.col("doc_id"), 5) == 0
    machine = quality.trained(docs, read(spark, folder, "labels"), "quality", ~held_out)
    return quality.score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", _predicted())


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(read_texts(spark, folder), words=3, radius=3)


def op9_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"), every=100, k=10, scale=1024)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, held_out = read_texts(spark, folder), fold(F.col("doc_id"), 4) == 2
    model = toxicity.trained(docs, read(spark, folder, "labels"), "toxic", ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", _predicted(), F.size("passages").alias("n_passages")
    )


def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = read_texts(spark, folder), read(spark, folder, "benchmark")
    return decontamination.contamination(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found, centroids = clustering.clusters(read(spark, folder, "embeddings"), k=8, rounds=10, seed=3, width=64)
    return clustering.with_inertia(found, centroids)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(collocations.BATCH_BYTES))
    return collocations.collocations(read_texts(spark, folder), words=5, least=100, top=2_000)


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_token_counts": op2_token_counts,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_mixing": op4_mixing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_quality": op7_quality,
    "op8_simhash": op8_simhash,
    "op9_top_k": op9_top_k,
    "op10_toxicity": op10_toxicity,
    "op11_decontamination": op11_decontamination,
    "op12_clusters": op12_clusters,
    "op13_collocations": op13_collocations,
}
