"""Bounded samples of labelled texts, and the folds that tell them from the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import picked


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def known_texts(docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``bound`` labelled ids for which ``train`` holds.

    ``train`` may use ``doc_id`` only. The ids are those with the least hash, so the same
    in each run; of several labels of an id the greatest counts, null texts are empty. As
    the ids are bounded, they are broadcast to the scan of the texts. An id may repeat in
    ``docs``: cut the rows in the order of :data:`ORDER`, then the bound holds for them too.
    """
    known = picked(labels, doc_id="doc_id", label=label).where(
        F.col("label").isNotNull() & F.col("doc_id").isNotNull()
    )
    known = known.where(train).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = picked(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id")
    return texts.select(
        F.xxhash64("doc_id").alias("id_hash"), "doc_id", F.xxhash64("text").alias("text_hash"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("int").alias("label"),
    )


#: The order in which rows of :func:`known_texts` are taken.
ORDER = ("id_hash", "doc_id", "text_hash")


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int) -> DataFrame:
    """``text, label`` of at most ``bound`` rows of :func:`known_texts`.

    ``third`` cuts them into three parts by the id.
    """
    texts = known_texts(docs, labels, label, train, bound).orderBy(*ORDER).limit(bound)
    third = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(3)).cast("int")
    return texts.select("text", "label", third.alias("third"))
