"""From raw documents to the token ids of a training mix.

Each stage takes the documents that the one before kept, as stored Parquet. All but the
last return the columns of ``documents``, also those that no stage knows, whatever their
names. Every stage gives an empty table for an empty one and takes null and empty texts as
texts without words, repeated rows as rows of their own, and a null id as one after all
others; the stages say what they do with them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.llm import bpe, exact_dedup, mixing, quality, simhash
from navloom.llm.common import TEXTS_PER_BATCH, keyed, quoted, read, read_texts, settled, unused
from navloom.llm.labelled import fold
from navloom.llm.queries import CUT, byte_ranks


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the cut go; the labels of a fifth are not learnt from.

    Null and empty texts are scored by what the model knows of empty texts; equal texts get
    equal scores, so repeated rows stay or go together. A score at the cut stays.
    """
    learnt = fold(F.col("doc_id"), 5) != 0
    source = read_texts(spark, sf_dir)
    machine = quality.trained(source, read(spark, sf_dir, "labels"), "quality", learnt)
    return quality.accepted(docs, machine, CUT)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of smallest id stays.

    Runs of white space are equal, null is equal to empty. Of equal rows the first that was
    read stays; a document without id stays only if none of its equals has one.
    """
    rows, row = keyed(docs, "exact-rows")
    ordered = rows.select(
        F.struct(F.isnull("doc_id").alias("none"), "doc_id", F.col(row).alias("row")).alias("id"), "text"
    )
    of_row = unused("gone", rows.columns)

    def copies() -> DataFrame:
        groups = exact_dedup.exact_groups(ordered, "id")
        return groups.where("not kept").select(F.col("doc_id.row").alias(of_row))

    # Hashed, the few that go spare the texts a sort; so do the copies below.
    gone = settled(spark, copies, "exact-gone").hint("shuffle_hash")
    left = rows.join(gone, rows[row] == gone[of_row], "left_anti")
    return left.select(*quoted(docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints at most three bits apart the least id stays.

    The fingerprints are those of the shingles of three words. Documents without words share
    fingerprint zero, so one of them stays; equal rows are linked; ids come before no id.
    """
    return simhash.without_near_copies(docs, words=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the weights of their sources ask: not, once or twice.

    Documents without words weigh nothing and come once, or not if their source has no words
    at all; a null source is one of its own; repeated rows are counted one by one.
    """
    rows, row = keyed(docs, "mix-rows")
    of_row, copy = unused("of_row", rows.columns), unused("copy", rows.columns)

    def taken() -> DataFrame:
        each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
        mixed = mixing.mix(rows, id_col=row).where("copies > 0")
        return mixed.select(F.col("doc_id").alias(of_row), each.alias(copy))

    copies = settled(spark, taken, "mix-copies")
    joined = rows.join(copies.hint("shuffle_hash"), rows[row] == copies[of_row])
    return joined.select(*quoted(docs.columns))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of the text they decode to.

    Null and empty texts have no tokens and decode to nothing; every row gets a row.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
    ranks = byte_ranks()
    decoded = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", to_tokens),
]

#: The classifier cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    def kept_by(stages: int) -> DataFrame:
        """What the first stages keep; what each needed on the way is removed."""
        if not stages:
            return read_texts(spark, sf_dir)
        stage = STAGES[stages - 1][1]
        return settled(spark, lambda: stage(spark, kept_by(stages - 1), sf_dir), f"pipeline-{stages}")

    return STAGES[-1][1](spark, kept_by(len(STAGES) - 1), sf_dir)
