"""Small text tables with the cases every operator has to bear."""

from __future__ import annotations

import pytest

TEXT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for their own columns.
CLASHING = [
    "row", "ids", "n_tokens", "n_bytes", "first", "size", "digest", "hashed", "print", "second",
    "vertex", "root", "score", "label", "rate", "position", "part", "gone", "spans", "doc",
    "text_sha256", "of", "bucket", "n", "key", "host", "path", "rule", "verdict", "shape",
    "kept", "copies", "v", "id", "rank",
]
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(40_000))
PROSE = "the quiet river carries small boats past the old mill every single morning in spring"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    return [
        (1, None, "en", None, 0),
        (2, "", None, "b", None),
        (3, PROSE, "en", "a", 10),
        (3, PROSE, "en", "a", 10),
        (4, f"{PROSE}  \t\n", "en", "a", 10),
        (5, LONG, "en", "b", 10),
        (6, " \n ", "de", "c", 3),
        (7, PROSE.upper(), "en", "b", 10),
        (None, "ünï ▁ cødé 中文 😀 " + PROSE, "fr", "a", 5),
        (8, f"{PROSE} {PROSE}", None, None, None),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    from pyspark.sql import functions as F

    table = spark.createDataFrame(odd_rows, TEXT_SCHEMA)
    return table.select("*", *[F.lit("x").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], TEXT_SCHEMA)


@pytest.fixture(scope="session")
def labelled(spark):
    """Texts whose label is told by words and by structure."""
    rows, labels = [], []
    for i in range(600):
        words = [f"w{(i * 7 + j * 13) % 211}" for j in range(60)]
        bad, rude = i % 4 == 0, i % 5 == 0
        text = " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + "."
        if rude:
            text = text.replace(" ", " dolt ", 2).replace(" ", " knave ", 1)
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, None if i % 50 == 7 else int(not bad), int(rude)))
    docs = spark.createDataFrame(rows, TEXT_SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
