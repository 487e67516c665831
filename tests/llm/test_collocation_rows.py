"""Segments and their fingerprints move in small rows, whatever the size of a segment."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from navloom.llm import collocations
from navloom.llm.words import split_words

TEXTS, LENGTH = 260, 1_000


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    return [" ".join(chance.choices(vocabulary, k=LENGTH)) for _ in range(TEXTS)]


def test_a_large_segment_is_many_rows(spark, texts, monkeypatch):
    """Rows of a segment, and those of its fingerprints, are bounded; phrases are those of brute force."""
    tables = {}
    real = collocations.stored

    def stored(table, purpose, *rest, **named):
        return tables.setdefault(f"{purpose}-{len(tables)}", real(table, purpose, *rest, **named))

    monkeypatch.setattr(collocations, "stored", stored)
    frame = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").coalesce(1)
    counts, totals = collocations.frequent_phrases(frame, words=3, least=80)
    got = {(r.n, r.phrase): r["count"] for r in counts.collect()}
    want = Counter(
        (n, " ".join(w[i : i + n])) for w in map(str.split, texts) for n in (1, 2, 3) for i in range(len(w) - n + 1)
    )
    assert got == {phrase: count for phrase, count in want.items() if count >= 80}
    assert {n for n, _ in got} == {1, 2} and [tuple(r) for r in totals.collect()] == [("en", TEXTS * LENGTH)]
    segments, *prints = tables.values()
    assert segments.agg(F.max(F.octet_length("codes"))).first()[0] <= 4 * 100_000
    assert segments.select("segment").distinct().count() == 1
    # Fingerprints of a level are packed, not a row each.
    assert [table.count() for table in prints[:2]] == [1, 1]


@pytest.mark.parametrize("row_words", [7, 1_000, 10**9])
def test_a_segment_is_put_together_from_rows_in_any_order(monkeypatch, row_words):
    monkeypatch.setattr(collocations, "ROW_WORDS", row_words)
    words = split_words(pa.array(["a b c. d a b", None, "É b\tc a" * 50, ""]), collocations.KINDS)
    rows = list(collocations._rows(3, "en", words))
    assert len(rows) == -(-len(words.code) // row_words)
    segment = collocations.Segment(pa.Table.from_batches(rows[::-1]), 64)
    assert segment.vocabulary.equals(words.vocabulary.cast(pa.binary())) and segment.key == 3
    assert (segment.codes == words.code).all()
    assert (np.diff(segment.piece) == (np.diff(words.piece) != 0)).all()
    counts = np.concatenate([np.frombuffer(r.column("counts")[0].as_py(), np.int32) for r in rows])
    assert (counts == np.bincount(words.code)).all()


def test_workers_return_phrases_in_small_batches(texts, monkeypatch):
    monkeypatch.setattr(collocations, "BATCH_BYTES", 10_000)
    monkeypatch.setattr(collocations, "AT_ONCE", 500)
    words = split_words(pa.array(texts[:40]), collocations.KINDS)
    segment = collocations.Segment(pa.Table.from_batches(list(collocations._rows(1, "en", words))), 64)
    known = np.unique(segment.prints(2))
    batches = list(segment.phrases(2, known, 30))
    assert max(b.num_rows for b in batches) <= 30 and max(b.nbytes for b in batches) < 20_000
    shown = [p for b in batches for line in b.column("phrases").to_pylist() for p in line.split("\n")]
    assert len(shown) == len(set(shown)) == len(known) == 60 * 60
    sent = list(segment.parts(2, np.unique(segment.prints(1)), 30))
    assert max(b.nbytes for b in sent) < 20_000 and sum(b.num_rows for b in sent) == 30
    prints = np.concatenate([collocations._values(b.column("prints"), np.uint64)[0] for b in sent])
    assert (prints == known).all()


@pytest.mark.parametrize("bits", [5, 40, 64])
def test_buckets_are_ranges_that_cover_all_fingerprints(bits):
    prints = np.sort(np.random.default_rng(2).integers(0, 2**bits, 9_000, dtype=np.uint64))
    buckets = collocations.bucket_of(prints, 20, bits)
    assert (np.diff(buckets) >= 0).all() and set(buckets.tolist()) == set(range(20))
