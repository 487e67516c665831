"""Benchmark passages against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from navloom.llm import decontamination
from navloom.llm.words import kinds, split_words

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    found = []
    for i, text in docs:
        w, hit, names = words(text), set(), set()
        for name, passage in items:
            p = words(passage)
            m = min(window, len(p))
            grams = {tuple(p[j : j + m]) for j in range(len(p) - m + 1)} if m else set()
            for j in range(len(w) - m + 1):
                if tuple(w[j : j + m]) in grams:
                    hit |= set(range(j, j + m))
                    names.add("" if name is None else str(name))
        found.append((str(i), len(w), len(hit), sorted(names)))
    return sorted(found)


def rows_of(frame):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in frame.collect())


@pytest.fixture(scope="module")
def tables(spark):
    chance = random.Random(5)
    some = lambda n: [chance.choice(["the", "of", "a", "río", "x1"] + [f"w{i}" for i in range(60)]) for _ in range(n)]
    items = [(i, " ".join(some(chance.choice([1, 2, 5, 9, 10, 11, 30, 80])))) for i in range(30)]
    items += [(30, None), (31, ""), (32, "..."), (None, "only here nowhere ELSE"), (5, items[5][1]), (33, "the of " * 8)]
    items.append((34, "absent-word " + " ".join(some(20))))
    docs = []
    for i in range(150):
        parts = some(chance.randint(0, 120))
        for _ in range(chance.randint(0, 2)):
            passage = words(chance.choice(items)[1])
            a = chance.randint(0, max(0, len(passage) - 10))
            at = chance.randint(0, len(parts))
            parts[at:at] = passage[a : a + chance.randint(8, 60)]
        docs.append((i, chance.choice([" ", ", ", "\n"]).join(parts).title()))
    docs += [(150, None), (151, ""), (None, items[3][1]), (7, docs[7][1]), (152, "only here nowhere else " * 3)]
    docs += [(153, "the of " * 300), (154, " ".join(some(30_000)))]
    to_docs = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    to_items = spark.createDataFrame(items, "item_id bigint, text string")
    clash = [F.lit(1).alias(c) for c in ("segment", "item", "term", "row", "n", "places", "pos", "name")]
    return docs, items, to_docs.select("*", *clash), to_items.select("*", *clash)


@pytest.mark.parametrize("segment_bytes", [decontamination.SEGMENT_BYTES, 2_000])
def test_phrases(tables, segment_bytes):
    docs, items, to_docs, to_items = tables
    assert rows_of(decontamination.contamination(to_docs, to_items, segment_bytes=segment_bytes)) == brute(docs, items)


def test_phrases_of_other_windows_and_of_nothing(tables):
    docs, items, to_docs, to_items = tables
    assert rows_of(decontamination.contamination(to_docs, to_items, window=3)) == brute(docs, items, 3)
    assert decontamination.contamination(to_docs.limit(0), to_items).count() == 0
    none = decontamination.contamination(to_docs, to_items.limit(0))
    assert rows_of(none) == brute(docs, [])


def test_phrases_of_odd_tables(odd, odd_rows, empty, spark):
    items = spark.createDataFrame([("a", "small boats past the old mill every single morning in"), ("b", "中文 😀")], "item_id string, text string")
    found = rows_of(decontamination.contamination(odd, items))
    assert found == brute([(r[0], r[1]) for r in odd_rows], [tuple(r) for r in items.collect()])
    assert decontamination.contamination(empty, items).count() == 0


def test_places_of_passages(spark):
    docs = spark.createDataFrame([(1, "x y a b c z a b c")], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, "q a b c")], "item_id bigint, text string")
    index = decontamination.build_index(docs)
    row, = decontamination.phrase_matches(index, items, window=3).collect()
    assert (row.name, row.places) == ("9", [2, 3, 4, 6, 7, 8])


def test_rarest_words_of_windows():
    counts = np.array([5, 9, 1, 9, 0, 9, 2, 3])
    assert decontamination.rarest_pairs(counts, 3) == [(2, 0, 0, 3), (2, 1, 1, 4), (6, 7, 5, 8)]
    assert decontamination.rarest_pairs(np.array([4]), 1) == [(0, 0, 0, 1)]


def test_words_that_stand_close_together(tables):
    """The rarest words of an item in any order, against every stretch of the texts."""
    docs, items, to_docs, to_items = tables
    index = decontamination.build_index(to_docs)
    found = decontamination.near_matches(index, to_items, terms=3, span=8)
    ids = index.texts.select("segment", "doc", "doc_id")
    got = {(str(r.doc_id), r.name, r.first, r.last) for r in found.join(ids, ["segment", "doc"]).collect()}
    counts, wanted = {}, set()
    for _, text in docs:
        for w in words(text):
            counts[w] = counts.get(w, 0) + 1
    for name, passage in items:
        p = words(passage)
        asked = sorted({(counts.get(w, 0), p.index(w), w) for w in p})[:3]
        rare = {w for _, _, w in asked}
        for i, text in docs if rare else []:
            last = {}
            for at, w in enumerate(words(text)):
                if w in rare:
                    last[w] = at
                    if len(last) == len(rare) and at - min(last.values()) < 8:
                        wanted.add((str(i), "" if name is None else str(name), min(last.values()), at))
    assert got == wanted and len(got) > 20


def test_split_words():
    column = pa.array(["Ab, c", None, "", "d-É é", "zz"]).slice(1)
    split = split_words(column, kinds(b" -", b","))
    text = [split.vocabulary[int(c)].as_py().decode() for c in split.code]
    assert text == ["d", "É", "é", "zz"] and split.text.tolist() == [2, 2, 2, 3]
    assert split.first.tolist() == [0, 0, 0, 3, 4]
    split = split_words(pa.array(["a, b c", "d.e"]), kinds(b" ", b",."))
    assert split.piece.tolist() == [0, 1, 1, 2, 3]
