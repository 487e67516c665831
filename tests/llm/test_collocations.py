"""Phrases against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from navloom.llm import collocations


def brute(rows, least, top, words=5, within=100):
    counts, totals = {}, {}
    for text, lang in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] = totals.get(lang, 0) + len(w)
            for k in range(1, words + 1):
                for i in range(len(w) - k + 1):
                    key = lang, tuple(w[i : i + k])
                    counts[key] = counts.get(key, 0) + 1
    counts = {p: a for p, a in counts.items() if a >= least}
    out = {}
    for (lang, p), a in counts.items():
        if len(p) == 1:
            continue
        cuts = []
        for k in range(1, len(p)):
            l, r = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        longer = [
            b for (other, q), b in counts.items() if other == lang and len(q) > len(p)
            and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        ]
        if not any(100 * b >= within * a for b in longer):
            score, _, l, r = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), a, l, r, totals[lang], score))
    return sorted(
        (lang, n, p.decode(), *rest)
        for lang, found in out.items() for n, (_, _, p, *rest) in enumerate(sorted(found)[:top], 1)
    )


def rows_of(frame):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect())


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(11)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "zü", "a\xa0b", "x'y"]
    phrases = [[chance.choice(vocabulary) for _ in range(n)] for n in (2, 3, 4, 5, 6, 7)]
    rows = []
    for i in range(300):
        w = []
        for _ in range(chance.randint(0, 12)):
            w += chance.choice(phrases) if chance.random() < 0.6 else [chance.choice(vocabulary)]
            if chance.random() < 0.1:
                w.append(chance.choice([".", ",", "x;y", "a:b!", "\n", "\x0b"]))
        rows.append((chance.choice([" ", "  ", "\t"]).join(w).title(), chance.choice(["en", "en", "de", None, "und"])))
    rows += [(None, "en"), ("", None), ("the the the the the the " * 40, "en"), ("...", "de"), ("solo", "xx")]
    return rows


@pytest.fixture(scope="module")
def table(spark, texts):
    frame = spark.createDataFrame(texts, "text string, lang string").repartition(3)
    return frame.select("*", *[F.lit(1).alias(c) for c in ("n", "phrase", "print", "segment", "count", "place")])


@pytest.mark.parametrize("bits, segment_bytes", [(64, collocations.SEGMENT_BYTES), (5, 3_000), (64, 500)])
def test_collocations(table, texts, bits, segment_bytes):
    """Also with fingerprints of which many collide, and with many segments."""
    got = rows_of(collocations.collocations(table, least=12, top=40, bits=bits, segment_bytes=segment_bytes))
    assert got == brute(texts, 12, 40)
    assert {lang for lang, *_ in got} == {"en", "de", "und"} and len(got) > 60


def test_other_limits(table, texts):
    got = rows_of(collocations.collocations(table, words=3, least=5, top=1000, within=60))
    assert got == brute(texts, 5, 1000, words=3, within=60)


def test_nothing_frequent_and_empty_tables(table, odd, empty, odd_rows):
    assert collocations.collocations(table, least=10**6).count() == 0
    assert collocations.collocations(table, least=300).count() == 0
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(odd, least=5).count() == 0
    few = [(r[1], r[2]) for r in odd_rows if r[0] != 5]
    got = rows_of(collocations.collocations(odd.where("doc_id is null or doc_id != 5"), least=3, top=50))
    assert got == brute(few, 3, 50)


def test_fingerprints_depend_on_words_and_order_alone():
    hashes = np.random.default_rng(1).integers(0, 2**64, 50, dtype=np.uint64)
    again = np.concatenate([hashes[20:23], hashes[:10], hashes[20:23]])
    prints = collocations.fingerprints(again, 3)
    assert prints[0] == prints[13] == collocations.fingerprints(hashes, 3)[20]
    assert len(set(prints.tolist())) == len(prints) - 1
    assert collocations.fingerprints(hashes[[1, 0]], 2)[0] != collocations.fingerprints(hashes[[0, 1]], 2)[0]
    assert len(collocations.fingerprints(hashes[:2], 3)) == 0


def test_equal_fingerprints_of_other_words_are_counted_apart():
    codes = np.array([1, 2, 3, 1, 2, 4, 1, 2], np.int32)
    places = np.array([0, 2, 3, 6])
    prints, counts, first = collocations.counted(np.zeros(4, np.uint64), places, codes, 2)
    assert sorted(zip(counts.tolist(), first.tolist())) == [(1, 2), (3, 0)] and (prints == 0).all()
