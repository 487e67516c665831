"""Exact, near and partial copies against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from navloom.llm import exact_dedup, simhash, suffix_dedup
from navloom.llm.components import components
from navloom.llm.suffix_array import suffix_array
from tests.llm.conftest import PROSE, TEXT_SCHEMA


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("bucket_bytes", [exact_dedup.BUCKET_BYTES, 200])
def test_exact_groups(odd, odd_rows, bucket_bytes, monkeypatch):
    """Also with buckets that have to be partitioned again, and without combining."""
    if bucket_bytes == 200:
        monkeypatch.setattr(exact_dedup, "COMBINE_BYTES", 0)
    rows = exact_dedup.exact_groups(odd, bucket_bytes=bucket_bytes).collect()
    groups = {}
    for i, text, *_ in odd_rows:
        groups.setdefault(normal(text), []).append(i)
    expected = sorted(
        (str(i), str(min((x for x in ids if x is not None), default=None)), len(ids),
         hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items() for i in ids
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows) == expected
    assert sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_exact_groups_of_a_hot_text_and_of_nothing(spark, empty):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, PROSE).otherwise(F.col("id").cast("string")).alias("text"),
    ).repartition(7)
    rows = exact_dedup.exact_groups(docs).groupBy("group_size").count().collect()
    assert {r.group_size: r["count"] for r in rows} == {1000: 1000, 1: 2000}
    assert exact_dedup.exact_groups(empty).count() == 0


def test_open_addressing_compares_contents():
    table = exact_dedup.Table()
    for n in range(3000):
        assert table.number(n % 5, f"t{n}".encode(), n) == n
    assert [table.number(n % 5, f"t{n}".encode(), -1) for n in range(3000)] == list(range(3000))


def brute_prints(rows, words=3):
    found = []
    for i, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(w[j : j + words]) for j in range(max(1, len(w) - words + 1))] if w else []
        counts = [0] * 64
        for s in shingles:
            h = xxhash.xxh64_intdigest(s.encode(), 42)
            for b in range(64):
                counts[b] += h >> b & 1
        found.append((i, sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))))
    return found


def brute_classes(values, radius):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    array = np.array(values, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= radius):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def test_simhash_groups(odd, odd_rows, empty):
    prints = brute_prints(odd_rows)
    classes = brute_classes([p for _, p in prints], 3)
    expected = sorted(
        (str(i), f"{p:016x}", str(min((prints[k][0] for k in range(len(prints))
                                       if classes[k] == c and prints[k][0] is not None), default=None)))
        for (i, p), c in zip(prints, classes)
    )
    rows = simhash.near_groups(odd).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == expected
    assert simhash.near_groups(empty).count() == 0


@pytest.mark.parametrize("chunk, per_bucket", [(2048, 256), (50, 1)])
def test_no_link_is_lost(spark, chunk, per_bucket, monkeypatch):
    """Clouds of close fingerprints, in whole buckets and in pairs of chunks."""
    monkeypatch.setattr(simhash, "PER_BUCKET", per_bucket)
    chance = np.random.default_rng(1)
    clouds = [
        base ^ np.uint64(sum(1 << int(b) for b in chance.choice(64, n, replace=False)))
        for base in chance.integers(0, 2**63, 8, dtype=np.uint64)
        for n in chance.integers(0, 8, 120)
    ]
    values = np.unique(np.array(clouds, np.uint64))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "print bigint")
    vertices = frame.select(F.col("print").alias("vertex"), "print")
    got = {r.vertex: r.root for r in components(simhash.links(vertices, 3, chunk=chunk)).collect()}
    classes = brute_classes(values.tolist(), 3)
    members = {}
    for value, c in zip(values.view(np.int64).tolist(), classes):
        members.setdefault(c, []).append(value)
    assert got == {v: min(m) for m in members.values() if len(m) > 1 for v in m}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a bigint, b bigint")
    found = {r.vertex: r.root for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_near_copies_of_odd_and_empty_tables(empty, odd):
    """Equal rows are near copies, as are texts without words, and a text beside itself twice."""
    assert simhash.without_near_copies(empty).count() == 0
    left = simhash.without_near_copies(odd)
    assert left.columns == odd.columns
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(["1", "3", "5", "None"])


def test_near_copies_are_those_of_the_groups(spark, odd, odd_rows):
    """One row of each component of close fingerprints stays, that of least id."""
    chance = random.Random(6)
    rows = list(odd_rows)
    for i in range(40):
        words = [f"w{chance.randint(0, 900)}" for _ in range(chance.choice([4, 60, 400]))]
        for n in range(chance.randint(1, 4)):
            rows.append((100 + 10 * i + n, " ".join(words), "en", "s", 1))
            words[chance.randrange(len(words))] = "other"
    frame = spark.createDataFrame(rows, TEXT_SCHEMA).withColumn("a`b", F.lit(1)).withColumn("row", F.lit(2))
    groups = simhash.near_groups(frame).collect()
    left = simhash.without_near_copies(frame)
    assert left.columns == frame.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted({str(r.component_id) for r in groups})


def test_a_hub_of_many_edges(spark):
    """A vertex with most of the edges, beside a chain."""
    edges = [(10_000, i) for i in range(20, 3000)] + [(i, i + 1) for i in range(5)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)).collect()
    assert {r.vertex: r.root for r in found} == {
        **{i: 20 for i in range(20, 3000)}, 10_000: 20, **{i: 0 for i in range(6)}
    }
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_suffix_array():
    chance = random.Random(3)
    for n in range(1500):
        letters = chance.choice([1, 2, 3, 26])
        text = [chance.randint(0, letters - 1) for _ in range(chance.randint(0, 40))]
        text *= chance.randint(1, 4) if n % 5 == 0 else 1
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_repeats(rows):
    seen, found = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        found.append((str(i), len(data), sum(gone), runs, kept))
    return sorted(found)


@pytest.mark.parametrize("members", [suffix_dedup.MEMBERS, 2])
def test_repeated_passages(spark, members):
    """Passages in the middle, at the ends, within a row, periodic ones, hot ones, copies."""
    chance = random.Random(9)
    prose = lambda n: "".join(chance.choice("abcdefgh é") for _ in range(n))
    passages = [prose(n) for n in (98, 99, 130, 250)]
    rows = []
    for i in range(40):
        parts = [prose(chance.randint(0, 120)) for _ in range(3)]
        rows.append((i, parts[0] + passages[i % 4] + parts[1] + passages[1] + parts[2]))
    rows += [(50, rows[7][1]), (51, "ab" * 200), (52, "x" * 500 + "ab" * 90), (53, passages[3] * 3)]
    rows += [(54, None), (55, ""), (56, "short"), (57, passages[3][:100]), (58, passages[3][:99])]
    chance.shuffle(rows)
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], TEXT_SCHEMA)
    found = suffix_dedup.remove_repeats(frame, members=members).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in found)
    assert got == brute_repeats(rows)


def test_repeated_passages_of_odd_tables(odd, odd_rows, empty):
    found = suffix_dedup.remove_repeats(odd).collect()
    texts = {(str(r[0]), r[1] or "") for r in odd_rows}
    assert len(found) == len(odd_rows)
    first = [r for r in found if r.doc_id == 5][0]
    assert first.n_bytes == len(dict(texts)["5"])
    rows = [(r[0], r[1]) for r in odd_rows if r[0] != 5]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept))
                 for r in found if r.doc_id != 5)
    assert got == brute_repeats(rows)
    assert suffix_dedup.remove_repeats(empty).count() == 0
