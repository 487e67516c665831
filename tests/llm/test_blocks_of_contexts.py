"""Contexts of op5 are compared by blocks of bytes, and repeats leave as whole stretches."""

import random

import numpy as np
import pyarrow as pa
import pytest

from navloom.llm import suffix_dedup

CORE = bytes(range(32))
SCHEMA = "core binary, low int, high int, context binary, shift int, doc bigint, begin int"


def contexts(seed, many, letters):
    """Near copies around one core, some of them cut by the ends of their texts."""
    chance = random.Random(seed)
    prose = lambda n: bytes(chance.randrange(200, 200 + letters) for _ in range(n))
    left, right, found = prose(68), prose(68), set()
    while len(found) < many:
        a, b = bytearray(left), bytearray(right)
        for side in (a, b):
            for _ in range(chance.randrange(3)):
                side[chance.randrange(68)] = 199
        before, after = (chance.choice([68, 68, 40, 0]) for _ in range(2))
        found.add((bytes(a[68 - before :]), bytes(b[:after])))
    return sorted(found, key=lambda _: chance.random())


def brute(sides):
    """Bytes of each context, by distance from the core, in windows that came before."""
    seen, gone = set(), []
    for left, right in sides:
        text, bytes_ = left + CORE + right, set()
        for at in range(len(text) - 99):
            # Equal windows have the core at one place.
            window = text[at : at + 100], len(left) - at
            if window in seen:
                bytes_ |= {at + k - len(left) for k in range(100)}
            seen.add(window)
        gone.append(bytes_)
    return gone


def test_a_context_gives_one_stretch(spark):
    """Not a row for each of its windows, of which there are up to 69."""
    sides = contexts(1, 40, 3)
    rows = [
        (CORE, -68, 0, left + CORE + right, len(left), doc, 1000 - len(left))
        for doc, (left, right) in enumerate(sides)
    ]
    found = suffix_dedup._compare(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len({r.doc for r in found})
    got = {r.doc: set(range(r.start - 1000, r.stop - 1000)) for r in found}
    assert [got.get(doc, set()) for doc in range(len(sides))] == brute(sides)


@pytest.mark.parametrize("seed", range(20))
def test_few_symbols_are_sorted(seed, monkeypatch):
    """As many as there are places where contexts part, not as many as bytes."""
    sides = contexts(seed, 2 + seed % 7, 2)
    given, sort = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda s: given.append(s) or sort(s))
    reverse = [(left[::-1], right) for left, right in sides]
    found = suffix_dedup.repeats(reverse, [(n, 500) for n in range(len(sides))], len(CORE))
    got = {doc: set(range(start - 500, stop - 500)) for doc, start, stop in found}
    assert [got.get(n, set()) for n in range(len(sides))] == brute(sides)
    # A core, a separator, and blocks: two texts part once and end twice, on each side.
    n = len(sides)
    assert len(given[0]) <= n * (2 + 2 * (2 * n - 1))


def test_the_first_row_is_that_of_least_place():
    """Rows of one text, in any order."""
    sides = [(b"x" * 68, b"a" * 40), (b"x" * 68, b"b" * 40), (b"x" * 68, b"c" * 40)]
    found = suffix_dedup.repeats(sides, [(7, 900), (7, 300), (5, 950)], len(CORE))
    assert sorted(found) == [(7, 232, 332), (7, 832, 932)]


def test_spans_are_merged_per_row():
    """Null and empty lists, spans that touch, overlap, lie in others or go beyond the text."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    chance = random.Random(4)
    rows = [None, [], [(5, 9), (9, 12), (0, 2)], [(3, 90)], None, [(1, 8), (2, 3), (9, 10)]]
    rows += [[(a, a + chance.randint(1, 9)) for a in chance.choices(range(50), k=6)] for _ in range(30)]
    named = [r and [{"start": a, "stop": b} for a, b in r] for r in rows]
    sizes = [60, 0, 12, 40, 3, 10] + [chance.randint(50, 60) for _ in range(30)]
    gone = pa.array([named[3], *named], kind).slice(1)
    of, starts, stops = suffix_dedup.merged_spans(gone, np.array(sizes))
    got = list(zip(of.tolist(), starts.tolist(), stops.tolist()))
    expected = []
    for n, (row, size) in enumerate(zip(rows, sizes)):
        hit = bytearray(size + 1)
        for a, b in row or ():
            hit[a : min(b, size)] = b"\1" * (min(b, size) - a)
        edges = [k for k in range(size + 1) if hit[k] != (hit[k - 1] if k else 0)]
        expected += [(n, a, b) for a, b in zip(edges[::2], edges[1::2])]
    assert got == expected
    nothing = suffix_dedup.merged_spans(pa.array([None, []], kind), np.array([4, 0]))
    assert [len(column) for column in nothing] == [0, 0, 0]
