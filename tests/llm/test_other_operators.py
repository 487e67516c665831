"""Mixing, url filters, search, classifiers, the queries' SQL and the pipeline."""

import glob
import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from navloom.llm import mixing, quality, topk, toxicity, url_filter
from navloom.llm.common import stored
from navloom.llm.labelled import fold
from navloom.llm.queries import QUERIES
from navloom.llm.sql import SQL
from tests.llm.conftest import PROSE, TEXT_SCHEMA
from tests.test_queries import FOLDER, SPARK_TO_SQL, in_order


def targets(sizes: dict, weights=(3, 1, 2)) -> dict:
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    rest, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        each = rest / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * each > 2 * sizes[s]]
        if not over:
            return out | {s: weight[s] * each for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            rest -= out[s]
            free.remove(s)
    return out


def test_mix(spark, odd, odd_rows, empty):
    chance = random.Random(2)
    rows = [
        (i, " ".join(["w"] * chance.randint(0, 300)), "en", chance.choice(["a", "b", "c", "d", None]), 1)
        for i in range(2000)
    ] + [(i, "w " * 50, "en", "hot", 1) for i in range(2000, 3000)]
    found = mixing.mix(spark.createDataFrame(rows, TEXT_SCHEMA)).collect()
    sizes, taken, target = {}, {}, {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken in (0, r["size"], 2 * r["size"])
    assert target == pytest.approx(targets(sizes))
    for s, t in target.items():
        assert abs(taken[s] - t) <= 300
    again = mixing.mix(spark.createDataFrame(rows, TEXT_SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, found), key=str)
    sizes = sorted(r["size"] for r in mixing.mix(odd).collect())
    assert sizes == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in odd_rows)
    assert mixing.mix(empty).count() == 0


def test_newton_solves_the_dual(spark):
    """Rates are those of the multiplier that bisection over all documents finds."""
    chance = random.Random(4)
    sizes = {
        "a": ([chance.randint(1, 300) for _ in range(400)], 0.4),
        "b": ([chance.randint(1, 9) for _ in range(300)] + [5_000, 20_000], 1.9),
        "c": ([7] * 50, 0.001), "d": ([1, 2, 3], 2.0), "e": ([1, 10_000], 1.0), None: ([2, 9, 9], 1.3),
    }
    rows = [(s, size, n) for s, (all_, _) in sizes.items() for size, n in Counter(all_).items()]
    counted = spark.createDataFrame(rows + [("z", 0, 4)], "source string, size bigint, n bigint")
    wanted = [(s, sum(all_), sum(all_) * part) for s, (all_, part) in sizes.items()] + [("z", 0, 0.0)]
    targets_ = spark.createDataFrame(wanted, "source string, source_size bigint, target double")
    found = {r.source: r for r in mixing.balanced(counted, targets_, 2.0).collect()}
    assert found.keys() == sizes.keys()
    for source, (all_, part) in sizes.items():
        mean = sum(all_) / len(all_)
        rate = lambda size, m: min(2.0, math.exp(min(m * size / mean, 1.0)))
        low, high = -1e6, 1e6
        for _ in range(200):
            middle = (low + high) / 2
            if sum(size * rate(size, middle) for size in all_) < part * sum(all_):
                low = middle
            else:
                high = middle
        assert found[source].mean == pytest.approx(mean)
        for size in all_:
            assert rate(size, found[source].multiplier) == pytest.approx(rate(size, high), rel=1e-4), source


def test_limits_that_are_no_whole_numbers(spark):
    rows = [(i, "w " * (1 + i % 50), "en", "a", 1) for i in range(2_000)]
    found = mixing.mix(spark.createDataFrame(rows, TEXT_SCHEMA), most=1.5).collect()
    assert abs(sum(r.taken for r in found) - found[0].target) <= 50
    assert found[0].target == 1.5 * sum(r["size"] for r in found)
    assert {r.copies for r in found} == {1, 2}


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.NET", "http://example.net/en/1",
        "http://m.example.net/en/", "http://net/x", "http://xnet/x", "http://a.org/fr/x?y",
        "http://example.com#a", "http://EXAMPLE.com/de/7?q=http://z", "x://h?://y/z", "http://ÄB.org/es/1",
    ]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    frame = frame.select("*", *[F.lit(1).alias(c) for c in ("host", "path", "rule", "n", "s1")])
    found = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.judge(frame).collect()}
    assert found == {
        0: ("", "", None), 1: ("", "", None), 2: ("", "", None), 3: ("", "", None),
        4: ("a.example.net", "", None), 5: ("example.net", "/en/1", "example.net/en/"),
        6: ("m.example.net", "/en/", "example.net/en/"), 7: ("net", "/x", "net/"), 8: ("xnet", "/x", None),
        9: ("a.org", "/fr/x", "org/fr/"), 10: ("example.com", "", None),
        11: ("example.com", "/de/7", "example.com/de/"), 12: ("h", "", None), 13: ("Äb.org", "/es/1", None),
    }
    assert url_filter.judge(frame.limit(0)).count() == 0
    assert "Python" not in url_filter.judge(frame)._jdf.queryExecution().executedPlan().toString()


def test_templates_learn_from_what_rules_decide(spark):
    """A host of variable segments; branches that rules block tell of the like elsewhere."""
    rows = [f"http://a.net/ads/{i}" for i in range(40)] + [f"http://b.org/fr/{i}/x" for i in range(40)]
    rows += [f"http://c.com/ads/{i}" for i in range(9)] + [f"http://c.com/fr/{i}" for i in range(9)]
    rows += [f"http://d.com/u{chr(97 + i % 26)}{chr(97 + i // 26)}/home" for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    found = [r.asDict() for r in url_filter.judge(frame).collect()]
    verdict = {(r["host"], r["path"].split("/")[1][:3]): r["verdict"] for r in found if not r["rule"]}
    assert verdict[("c.com", "ads")] == "block" and verdict[("c.com", "fr")] == "allow"
    assert {r["template"] for r in found if r["host"] == "d.com"} == {"/*/home"}


RULES = (("block", "h", "/a/b/c/bad/"), ("allow", "h", "/a/b/c/ok/"))


def test_templates_of_deep_paths(spark):
    """Below a long common path, and below one longer than the other paths."""
    rows = [f"http://h/a/b/c/{s}/{i}/{'x/' * (i % 3)}" for s in ("bad", "ok") for i in range(30)]
    rows += ["http://h/a/b/c/d/e/f/g/h/i/j/k", "http://h/a/b/c", "http://h/" + "z/" * 3000] * 2
    frame = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    found = [r.asDict() for r in url_filter.judge(frame, RULES).collect()]
    assert len(found) == len(rows)
    shares = {s: {r["rejected_share"] for r in found if f"/c/{s}/" in r["path"]} for s in ("bad", "ok")}
    assert min(shares["bad"]) > 0.6 and max(shares["ok"]) < 0.4
    template = {r["path"]: r["template"] for r in found}
    assert template["/a/b/c/bad/1/x/"] == "/a/b/c/bad/*/x"
    assert template["/a/b/c/d/e/f/g/h/i/j/k"] == "/a/b/c/d/e/f/g/h/i/j/k"
    assert template["/" + "z/" * 3000] == "/" + "z/" * 2999 + "z"


def test_like_branches_are_merged(spark):
    """Four equally blocked and four equally allowed siblings give two templates."""
    rules = [("block" if i < 4 else "allow", "h", f"/s/{c}/") for i, c in enumerate("aebfcgdh")]
    rows = [f"http://h/s/{c}/{i}" for c in "abcdefgh" for i in range(20)] + ["http://h/s/new/1"]
    frame = spark.createDataFrame(list(enumerate(rows)), "page_id bigint, url string")
    found = url_filter.judge(frame, rules).collect()
    assert {r.template for r in found} == {"/s/{a|b|e|f}/*", "/s/{c|d|g|h}/*", "/s/new/*"}
    assert {r.verdict for r in found if r.template == "/s/{a|b|e|f}/*"} == {"block"}


def brute_top(rows, k, every):
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    out = set()
    for q, a in whole.items():
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole.items() if i != q)[:k]
            out |= {(q, n, i, -s if abs(s) < 2**63 else None) for n, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("n", [5, 900])
def test_top_k(spark, n, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 128)
    monkeypatch.setattr(topk, "QUERIES", 16)
    chance = np.random.default_rng(3)
    centres = chance.normal(size=(6, 12))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.2 * chance.normal(size=12)]) for i in range(n)]
    rows += [(10_000 + i, rows[0][1]) for i in range(8)]  # ties
    bad = [(20_000, None), (20_100, [math.nan] * 12), (20_200, [math.inf] * 12), (20_300, [1.0]), (20_400, [])]
    bad += [(20_500, [None, *[1.0] * 11]), (None, [1.0] * 12)]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>")
    frame = frame.withColumn("row", F.lit(1)).withColumn("v", F.lit(2)).withColumn("id", F.lit(3))
    found = {tuple(r) for r in topk.top_k(frame, every=50).collect()}
    assert found == brute_top(rows, 10, 50)
    assert topk.top_k(frame.limit(0)).count() == 0


@pytest.mark.parametrize("size, kind", [(2e2, np.float64), (3e5, np.int64), (3.3e6, object), (8e15, object)])
def test_top_k_of_large_components(spark, size, kind):
    """Scores beyond doubles, and beyond longs, are exact and in order."""
    chance = np.random.default_rng(5)
    rows = [(i, [float(x) for x in size * chance.uniform(-1, 1, size=6)]) for i in range(120)]
    rows += [(500 + i, [x + i / 1024 for x in rows[0][1]]) for i in range(5)]
    assert topk.exact_kind(6, int(1024 * size)) is kind
    beyond = [(900, [1e300] * 6), (1000, [-1e17] * 6)]
    frame = spark.createDataFrame(rows + beyond, "vec_id bigint, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(frame, every=50).collect()} == brute_top(rows, 10, 50)


def test_top_k_of_repeated_ids(spark):
    """Each row is one of its own: copies of a query's row are candidates."""
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (3, [2.0, 1.0]), (3, None)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = sorted(tuple(r) for r in topk.top_k(frame, every=5).collect())
    unit = 1024**2
    assert found == [(0, 1, 0, 5 * unit)] * 2 + [(0, 2, 3, 4 * unit)] * 2


def test_top_k_sends_queries_only_to_rings_they_can_need(spark, monkeypatch):
    """Of clustered vectors a query reaches the rings of its own cluster, an eighth of all."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    moved, plain = [], topk.stored

    def counted(table, purpose, *rest):
        out = plain(table, purpose, *rest)
        if purpose == "vector-reach":
            moved.append(out.count())
        return out

    monkeypatch.setattr(topk, "stored", counted)
    chance = np.random.default_rng(4)
    centres = 8 * chance.normal(size=(8, 16))
    for n in (1000, 4000):
        rows = [(i, [float(x) for x in centres[i % 8] + 0.05 * chance.normal(size=16)]) for i in range(n)]
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        found = {tuple(r) for r in topk.top_k(frame, every=100, k=3).collect()}
        assert found == brute_top(rows, 3, 100)
        rings = topk.PIVOTS * max(1, n // (topk.PIVOTS * 16))
        assert moved[-1] < 0.25 * (n // 100) * rings


def auc(scores, labels):
    order = np.argsort(np.array(scores), kind="stable")
    ranks = np.empty(len(order))
    ranks[order] = np.arange(len(order))
    good = np.array(labels) == 1
    return (ranks[good].mean() - (good.sum() - 1) / 2) / (~good).sum()


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_held_out_rows(labelled, odd, empty, module, label):
    docs, labels = labelled
    held = fold(F.col("doc_id"), 5) == 0
    model = module.trained(docs, labels, label, ~held)
    marks = {r.doc_id: r[label] for r in labels.collect() if r[label] is not None}
    rows = [r for r in module.score(docs.filter(held), model).collect() if r.doc_id in marks]
    assert len(rows) > 80
    assert auc([r.score for r in rows], [marks[r.doc_id] for r in rows]) > 0.98
    scores = module.score(odd, model).collect()
    assert len(scores) == 10 and all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if r.doc_id in (1, 2)}) == 1
    assert module.score(empty, model).count() == 0
    # No labels, and labels of one class only.
    for some in (labels.limit(0), labels.filter(f"{label} = 1")):
        plain = module.trained(docs, some, label, ~held)
        assert len({r.score for r in module.score(docs, plain).collect()}) == 1


def test_sum_of_squares_identity():
    machine = quality.Machine(0.3)
    numbers, values, bounds = quality.features([f"{PROSE} Old OLD".encode()])
    machine.linear[:] = np.random.default_rng(1).normal(size=len(machine.linear))
    x, v = values, machine.vectors[numbers]
    pairs = sum(
        float(v[i] @ v[j]) * x[i] * x[j] for i in range(len(x)) for j in range(i)
    )
    expected = 0.3 + float(machine.linear[numbers] @ x) + pairs
    assert machine.raw(numbers, values, bounds)[0] == pytest.approx(expected)


def test_segments_are_all_maximal_ones():
    """Against the definition by recursion: the best stretch, then left and right of it."""

    def split(scores, shift=0):
        best = max(
            ((sum(scores[a:b]), a - b, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
            default=(0, 0, 0, 0),
        )
        # Of equal sums the shortest, then any: values are chosen so that none are equal.
        total, _, a, b = best
        if total <= 0:
            return []
        a, b = min(((b2 - a2, a2, b2) for a2 in range(len(scores)) for b2 in range(a2 + 1, len(scores) + 1)
                    if abs(sum(scores[a2:b2]) - total) < 1e-9))[1:]
        return split(scores[:a], shift) + [(a + shift, b + shift)] + split(scores[b:], shift + b)

    chance = random.Random(8)
    for _ in range(300):
        n = chance.randint(0, 18)
        scores = [chance.uniform(0.1, 2) if chance.random() < 0.4 else -0.37 for _ in range(n)]
        at = [i for i, s in enumerate(scores) if s > 0]
        found = toxicity.segments(at, [scores[i] for i in at], -0.37)
        assert [(a, b) for a, b, _ in found] == split(scores)
        assert all(s == pytest.approx(sum(scores[a:b])) for a, b, s in found)


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    return connection


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", SQL)
def test_queries_equal_their_sql(spark, sql, name):
    frame, expected = QUERIES[name](spark, FOLDER), sql.sql(SQL[name])
    columns = sorted(frame.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: SPARK_TO_SQL[t] for c, t in frame.dtypes} == types
    found = in_order(frame.select(*columns).collect())
    assert found == in_order(expected.project(", ".join(columns)).fetchall())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_pipeline(spark):
    """Each stage against what its predecessor kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text or "" for r in docs.collect()}
    kept = dict(before)
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stored(stage(spark, docs, FOLDER), "test")
        assert docs.columns == columns
        left = {r.doc_id: r.text or "" for r in docs.collect()}
        assert left.items() <= kept.items()
        if name == "exact dedup":
            first = {}
            for i in sorted(kept):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[i]), i)
            assert set(left) == set(first.values())
        kept = left
    assert 0.7 * len(before) < len(kept) < len(before)
    mixed = stored(corpus_pipeline.mix_sources(spark, docs, FOLDER), "test")
    assert mixed.columns == columns and max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2
    tokens = corpus_pipeline.to_tokens(spark, mixed, FOLDER)
    assert tokens.count() == mixed.count()
