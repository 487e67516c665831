import random
import statistics

import pytest

from navloom.operators import median
from navloom.operators.median import exact_median


def medians(spark, groups, few_groups):
    rows = [(key, float(v)) for key, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(3)
    return {r.k: r.m for r in exact_median(frame, ["k"], "v", "m", few_groups).collect()}


@pytest.mark.parametrize("few_groups", [True, False])
def test_against_brute_force(spark, few_groups):
    draw = random.Random(3)
    groups = {
        "odd": [draw.gauss(0, 1) for _ in range(4001)],
        "even": [draw.gauss(0, 1) for _ in range(4000)],
        "ties": [draw.choice([1, 2, 3]) for _ in range(3000)],
        "same": [5] * 1000,
        "halves": [0] * 500 + [1] * 500,
        "one": [7],
        "two": [1, 2],
        "skewed": [draw.paretovariate(0.5) for _ in range(5000)],
    }
    found = medians(spark, groups, few_groups)
    assert found.keys() == groups.keys()
    for key, values in groups.items():
        assert found[key] == pytest.approx(statistics.median(values), rel=1e-12), key


@pytest.mark.parametrize("margin, accuracy", [(0.0, 1), (0.4, 1), (0.49, 10_000)])
def test_cut_points_do_not_change_the_result(spark, monkeypatch, margin, accuracy):
    monkeypatch.setattr(median, "MARGIN", margin)
    monkeypatch.setattr(median, "ACCURACY", accuracy)
    draw = random.Random(5)
    groups = {str(n): [draw.randint(0, n) for _ in range(n)] for n in (1, 2, 3, 10, 501, 1000)}
    found = medians(spark, groups, True)
    assert found == {key: statistics.median(values) for key, values in groups.items()}
