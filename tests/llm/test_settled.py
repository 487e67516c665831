"""Tables stored on the way to a result go once the result is stored."""

import os

import pytest

from navloom.llm.common import settled, stored


def folder(table):
    return os.path.dirname(table.inputFiles()[0].removeprefix("file:").replace("///", "/"))


def test_inner_tables_go(spark):
    inner = []

    def build():
        inner.append(folder(stored(spark.range(5), "inner")))
        below = settled(spark, lambda: stored(spark.range(3), "deeper"), "below")
        inner.append(folder(below))
        return below.union(spark.range(2))

    table = settled(spark, build, "outer")
    assert table.count() == 5 and os.path.isdir(folder(table))
    assert not any(map(os.path.exists, inner))


def test_inner_tables_go_after_failures(spark):
    inner = []

    def build():
        inner.append(folder(stored(spark.range(5), "inner")))
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        settled(spark, build, "outer")
    assert not os.path.exists(inner[0])
    kept = stored(spark.range(1), "kept")
    assert os.path.isdir(folder(kept))
