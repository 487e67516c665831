"""Every stage of the pipeline on odd and empty tables with clashing names."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from navloom.llm import simhash
from tests.test_queries import FOLDER

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
NAMES = ["col", "of_row", "copy", "a`b", "a.b", "ROW2"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def wide(odd):
    return odd.select("*", *[F.lit(i).alias(name) for i, name in enumerate(NAMES)])


@pytest.mark.parametrize("name", STAGES)
def test_stage(spark, wide, empty, odd_rows, name):
    found = STAGES[name](spark, wide, FOLDER)
    nothing = STAGES[name](spark, empty, FOLDER)
    assert nothing.count() == 0
    rows = found.collect()
    if name == "byte-level BPE":
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows)
        assert {len(r.ids) for r in rows if r.doc_id in (1, 2)} == {0}
        return
    assert found.columns == wide.columns and nothing.columns == empty.columns
    ids = [r.doc_id for r in rows]
    assert all(r["a`b"] == NAMES.index("a`b") for r in rows)
    if name == "quality classifier":
        # Equal rows, and texts without words, go or stay together.
        assert ids.count(3) in (0, 2) and (1 in ids) == (2 in ids)
    if name == "exact dedup":
        texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in rows]
        wanted = {re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in odd_rows}
        assert len(texts) == len(set(texts)) and set(texts) == wanted
        assert ids.count(3) == 1 and ids.count(1) == 1 and 2 not in ids
    if name == "simhash near-dedup":
        groups = {r.component_id for r in simhash.near_groups(wide).collect()}
        assert sorted(map(str, ids)) == sorted(map(str, groups))
    if name == "mixing sources":
        assert max(ids.count(i) for i in ids) <= 4 and ids.count(5) <= 2
