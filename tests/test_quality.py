from dataclasses import replace

import pytest

from navloom.operators import quality
from navloom.operators.marts import class_dimension, monthly_fact, top_by_month
from navloom.operators.returns import monthly_returns
from navloom.plans.warehouse import store
from tests.conftest import NONE, day

LIMITS = quality.Limits(min_staged_rows=10, min_dimension_rows=1, min_holders=1)


@pytest.fixture(scope="session")
def tables(make_staged):
    staged = make_staged(
        [
            (c, s, f"2026-0{m}-{d:02d}", 10 + d / 10)
            for c in "abc" for s in (None, "1") for m in (1, 2) for d in range(1, 21)
        ]
    )
    dimension = class_dimension(staged)
    fact = monthly_fact(monthly_returns(staged), dimension)
    return {"staged": staged, "dimension": dimension, "fact": fact, "top": top_by_month(fact)}


def outcome(tables, limits=LIMITS, **changed):
    rows = quality.run_checks(**{**tables, **changed}, limits=limits).collect()
    assert len(rows) == len({r.check for r in rows}) == 30
    return {r.check: r for r in rows}


def broken(rows):
    return {name for name, r in rows.items() if not r.passed}


def test_sound_tables_pass(tables):
    rows = outcome(tables)
    assert broken(rows) == set()
    assert rows["staged has enough rows"].total == 240
    assert rows["fact rows per class plausible"].total == 12
    assert rows["fact.class_key in dimension"].total == 12


def test_full_size_limits_are_the_default(tables):
    assert {"staged has enough rows", "dimension has enough rows"} <= broken(
        outcome(tables, limits=None)
    )


def test_staged_rules(tables, make_staged):
    bad = tables["staged"].unionByName(
        make_staged(
            [
                ("a", None, "2026-01-01", 1.0),
                ("z", None, "2026-01-01", 0.0),
                ("z", None, "2026-01-02", 1.0, -2e6, -1),
                (None, None, "2026-01-03", 1.0),
            ]
        )
    )
    rows = outcome(tables, staged=bad)
    assert broken(rows) == {
        "staged series and day unique",
        "staged.unit_value positive",
        "staged.holders not negative",
        "staged.net_assets rarely negative",
        "staged.net_assets never far below zero",
        "staged.class_id not null",
    }
    assert all(rows[name].failures == 1 for name in broken(rows))
    assert rows["staged.net_assets rarely negative"].ratio == pytest.approx(1 / 244)
    loose = replace(LIMITS, max_negative_assets_ratio=0.01)
    assert "staged.net_assets rarely negative" not in broken(outcome(tables, loose, staged=bad))


def test_negative_ratio_has_to_stay_below_its_limit(tables, make_staged):
    staged = tables["staged"].limit(9).unionByName(
        make_staged([("z", None, "2026-01-01", 1.0, -1.0)])
    )
    at_limit = replace(LIMITS, max_negative_assets_ratio=0.1)
    rule = "staged.net_assets rarely negative"
    assert rule in broken(outcome(tables, at_limit, staged=staged))


def test_fact_and_dimension_rules(tables, make_fact):
    fact = tables["fact"].unionByName(
        make_fact([("x", NONE, "2026-01-01", 2.0, 26), ("x", NONE, "2026-01-01", 0.1)])
    )
    rows = outcome(tables, fact=fact)
    assert broken(rows) == {
        "fact.class_key in dimension",
        "fact.return_key unique",
        "fact.obs_days plausible",
        "fact.month_return rarely above the outlier limit",
    }
    assert rows["fact.class_key in dimension"].failures == 2
    twice = tables["dimension"].unionAll(tables["dimension"])
    assert "dimension.class_key unique" in broken(outcome(tables, dimension=twice))
    assert "fact rows per class plausible" in broken(
        outcome(tables, replace(LIMITS, fact_per_class=(0.5, 1.0)))
    )


def test_outlier_ratio_may_reach_its_limit(make_fact):
    fact = make_fact([(f"c{i}", NONE, "2026-01-01", 2.0 if i == 0 else 0.1) for i in range(10)])
    rule = "fact.month_return rarely above the outlier limit"
    for allowed, passed in ((0.1, True), (0.09, False)):
        rules = quality.fact_rules(replace(LIMITS, max_outlier_ratio=allowed))
        rows = {r.check: r for r in quality.count_rules(fact, rules).collect()}
        assert rows[rule].passed is passed


def test_ranking_rules(tables):
    top = tables["top"]
    assert broken(outcome(tables, top=top.limit(0))) == {
        "top.month_end_holders accepted", "top report answers", "top rows per month limited",
    }
    strict = replace(LIMITS, top_n=5, min_net_assets=1e7, min_holders=11)
    assert broken(outcome(tables, strict)) == {
        "top rows per month limited",
        "top.month_end_net_assets accepted",
        "top.month_end_holders accepted",
    }
    assert broken(outcome(tables, fact=tables["fact"].filter("class_id <> 'a'"))) >= {
        "top rows exist in fact"
    }


def test_failing_rows_and_keys(tables, make_staged, make_fact):
    staged = make_staged([("a", None, "2026-01-01", 1.0, -2e6), ("a", None, "2026-01-01", 2.0)])
    rule = next(r for r in quality.staged_rules(LIMITS) if r.name.endswith("far below zero"))
    assert quality.failing_rows(staged, rule).first().net_assets == -2e6
    repeated = quality.repeated_keys(staged, ["class_id", "subclass_id", "as_of"]).first()
    assert (repeated.subclass_id, repeated["rows"]) == (None, 2)
    fact = make_fact([("a", NONE, "2026-01-01", 0.1), ("b", NONE, "2026-01-01", 0.1)])
    dimension = fact.filter("class_id = 'a'").select("class_key")
    assert [r.class_id for r in quality.orphan_facts(fact, dimension).collect()] == ["b"]
    top = top_by_month(fact)
    assert quality.ranked_without_fact(top, fact.filter("class_id = 'a'")).first().class_id == "b"
    assert quality.most_ranked_in_a_month(top).first().most_rows == 2
    assert day("2026-01-01") == top.first().month


def test_rules_counted_by_the_write(spark, tables, make_staged, tmp_path):
    bad = tables["staged"].unionByName(
        make_staged([("z", None, "2026-01-01", 0.0), ("z", None, "2026-01-02", 1.0, -2e6, -1)])
    )
    changed = {**tables, "staged": bad, "top": tables["top"].limit(0)}
    watched, kept = quality.watches(LIMITS), {}
    for name, table in changed.items():
        by = "month" if name == "fact" else None
        kept[name] = store(table, f"{tmp_path}/{name}", by, watched[name])
    plain = quality.run_checks(**kept, limits=LIMITS)
    seen = quality.run_checks(**kept, limits=LIMITS, watched=watched)
    assert sorted(seen.collect()) == sorted(plain.collect())
    assert "staged.unit_value positive" in broken({r.check: r for r in seen.collect()})
    assert scans(plain) - scans(seen) == 4


def scans(table):
    return table._jdf.queryExecution().optimizedPlan().toString().count("parquet")


def test_a_watch_counts_one_write(spark, tables):
    watch = quality.Watch(quality.dimension_rules())
    with pytest.raises(ValueError):
        watch.results(spark)
    watch.on(tables["dimension"])
    with pytest.raises(ValueError):
        watch.on(tables["dimension"])
