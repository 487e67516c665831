"""Physical plans: what moves, what is combined before it moves, where Python runs."""

import re

import pytest

from navloom.operators import reports
from navloom.operators.marts import top_by_month
from navloom.operators.returns import daily_returns, month_rollup, monthly_returns
from navloom.operators.staging import stage_reports
from navloom.sources import lake


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory, make_staged):
    from navloom.fixed_values import RAW_TO_STAGED

    rows = make_staged([(c, None, f"2026-0{m}-{d:02d}", d + 0.5) for c in "abc" for m in (1, 2) for d in range(1, 21)])
    raw = rows.selectExpr(
        *[f"{name} AS {raw}" for raw, (name, _) in RAW_TO_STAGED.items()],
        "date_format(as_of, 'yyyy-MM') AS year_month",
    )
    root = str(tmp_path_factory.mktemp("lake"))
    lake.write_lake(raw, root)
    return stage_reports(lake.read_lake(spark, root))


def test_staging_filters_reach_the_scan(staged):
    plan = plan_of(staged.select("class_id", "unit_value"))
    assert "GreaterThan(VL_QUOTA,0.0)" in plan
    assert "IsNotNull(CNPJ_FUNDO_CLASSE)" in plan
    assert "NR_COTST" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_rollup_combines_before_it_shuffles(staged):
    plan = plan_of(month_rollup(staged))
    below_first_shuffle = plan[plan.rindex("Exchange") :]
    assert "HashAggregate" in below_first_shuffle and "partial_max_by" in below_first_shuffle
    assert plan.count("Exchange hashpartitioning") == 2
    assert "CAPTC_DIA" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_monthly_returns_add_no_shuffle_to_the_rollup(staged):
    assert plan_of(monthly_returns(staged)).count("Exchange hashpartitioning") == 2


def test_daily_returns_sort_no_more_than_a_month_of_a_series(staged):
    plan = plan_of(daily_returns(staged))
    lag = next(line for line in plan.splitlines() if "lag(unit_value" in line)
    assert re.search(r"\], \[class_id#\d+, subclass_id#\d+, month#\d+\], \[row_order", lag)


def test_ranking_limits_groups_before_the_shuffle(staged):
    plan = plan_of(top_by_month(monthly_returns(staged)))
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and "Final" in plan
    month_shuffle = plan.index("Exchange hashpartitioning(month")
    assert plan.index("Final") < month_shuffle < partial


def test_searches_keep_only_the_rows_asked_for(small_fact):
    assert "TakeOrderedAndProject" in plan_of(reports.class_search(small_fact))


def test_no_python_and_no_cross_join_in_marts_and_reports(spark, staged, small_fact):
    from navloom.operators import benchmark, documents, quality

    rates = benchmark.default_benchmark(spark)
    running = benchmark.cumulative_vs_benchmark(small_fact, rates)
    ranked = top_by_month(small_fact)
    frames = [
        daily_returns(staged),
        monthly_returns(staged),
        ranked,
        reports.month_kpis(small_fact, rates),
        reports.size_band_report(small_fact, rates),
        reports.return_histogram(small_fact),
        reports.class_history(small_fact),
        benchmark.series_kpis(running),
        benchmark.top_against_benchmark(ranked, rates),
        documents.series_documents(small_fact),
        quality.unique_check("x", staged, ["class_id"]),
    ]
    for frame in frames:
        plan = plan_of(frame)
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_medians_hold_no_group_in_one_buffer(spark, small_fact):
    from navloom.operators.benchmark import default_benchmark

    plan = plan_of(reports.month_kpis(small_fact, default_benchmark(spark)))
    assert "median(" not in plan and re.search(r"\bpercentile\(", plan) is None


def test_history_of_all_classes_is_not_sorted_as_a_whole(small_fact):
    plan = plan_of(reports.class_history(small_fact))
    assert "rangepartitioning" not in plan
    # Facts are combined to one row per series by hash before anything sorts them.
    assert "HashAggregate" in plan[plan.rindex("SortAggregate") :]


def test_facts_do_not_move_for_the_check_of_the_ranking(spark, small_fact):
    from navloom.operators import quality

    plan = plan_of(quality.ranked_without_fact(top_by_month(small_fact), small_fact))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
