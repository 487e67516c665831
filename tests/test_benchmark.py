import statistics

import pytest

from navloom.operators import benchmark as bench
from navloom.operators import documents
from navloom.operators.marts import top_by_month
from tests.conftest import NONE, day


@pytest.fixture(scope="session")
def rates(spark):
    return spark.createDataFrame(
        [(day("2026-02-01"), 1.0), (day("2026-04-01"), 2.5)], "month date, benchmark_pct double"
    )


def test_default_rates(spark, small_fact):
    rows = bench.default_benchmark(spark).collect()
    assert len(rows) == 17
    known = {r.month.month: r.benchmark_pct for r in bench.with_benchmark(
        small_fact, bench.default_benchmark(spark)).collect()}
    assert known == {2: 1.03, 3: 1.13, 4: 1.13}


def test_missing_months_get_the_default(small_fact, rates):
    found = {r.month.month: r.benchmark_pct for r in bench.with_benchmark(small_fact, rates, 9.0).collect()}
    assert found == {2: 1.0, 3: 9.0, 4: 2.5}


def test_repeated_rates_do_not_multiply_rows(small_fact, rates):
    assert bench.with_benchmark(small_fact, rates.unionAll(rates)).count() == small_fact.count()


def test_ranking_against_the_benchmark(small_fact, rates):
    rows = bench.top_against_benchmark(top_by_month(small_fact), rates).collect()
    by_key = {(r.month.month, r["rank"]): r for r in rows}
    assert by_key[4, 1].delta_pct == pytest.approx(2.1)
    assert by_key[4, 2].delta_pct == pytest.approx(-0.3)
    assert by_key[4, 1].chart_bound_pct == pytest.approx(4.6)
    assert by_key[2, 1].chart_bound_pct == pytest.approx(3.1)


def test_cumulative_and_kpis(small_fact, rates):
    running = bench.cumulative_vs_benchmark(small_fact, rates)
    rows = running.filter("class_id = 'one'").orderBy("month").collect()
    fund = [1.031 - 1, 1.031 * 1.014 - 1, 1.031 * 1.014 * 1.022 - 1]
    rate = [1.01 - 1, 1.01 * 1.011 - 1, 1.01 * 1.011 * 1.025 - 1]
    assert [r.cumulative for r in rows] == pytest.approx(fund)
    assert [r.benchmark_cumulative for r in rows] == pytest.approx(rate)
    assert rows[2].delta_cumulative_pp == pytest.approx((fund[2] - rate[2]) * 100)
    assert [r.month_position for r in rows] == ["above", "above", "below"]
    kpis = {r.class_id: r for r in bench.series_kpis(running).collect()}
    first, second = kpis["one"], kpis["two"]
    assert first.months == 3 and second.months == 1
    assert first.cumulative_pct == pytest.approx(fund[2] * 100)
    assert first.delta_cumulative_pp == pytest.approx((fund[2] - rate[2]) * 100)
    assert (first.best_month_pct, first.worst_month_pct) == pytest.approx((3.1, 1.4))
    assert first.volatility_pct == pytest.approx(statistics.pstdev([3.1, 1.4, 2.2]))
    assert second.volatility_pct == 0.0
    assert (first.verdict, second.verdict) == ("above", "above")


def test_factors_at_or_below_zero(make_fact, rates):
    fact = make_fact(
        [("a", NONE, f"2026-0{m}-01", r) for m, r in enumerate([0.5, -1.0, 0.5], 1)]
        + [("b", NONE, f"2026-0{m}-01", r) for m, r in enumerate([-1.5, -3.0], 1)]
    )
    rows = bench.cumulative_vs_benchmark(fact, rates).orderBy("class_id", "month").collect()
    assert [r.cumulative for r in rows] == pytest.approx([0.5, -1.0, -1.0, -1.5, 0.0])


def test_series_without_a_type_gets_a_label(make_fact, rates):
    fact = make_fact([("a", NONE, "2026-04-01", 0.1, 20, 1e6, 5, None)])
    running = bench.cumulative_vs_benchmark(fact, rates)
    assert bench.series_kpis(running).first().class_type == "Classe de fundo"
    assert bench.series_kpis(running, "unknown").first().class_type == "unknown"
    assert bench.report_table(running).first().month_label == "2026-04"


def test_documents(small_fact):
    series = {r.class_id: r for r in documents.series_documents(small_fact).collect()}
    first = series["one"].series
    assert [r.month.month for r in first] == [2, 3, 4]
    assert first[0].return_pct == pytest.approx(3.1)
    assert len(series["two"].series) == 1
    ranking = {r.month.month: r for r in documents.ranking_documents(top_by_month(small_fact)).collect()}
    april = ranking[4]
    assert april.total == 2
    assert [(r["rank"], r.class_id) for r in april.ranking] == [(1, "two"), (2, "one")]


def test_documents_keep_nulls(make_fact):
    fact = make_fact([("a", NONE, "2026-04-01", 0.1, 20, None, None, None)])
    record = documents.series_documents(fact).first().series[0]
    assert record.month_end_net_assets is None and record.month_end_holders is None
