import datetime
import math
import random

import pytest

from navloom.operators.returns import compound_daily, daily_returns, month_rollup, monthly_returns
from tests.conftest import NONE, day


def by_day(frame):
    return {(r.class_id, r.subclass_id, r.as_of.isoformat()): r for r in frame.collect()}


def by_month(frame):
    return {(r.class_id, r.subclass_id, r.month.isoformat()): r for r in frame.collect()}


def test_daily_return_crosses_months_and_gaps(make_staged):
    rows = by_day(
        daily_returns(
            make_staged(
                [
                    ("a", None, "2026-01-30", 100.0),
                    ("a", None, "2026-02-02", 110.0),
                    ("a", None, "2026-02-03", 99.0),
                    ("a", None, "2026-05-04", 198.0),
                    ("b", "1", "2026-02-02", 5.0),
                    ("b", None, "2026-02-03", 6.0),
                ]
            )
        )
    )
    assert len(rows) == 6
    first = rows["a", NONE, "2026-01-30"]
    assert first.previous_unit_value is None and first.day_return is None
    assert rows["a", NONE, "2026-02-02"].day_return == pytest.approx(0.10)
    assert rows["a", NONE, "2026-02-03"].day_return == pytest.approx(-0.10)
    assert rows["a", NONE, "2026-05-04"].previous_unit_value == 99.0
    assert rows["b", "1", "2026-02-02"].day_return is None
    assert rows["b", NONE, "2026-02-03"].day_return is None
    assert rows["b", "1", "2026-02-02"].inflow == 2.0


def test_stored_rollup_gives_the_same_daily_returns(make_staged):
    staged = make_staged([("a", None, f"2026-0{m}-0{d}", m + d / 10) for m in (1, 2, 4) for d in (1, 2)])
    assert sorted(daily_returns(staged).collect()) == sorted(
        daily_returns(staged, month_rollup(staged)).collect()
    )


@pytest.mark.parametrize("monthly", [monthly_returns, lambda s: compound_daily(daily_returns(s))])
class TestMonthly:
    def test_compounds_and_counts_from_the_second_report(self, make_staged, monthly):
        rows = by_month(
            monthly(
                make_staged(
                    [
                        ("a", None, "2026-04-01", 100.0),
                        ("a", None, "2026-04-02", 101.0),
                        ("a", None, "2026-04-03", 102.0),
                        ("a", None, "2026-05-04", 51.0, 7e5, 3),
                    ]
                )
            )
        )
        april, may = rows["a", NONE, "2026-04-01"], rows["a", NONE, "2026-05-01"]
        assert (april.obs_days, may.obs_days) == (2, 1)
        assert april.month_return == pytest.approx(0.02)
        assert may.month_return == pytest.approx(-0.5)
        assert (may.month_end_net_assets, may.month_end_holders) == (7e5, 3)

    def test_series_of_one_report_has_no_month(self, make_staged, monthly):
        assert monthly(make_staged([("a", None, "2026-04-01", 1.0)])).collect() == []

    def test_month_of_only_the_first_report_drops_out(self, make_staged, monthly):
        rows = by_month(
            monthly(make_staged([("a", None, "2026-03-31", 1.0), ("a", None, "2026-04-01", 2.0)]))
        )
        assert list(rows) == [("a", NONE, "2026-04-01")]
        assert rows["a", NONE, "2026-04-01"].month_return == pytest.approx(1.0)

    def test_latest_known_attributes_describe_the_month(self, make_staged, monthly):
        rows = by_month(
            monthly(
                make_staged(
                    [
                        ("a", None, "2026-04-01", 1.0, 1.0, 1, "first"),
                        ("a", None, "2026-04-02", 1.0, 5.0, None, "x"),
                        ("a", None, "2026-04-03", 1.0, None, 4, None),
                        ("b", None, "2026-04-01", 1.0, 9.0, 9, "only on the first report"),
                        ("b", None, "2026-04-02", 1.0, None, None, None),
                    ]
                )
            )
        )
        a, b = rows["a", NONE, "2026-04-01"], rows["b", NONE, "2026-04-01"]
        assert (a.month_end_net_assets, a.month_end_holders, a.class_type) == (5.0, 4, "x")
        assert (b.month_end_net_assets, b.month_end_holders, b.class_type) == (None, None, None)

    def test_a_change_of_type_keeps_one_row(self, make_staged, monthly):
        rows = by_month(
            monthly(
                make_staged(
                    [("a", None, f"2026-04-0{d}", float(d), 1.0, 1, "xy"[d % 2]) for d in range(1, 6)]
                )
            )
        )
        assert rows["a", NONE, "2026-04-01"].obs_days == 4
        assert rows["a", NONE, "2026-04-01"].month_return == pytest.approx(4.0)

    def test_reports_of_one_day_are_kept_and_ordered_the_same_way(self, make_staged, monthly):
        reports = [("a", None, "2026-04-01", 1.0)] + [
            ("a", None, "2026-04-02", quote) for quote in (2.0, 4.0, 8.0)
        ]
        forward = monthly(make_staged(reports)).collect()
        backward = monthly(make_staged(reports[::-1]).repartition(3)).collect()
        assert forward[0].obs_days == 3
        assert forward[0].month_return == pytest.approx(backward[0].month_return)

    def test_against_brute_force(self, make_staged, monthly):
        draw = random.Random(7)
        series = {}
        for class_id in "abcdefgh":
            for subclass in (None, "1", "2"):
                start, days = day("2024-01-01"), {}
                for _ in range(draw.choice([1, 2, 40, 120])):
                    start += datetime.timedelta(days=draw.choice([1, 1, 1, 3, 20, 70]))
                    days[start] = draw.uniform(0.5, 2.0)
                series[class_id, subclass] = days
        staged = make_staged(
            [
                (c, s, when.isoformat(), quote)
                for (c, s), days in series.items()
                for when, quote in days.items()
            ]
        )
        expected = {}
        for (c, s), days in series.items():
            factors, previous = {}, None
            for when, quote in sorted(days.items()):
                if previous is not None:
                    month = when.replace(day=1).isoformat()
                    factors.setdefault((c, s or NONE, month), []).append(quote / previous)
                previous = quote
            expected |= {key: (len(f), math.prod(f) - 1) for key, f in factors.items()}
        rows = by_month(monthly(staged))
        assert rows.keys() == expected.keys()
        for key, (days, value) in expected.items():
            assert rows[key].obs_days == days
            assert rows[key].month_return == pytest.approx(value, abs=1e-9)


@pytest.mark.parametrize("chunk", [2, 1000])
def test_dense_months_are_cut_without_changing_the_result(make_staged, monkeypatch, chunk):
    from navloom.operators import returns

    monkeypatch.setattr(returns, "COPIES_PER_CHUNK", chunk)
    draw = random.Random(11)
    rows = []
    for class_id in "abc":
        for month in (1, 2, 4, 5):
            for _ in range(draw.choice([1, 3, 40])):
                report = (class_id, None, f"2026-{month:02d}-{draw.randint(1, 5):02d}",
                          draw.choice([1.0, 2.0, 4.0]), draw.choice([1e6, 2e6]))
                rows += [report] * draw.choice([1, 1, 5])
    staged = make_staged(rows)
    plain, cut = (
        sorted(map(str, daily_returns(staged, dense_month=limit).collect()))
        for limit in (10**6, 4)
    )
    assert len(plain) == len(rows)
    assert plain == cut


def test_equal_reports_follow_each_other(make_staged):
    staged = make_staged(
        [("a", None, "2026-01-30", 1.0)] + [("a", None, "2026-02-02", 2.0)] * 9
        + [("a", None, "2026-02-03", 3.0)]
    )
    found = sorted(
        (r.as_of.day, r.previous_unit_value or 0.0) for r in daily_returns(staged, dense_month=5).collect()
    )
    assert found == [(2, 1.0)] + [(2, 2.0)] * 8 + [(3, 2.0), (30, 0.0)]


def test_daily_rows_add_up_to_monthly_days(make_staged):
    staged = make_staged(
        [(c, None, f"2026-{m:02d}-{d:02d}", d + 1.0) for c in "ab" for m in (1, 2, 3) for d in (1, 9)]
    )
    days = sum(r.obs_days for r in monthly_returns(staged).collect())
    assert days == daily_returns(staged).filter("day_return is not null").count() == 10
