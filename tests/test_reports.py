import pytest

from navloom.operators import reports
from tests.conftest import NONE, day

APRIL = "2026-04-01"


@pytest.fixture(scope="session")
def rates(spark):
    return spark.createDataFrame([(day(APRIL), 2.0)], "month date, benchmark_pct double")


@pytest.fixture(scope="session")
def top(small_fact):
    from navloom.operators.marts import top_by_month

    return top_by_month(small_fact)


def test_top_of_month(top):
    rows = reports.top_of_month(top, APRIL).collect()
    assert [(r["rank"], r.class_id) for r in rows] == [
        (1, "two"),
        (2, "one"),
    ]
    assert rows[0].return_pct == pytest.approx(4.6)
    assert reports.top_of_month(top, APRIL, 1).count() == 1
    assert reports.top_of_month(top, day(APRIL)).count() == 2
    assert reports.top_of_month(top, "1999-01-01").count() == 0
    assert reports.top_of_newest_month(top, 1).first().return_pct == pytest.approx(4.6)
    assert reports.global_top(top, 3).count() == 3


@pytest.mark.parametrize("limit", [0, 51, -1])
def test_limit_is_checked(top, limit):
    with pytest.raises(ValueError):
        reports.top_of_month(top, APRIL, limit)


def test_month_is_checked(top):
    with pytest.raises(ValueError):
        reports.top_of_month(top, "April")


def test_months(small_fact):
    assert [r.month.month for r in reports.months_desc(small_fact).collect()] == [4, 3, 2]
    assert reports.newest_month(small_fact).first().month == day(APRIL)


def test_kpis(make_fact, rates):
    fact = make_fact(
        [
            ("a", NONE, APRIL, 0.01, 15, 1e6),
            ("b", NONE, APRIL, 0.02, 15, 2e6),
            ("c", NONE, APRIL, 0.04, 15, 3e6),
            ("few days", NONE, APRIL, 9.0, 14, 1e6),
            ("no assets", NONE, APRIL, 9.0, 15, 0.0),
            ("debts", NONE, APRIL, 9.0, 15, -1.0),
            ("unknown", NONE, APRIL, 9.0, 15, None),
            ("a", NONE, "2026-03-01", 0.012, 15, 5e6),
        ]
    )
    rows = {r.month.month: r for r in reports.month_kpis(fact, rates).collect()}
    april, march = rows[4], rows[3]
    assert (april.series_count, april.net_assets) == (3, 6e6)
    assert april.median_return_pct == pytest.approx(2.0)
    assert april.share_above_pct == pytest.approx(200 / 3)
    assert april.median_delta_pct == pytest.approx(0.0)
    assert april.share_delta_pct == pytest.approx(200 / 3 - 50)
    assert march.benchmark_pct == 1.10
    assert march.share_above_pct == pytest.approx(100.0)
    assert reports.month_kpis(fact, rates, month=APRIL).collect() == [april]


def test_kpis_of_an_empty_month_are_zero(small_fact, rates):
    row = reports.month_kpis(small_fact, rates, month="1999-01-01").first()
    assert row.month == day("1999-01-01") and row.benchmark_pct == 1.10
    assert (row.series_count, row.net_assets, row.median_return_pct, row.share_above_pct) == (
        0, 0.0, 0.0, 0.0,
    )


def test_size_bands_have_exclusive_upper_bounds(make_fact, rates):
    amounts = [0.01, 999_999.99, 1e6, 9_999_999.0, 1e7, 1e8, 1e9, 5e12]
    fact = make_fact(
        [(f"c{i}", NONE, APRIL, i / 100, 20, a) for i, a in enumerate(amounts)]
    )
    rows = reports.size_band_report(fact, rates).orderBy("band_no").collect()
    assert [(r.band_no, r.band, r.series_count) for r in rows] == [
        (1, "< R$ 1M", 2),
        (2, "R$ 1M – 10M", 2),
        (3, "R$ 10M – 100M", 1),
        (4, "R$ 100M – 1B", 1),
        (5, "> R$ 1B", 2),
    ]
    assert [r.median_return_pct for r in rows] == pytest.approx([0.5, 2.5, 4.0, 5.0, 6.5])
    assert [r.share_above_pct for r in rows] == pytest.approx([0, 100, 100, 100, 100])


def test_distribution_and_histogram_edges(make_fact):
    returns = [-0.1001, -0.10, -0.05, 0.0, 0.05, 0.10, 0.1001]
    fact = make_fact([(f"c{i}", NONE, APRIL, v) for i, v in enumerate(returns)])
    kept = sorted(r.return_pct for r in reports.return_distribution(fact).collect())
    assert kept == pytest.approx([-10.0, -5.0, 0.0, 5.0, 10.0])
    rows = reports.return_histogram(fact).orderBy("bin").collect()
    assert [r.bin for r in rows] == list(range(1, 61))
    assert {r.bin: r["rows"] for r in rows if r["rows"]} == {1: 1, 16: 1, 31: 1, 46: 1, 60: 1}
    assert rows[0].lower_edge == -10.0
    assert rows[59].lower_edge == pytest.approx(10 - 1 / 3)
    assert reports.distribution_median(reports.return_distribution(fact)).first()[1] == 0.0
    assert reports.return_histogram(fact, month="1999-01-01").count() == 0


def test_class_search(make_fact):
    fact = make_fact(
        [(c, s, APRIL, 0.1) for c in ("10", "11", "1_", "20") for s in ("1", "2")]
        + [("99", "1", "2026-03-01", 0.1)]
    )

    def found(**arguments):
        return [r.class_id for r in reports.class_search(fact, **arguments).collect()]

    assert found() == found(month=APRIL) == ["10", "11", "1_", "20"]
    assert found(prefix="1") == ["10", "11", "1_"]
    assert found(prefix="_0") == ["10", "20"]
    assert found(prefix="1", limit=2) == ["10", "11"]
    assert found(month="2026-03-01") == ["99"]
    assert found(month="1999-01-01") == []


def test_history_of_one_class(small_fact):
    rows = reports.class_history(small_fact, "one").collect()
    assert [r.month.month for r in rows] == [2, 3, 4]
    assert rows[0].return_pct == pytest.approx(3.1)
    assert reports.class_history(small_fact, "none such").count() == 0


def test_history_takes_the_first_subclass(make_fact):
    fact = make_fact(
        [
            ("a", "late", "2026-02-01", 0.1),
            ("a", "y", "2026-01-01", 0.2),
            ("a", "x", "2026-01-01", 0.3, 20, None, None),
            ("a", "x", "2026-03-01", 0.4),
            ("b", "z", "2026-01-01", 0.5),
        ]
    )
    whole = [(r.class_id, r.subclass_id, r.month.month) for r in reports.class_history(fact).collect()]
    assert sorted(whole) == [("a", "x", 1), ("a", "x", 3), ("b", "z", 1)]
    one = reports.class_history(fact, "a").collect()
    assert [r.month_return for r in one] == [0.3, 0.4]
    assert one[0].month_end_net_assets is None and one[0].month_end_holders is None
    assert [r.month_return for r in reports.class_history(fact, "a", "late").collect()] == [0.1]
