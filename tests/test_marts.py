import hashlib

from pyspark.sql import functions as F

from navloom.functions.measures import surrogate_key, surrogate_key_null_safe
from navloom.operators.marts import class_dimension, in_mart_order, monthly_fact, top_by_month
from navloom.operators.returns import monthly_returns
from tests.conftest import NONE, day


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_both_key_forms(spark):
    row = spark.createDataFrame(
        [("a", None, day("2026-04-01"))], "x string, y string, d date"
    ).select(
        surrogate_key(F.col("x"), F.col("d")).alias("plain"),
        surrogate_key(F.col("x"), F.col("y")).alias("with_null"),
        surrogate_key_null_safe(F.col("x"), F.col("y")).alias("safe"),
    ).first()
    assert row.plain == md5("a|2026-04-01")
    assert row.with_null is None
    assert row.safe == md5("a-_dbt_utils_surrogate_key_null_")


def test_dimension_takes_the_latest_known_values(make_staged):
    staged = make_staged(
        [
            ("a", None, "2026-03-31", 1.0, 10.0, 1, "old"),
            ("a", None, "2026-04-01", 1.0, 20.0, None, "new"),
            ("a", None, "2026-05-02", 1.0, None, 3, None),
            ("a", "1", "2026-01-02", 1.0, -5.0, 0, None),
        ]
    )
    rows = {r.subclass_id: r for r in class_dimension(staged).collect()}
    assert rows.keys() == {NONE, "1"}
    whole = rows[NONE]
    assert whole.class_key == md5(f"a|{NONE}")
    assert (whole.first_day, whole.last_day) == (day("2026-03-31"), day("2026-05-02"))
    assert (whole.net_assets, whole.holders, whole.class_type) == (20.0, 3, "new")
    assert (rows["1"].net_assets, rows["1"].holders, rows["1"].class_type) == (-5.0, 0, None)


def test_days_before_1970_survive_the_packed_order(make_staged):
    row = class_dimension(
        make_staged([("a", None, "1969-12-30", 1.0), ("a", None, "1970-01-02", 2.0)])
    ).first()
    assert (row.first_day, row.last_day) == (day("1969-12-30"), day("1970-01-02"))


def test_fact_joins_every_month_to_its_class(make_staged):
    staged = make_staged(
        [(c, s, f"2026-0{m}-0{d}", d + m / 10) for c in "ab" for s in (None, "1")
         for m in (1, 2) for d in (1, 2)]
    )
    monthly, dimension = monthly_returns(staged), class_dimension(staged)
    rows = monthly_fact(monthly, dimension).collect()
    assert len(rows) == monthly.count() == 8
    keys = {(r.class_id, r.subclass_id): r.class_key for r in dimension.collect()}
    for r in rows:
        assert r.class_key == keys[r.class_id, r.subclass_id]
        assert r.return_key == md5(f"{r.class_id}|{r.subclass_id}|{r.month}")


def test_fact_is_an_inner_join(make_staged):
    staged = make_staged([(c, None, f"2026-01-0{d}", 1.0) for c in "ab" for d in (1, 2)])
    only_a = class_dimension(staged).filter("class_id = 'a'")
    assert [r.class_id for r in monthly_fact(monthly_returns(staged), only_a).collect()] == ["a"]


def test_ranking_thresholds_include_their_value(make_fact):
    fact = make_fact(
        [
            ("in", NONE, "2026-04-01", 0.01, 15, 1e6, 5),
            ("days", NONE, "2026-04-01", 0.01, 14, 1e6, 5),
            ("assets", NONE, "2026-04-01", 0.01, 15, 999_999.0, 5),
            ("holders", NONE, "2026-04-01", 0.01, 15, 1e6, 4),
            ("unknown assets", NONE, "2026-04-01", 0.01, 15, None, 5),
            ("unknown holders", NONE, "2026-04-01", 0.01, 15, 1e6, None),
        ]
    )
    assert [r.class_id for r in top_by_month(fact).collect()] == ["in"]


def test_ranks_are_dense_and_ties_go_by_key(make_fact):
    months = ["2026-03-01", "2026-04-01"]
    fact = make_fact(
        [(f"c{i:03d}", s, m, (i // 3) / 100) for i in range(40) for s in ("1", "2") for m in months]
    ).repartition(4)
    rows = in_mart_order(top_by_month(fact, top_n=50)).collect()
    assert [r.month for r in rows] == [day("2026-04-01")] * 50 + [day("2026-03-01")] * 50
    for month in months:
        ranked = [r for r in rows if r.month == day(month)]
        assert [r["rank"] for r in ranked] == list(range(1, 51))
        order = [(-r.month_return, r.class_id, r.subclass_id) for r in ranked]
        assert order == sorted(order)
        assert ranked[0].return_pct == ranked[0].month_return * 100


def test_fewer_rows_than_the_limit(small_fact):
    rows = in_mart_order(top_by_month(small_fact)).collect()
    assert [(r.month.month, r["rank"]) for r in rows] == [(4, 1), (4, 2), (3, 1), (2, 1)]
