"""A third of all rows under one key gives the same results as SQL."""

import os

import duckdb
import pytest

from navloom.operators import returns
from navloom_checks import queries as checks
from navloom_checks.oracle import SQL
from tests.test_queries import FOLDER, in_order

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """Test tables with a third of the lines moved to one supplier and one month."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    connection = duckdb.connect()
    connection.sql(
        f"""COPY (SELECT * REPLACE (
              CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey,
              CASE WHEN l_orderkey % 6 = 0 THEN TIMESTAMP '1997-03-01' + INTERVAL 1 DAY *
                   (l_partkey % 31) ELSE l_shipdate END AS l_shipdate)
            FROM '{FOLDER}/lineitem.parquet') TO '{folder}/lineitem.parquet'"""
    )
    connection.sql(f"COPY (FROM '{FOLDER}/orders.parquet') TO '{folder}/orders.parquet'")
    for name in ("lineitem", "orders"):
        connection.sql(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    return folder, connection


@pytest.mark.parametrize(
    "name",
    ["daily_return", "monthly_return", "class_dimension", "top_by_month", "month_kpis",
     "size_band_report", "return_histogram", "class_history", "quality_summary"],
)
def test_hot_supplier(spark, skewed, name):
    folder, connection = skewed
    frame = checks.QUERIES[name](spark, folder)
    columns = sorted(frame.columns)
    found = in_order(frame.select(*[f"`{c}`" for c in columns]).collect())
    wanted = in_order(
        connection.sql(SQL[name]).project(", ".join(f'"{c}"' for c in columns)).fetchall()
    )
    assert found == wanted


def test_hot_copies_of_one_report(spark, make_staged):
    reports = [("a", None, f"2026-01-{d:02d}", 1.0 + d / 10) for d in range(1, 11)]
    hot = make_staged(reports + [("hot", None, "2026-01-05", 3.0)])
    copies = hot.filter("class_id = 'hot'").selectExpr("*", "explode(sequence(1, 50000)) AS n")
    staged = hot.filter("class_id <> 'hot'").unionByName(copies.drop("n"))
    daily = returns.daily_returns(staged, dense_month=1000)
    assert daily.count() == 50_010
    assert daily.filter("class_id = 'hot' AND previous_unit_value IS NULL").count() == 1
    assert daily.filter("class_id = 'hot' AND day_return = 0").count() == 49_999
    monthly = {r.class_id: r for r in returns.monthly_returns(staged).collect()}
    assert (monthly["hot"].obs_days, monthly["hot"].month_return) == (49_999, 0.0)
    assert monthly["a"].month_return == pytest.approx(2.0 / 1.1 - 1)
    # The copies but the first describe the month.
    assert (monthly["hot"].month_end_net_assets, monthly["hot"].class_type) == (1e6, "FIF")


def test_copies_as_only_reports_describe_their_month(make_staged):
    once = make_staged([("a", None, "2026-01-05", 3.0), ("b", None, "2026-01-05", 2.0)])
    staged = once.unionByName(once.filter("class_id = 'a'"))
    straight = returns.monthly_returns(staged).collect()
    compounded = returns.compound_daily(returns.daily_returns(staged)).collect()
    assert [r.asDict() for r in straight] == [r.asDict() for r in compounded]
    assert [(r.class_id, r.class_type, r.month_end_holders) for r in straight] == [("a", "FIF", 10)]


@pytest.mark.parametrize("dense", [2, 1000])
def test_order_of_reports_that_differ_in_flows_only(spark, make_staged, dense):
    rows = make_staged([("a", None, "2026-01-04", 1.0), ("a", None, "2026-01-05", 2.0)])
    flows = rows.filter("unit_value = 2.0").drop("inflow").selectExpr(
        "*", "explode(array(3.0D, 0.0D, 2.0D, 1.0D)) AS inflow"
    )
    staged = rows.filter("unit_value = 1.0").unionByName(flows)
    firsts = set()
    for parts in (1, 3, 4):
        daily = returns.daily_returns(staged.repartition(parts), dense_month=dense)
        firsts.add(daily.filter("previous_unit_value = 1.0").first().inflow)
    assert firsts == {0.0}
