import pytest

from navloom.operators.staging import stage_reports
from navloom.plans import warehouse
from navloom.sources import shared
from tests.conftest import NONE


@pytest.fixture(scope="session")
def built(spark, make_staged):
    staged = make_staged(
        [
            (c, None, f"2026-0{m}-{d:02d}", d + ord(c) / 1000)
            for c in "abc" for m in (1, 2, 3) for d in range(1, 21)
        ]
    )
    root = shared.new_folder(spark, "test-marts")
    return root, staged, warehouse.build_marts(staged, root)


def test_marts_are_built_from_one_rollup(built):
    _, _, marts = built
    assert {n: t.count() for n, t in marts.items()} == {"dimension": 3, "fact": 9, "top": 9}


def test_rebuilding_in_place_changes_nothing(spark, built):
    _, staged, _ = built
    root = shared.new_folder(spark, "rebuilt")
    first, second = (
        {name: sorted(map(str, table.collect())) for name, table in marts.items()}
        for marts in (warehouse.build_marts(staged, root) for _ in range(2))
    )
    assert first == second


def test_fact_is_pruned_by_month(built):
    _, _, marts = built
    april = marts["fact"].filter("month = date'2026-02-01'").select("class_id", "month_return")
    assert april.count() == 3
    plan = april._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert "ReadSchema: struct<class_id:string,month_return:double>" in plan


def test_published_tables_and_inventory(spark, built):
    _, _, marts = built
    root = shared.new_folder(spark, "published")
    published = warehouse.publish(marts, root)
    rows = {r.table: r for r in warehouse.table_inventory(published).collect()}
    assert {n: (r["rows"], r.months) for n, r in rows.items()} == {
        "dimension": (3, None), "fact": (9, 3), "top": (9, 3),
    }
    assert str(rows["fact"].newest_month) == "2026-03-01"
    size = warehouse.stored_size(spark, root).first()
    assert size.files >= 5 and size.size_mb >= 0
    assert {n: t.count() for n, t in warehouse.read_marts(spark, root).items()} == {
        "dimension": 3, "fact": 9, "top": 9,
    }


def test_inventory_of_tables_that_are_not_stored(make_staged, small_fact):
    from navloom.operators.marts import top_by_month

    staged = make_staged([("one", None, f"2026-06-1{d}", 20.0 - d) for d in range(5)])
    dimension = small_fact.select("class_key", "class_id", "subclass_id").distinct()
    tables = {"staged": staged, "dimension": dimension, "fact": small_fact,
              "top": top_by_month(small_fact)}
    rows = {r.table: r["rows"] for r in warehouse.table_inventory(tables).collect()}
    assert (rows["staged"], rows["dimension"], rows["fact"]) == (5, 2, 4)


def test_marts_of_series_with_one_report_each(spark, make_staged):
    staged = make_staged([("one", None, "2026-06-11", 20.0), ("two", None, "2026-06-12", 3.0)])
    root = shared.new_folder(spark, "no-facts")
    marts = warehouse.build_marts(staged, root)
    assert {n: t.count() for n, t in marts.items()} == {"dimension": 2, "fact": 0, "top": 0}
    again = warehouse.read_marts(spark, root)
    assert again["fact"].schema == marts["fact"].schema and again["top"].count() == 0


def test_missing_warehouse_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warehouse.stored_size(spark, str(tmp_path / "nothing"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warehouse.read_marts(spark, str(tmp_path / "nothing"))


def test_catalog_tables_and_views(spark, built):
    _, _, marts = built
    warehouse.save_tables({"fact": marts["fact"]}, "core_test")
    warehouse.save_tables({"fact": marts["fact"]}, "core_test")
    assert spark.table("core_test.fact").count() == 9
    warehouse.register_views({"fact_view": marts["fact"]})
    assert spark.sql(
        "SELECT count(*) AS n FROM fact_view WHERE class_id = :id", args={"id": "a"}
    ).first().n == 3
    spark.sql("DROP DATABASE core_test CASCADE")


def test_inline_reports(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES
           ('KIND A', 'zeta', CAST(NULL AS STRING), DATE'2026-07-02', 1D, 8D, 1D, 0D, 0D, 1L),
           ('KIND A', 'zeta', NULL, DATE'2026-07-03', 1D, 10D, 1D, 0D, 0D, 1L)
           AS raw(TP_FUNDO_CLASSE, CNPJ_FUNDO_CLASSE, ID_SUBCLASSE, DT_COMPTC, VL_TOTAL,
                  VL_QUOTA, VL_PATRIM_LIQ, CAPTC_DIA, RESG_DIA, NR_COTST)"""
    )
    from navloom.operators.returns import monthly_returns

    row = monthly_returns(stage_reports(rows)).first()
    assert (row.subclass_id, row.obs_days) == (NONE, 1)
    assert row.month_return == pytest.approx(0.25)


class _Elsewhere:
    """A session on a cluster, as far as the choice of a folder looks at one."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_shared_folder(spark):
    assert shared.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared.new_folder(spark, "x") != shared.new_folder(spark, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(_Elsewhere)
