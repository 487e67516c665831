"""The derived reports: their rows, and where they lie."""

import datetime

from pyspark.sql import functions as F

from navloom.sources.lineitem_reports import lineitem_reports

LINES = (
    "l_suppkey bigint, l_linestatus string, l_shipdate timestamp, l_extendedprice double,"
    " l_discount double, l_tax double, l_quantity double"
)


def _lines(spark, tmp_path):
    start = datetime.datetime(1996, 1, 1)
    rows = [
        (supplier, status, start + datetime.timedelta(days=day), 10.0 + day, 0.01, 0.0, 5.0)
        for supplier in (1, 2, None) for status in ("F", "O", None) for day in range(60)
    ]
    rows += [(1, "F", start, 99.0, 0.0, 0.02, 7.0), (1, "F", None, 3.0, 0.0, 0.0, 1.0)]
    spark.createDataFrame(rows, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    return lineitem_reports(spark, str(tmp_path))


def test_lines_of_a_day_become_one_report(spark, tmp_path):
    reports = _lines(spark, tmp_path)
    # "O" and no status are one subclass; a line without a day is a report of its own.
    assert reports.count() == 3 * 2 * 60 + 1
    first = reports.filter("CNPJ_FUNDO_CLASSE = '1' AND ID_SUBCLASSE = 'F' AND DT_COMPTC = '1996-01-01'")
    row = first.first()
    assert (row.VL_QUOTA, row.CAPTC_DIA, row.RESG_DIA, row.NR_COTST) == (99.0, 7.0, 5.0, 2)


def test_a_month_of_a_series_lies_in_one_partition(spark, tmp_path):
    """So that tasks which read stored reports combine them to one row per month."""
    key, before = "spark.sql.adaptive.enabled", spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set(key, "false")
    try:
        placed = _lines(spark, tmp_path).withColumn("task", F.spark_partition_id())
        month = F.trunc("DT_COMPTC", "month")
        spread = placed.groupBy("CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", month).agg(
            F.count_distinct("task").alias("tasks")
        )
        assert [row.tasks for row in spread.collect()] == [1] * spread.count()
        # Lines move as they are: no table of nearly all lines of a scan task is built.
        plan = placed._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Exchange hashpartitioning"):]
        assert "HashAggregate" not in below
    finally:
        spark.conf.set(key, before)
