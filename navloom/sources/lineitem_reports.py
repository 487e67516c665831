"""Report rows derived from the ``lineitem`` test table.

One report per supplier, line status and ship day. Every value is exact in doubles
(maxima, minima and integer sums), so that any engine gets the same reports.

Hardly two lines make one report, so combining lines before they move would hold nearly
every line of a scan task in its hash table and save nothing. They move as they are, by
series and month: a task then has whole months of a series, so that what is stored from
here combines well per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.functions.calendar import month_of


def lineitem_reports(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_suppkey",
        F.nullif("l_linestatus", F.lit("O")).alias("ID_SUBCLASSE"),
        day.alias("DT_COMPTC"),
        month_of(day).alias("month"),
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_quantity",
    )
    supplier = F.col("l_suppkey")
    scale = F.pow(F.lit(10.0), 4 + supplier % 6).cast("bigint")
    block = ["l_suppkey", "ID_SUBCLASSE", "month"]
    reports = lines.repartition(*block).groupBy(*block, "DT_COMPTC").agg(
        F.max("l_extendedprice").alias("price"),
        F.max("l_discount").alias("discount"),
        F.max("l_tax").alias("tax"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.max("l_quantity").alias("CAPTC_DIA"),
        F.min("l_quantity").alias("RESG_DIA"),
        F.count("*").alias("NR_COTST"),
    )
    unpriced = (F.col("discount") == 0) & (F.col("tax") == 0)
    return reports.select(
        F.when(supplier % 2 == 0, "EVEN").otherwise("ODD").alias("TP_FUNDO_CLASSE"),
        supplier.cast("string").alias("CNPJ_FUNDO_CLASSE"),
        "ID_SUBCLASSE",
        "DT_COMPTC",
        (F.col("price") * 1000).alias("VL_TOTAL"),
        F.when(unpriced, 0.0).otherwise(F.col("price")).alias("VL_QUOTA"),
        ((F.col("quantity") - 3) * scale).cast("double").alias("VL_PATRIM_LIQ"),
        "CAPTC_DIA",
        "RESG_DIA",
        "NR_COTST",
    )


def orders_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    """A benchmark rate per month from the ``orders`` table; Decembers have none."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    month = month_of(F.col("o_orderdate").cast("date")).alias("month")
    return (
        orders.filter(F.month("o_orderdate") != 12)
        .groupBy(month)
        .agg(((F.count("*") % 9) / 4).alias("benchmark_pct"))
    )
