"""Returns against a monthly benchmark rate."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navloom.fixed_values import (
    BENCHMARK_DEFAULT_PCT,
    BENCHMARK_PCT,
    NO_SUBCLASS_LABEL,
    NO_TYPE_LABEL,
)
from navloom.functions.measures import above_or_below, to_pct
from navloom.operators.returns import SERIES


def default_benchmark(spark: SparkSession) -> DataFrame:
    """The published monthly rates: ``month``, ``benchmark_pct``."""
    rows = [(datetime.date.fromisoformat(day), pct) for day, pct in BENCHMARK_PCT.items()]
    return spark.createDataFrame(rows, "month date, benchmark_pct double")


def with_benchmark(
    rows: DataFrame, benchmark: DataFrame, default: float = BENCHMARK_DEFAULT_PCT
) -> DataFrame:
    """Add ``benchmark_pct`` by ``month``; months without a rate get ``default``.

    Rates are brought to one per month first (the greatest, should a month have
    several), so the join never multiplies rows. That also bounds the broadcast:
    dates with four-digit years have fewer than 120,000 months.
    """
    rates = benchmark.groupBy("month").agg(F.max("benchmark_pct").alias("rate"))
    return (
        rows.join(F.broadcast(rates), "month", "left")
        .withColumn("benchmark_pct", F.coalesce("rate", F.lit(float(default))))
        .drop("rate")
    )


def top_against_benchmark(
    top: DataFrame, benchmark: DataFrame, default: float = BENCHMARK_DEFAULT_PCT
) -> DataFrame:
    """Ranking with the distance to the benchmark and the chart bound of each month."""
    in_month = Window.partitionBy("month")
    compared = with_benchmark(top, benchmark, default)
    return compared.select(
        "month",
        "rank",
        *SERIES,
        "return_pct",
        "benchmark_pct",
        (F.col("return_pct") - F.col("benchmark_pct")).alias("delta_pct"),
        F.greatest(
            F.max("return_pct").over(in_month), F.col("benchmark_pct") * 1.5
        ).alias("chart_bound_pct"),
    )


def cumulative_vs_benchmark(
    fact: DataFrame, benchmark: DataFrame, default: float = BENCHMARK_DEFAULT_PCT
) -> DataFrame:
    """Running compounded return of every series beside that of the benchmark."""
    to_date = (
        Window.partitionBy(*SERIES)
        .orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    monthly = with_benchmark(
        fact.select(
            *SERIES,
            "class_type",
            "month",
            to_pct(F.col("month_return")).alias("return_pct"),
            "month_end_net_assets",
            "month_end_holders",
        ),
        benchmark,
        default,
    )
    running = monthly.select(
        "*",
        (F.product(1 + F.col("return_pct") / 100).over(to_date) - 1).alias("cumulative"),
        (F.product(1 + F.col("benchmark_pct") / 100).over(to_date) - 1).alias(
            "benchmark_cumulative"
        ),
    )
    return running.select(
        "*",
        to_pct(F.col("cumulative") - F.col("benchmark_cumulative")).alias("delta_cumulative_pp"),
        above_or_below(F.col("return_pct"), F.col("benchmark_pct")).alias("month_position"),
        above_or_below(F.col("cumulative"), F.col("benchmark_cumulative")).alias(
            "cumulative_position"
        ),
    )


def series_kpis(cumulative: DataFrame, default_type: str = NO_TYPE_LABEL) -> DataFrame:
    """Per series: accumulated returns, best and worst month, volatility and verdict."""
    kpis = cumulative.groupBy(
        "class_id", F.coalesce("subclass_id", F.lit(NO_SUBCLASS_LABEL)).alias("subclass_id")
    ).agg(
        F.coalesce(F.min("class_type"), F.lit(default_type)).alias("class_type"),
        F.count("*").alias("months"),
        to_pct(F.max_by("cumulative", "month")).alias("cumulative_pct"),
        to_pct(F.max_by("benchmark_cumulative", "month")).alias("benchmark_cumulative_pct"),
        F.max_by("delta_cumulative_pp", "month").alias("delta_cumulative_pp"),
        F.max("return_pct").alias("best_month_pct"),
        F.min("return_pct").alias("worst_month_pct"),
        F.stddev_pop("return_pct").alias("volatility_pct"),
    )
    return kpis.withColumn(
        "verdict",
        above_or_below(F.col("cumulative_pct"), F.col("benchmark_cumulative_pct")),
    )


def report_table(cumulative: DataFrame) -> DataFrame:
    """Month-by-month table of a series: label, returns, accumulated distance, size."""
    return cumulative.select(
        *SERIES,
        F.date_format("month", "yyyy-MM").alias("month_label"),
        "return_pct",
        "benchmark_pct",
        "delta_cumulative_pp",
        "month_end_net_assets",
        "month_end_holders",
    )
