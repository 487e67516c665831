"""Dimension, monthly fact and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navloom.fixed_values import MIN_DAYS, MIN_HOLDERS, MIN_NET_ASSETS, TOP_N
from navloom.functions.measures import latest, surrogate_key, to_pct
from navloom.operators.returns import SERIES, day_of_order, month_rollup


def class_dimension(staged: DataFrame) -> DataFrame:
    """One row per series with its first and last day and its latest known attributes."""
    return dimension_of_rollup(month_rollup(staged))


def dimension_of_rollup(rollup: DataFrame) -> DataFrame:
    per_series = rollup.groupBy(*SERIES).agg(
        latest(F.col("class_type"), F.col("class_type_order")).alias("class_type"),
        day_of_order(F.min("first_order")).alias("first_day"),
        day_of_order(F.max("last_order")).alias("last_day"),
        F.max_by("net_assets", "net_assets_order").alias("net_assets"),
        F.max_by("holders", "holders_order").alias("holders"),
    )
    return per_series.select(
        surrogate_key(F.col("class_id"), F.col("subclass_id")).alias("class_key"), "*"
    )


def monthly_fact(monthly: DataFrame, dimension: DataFrame) -> DataFrame:
    """Monthly returns joined to their dimension row, with a key of their own."""
    keys = dimension.select("class_key", *SERIES)
    return monthly.join(keys, SERIES, "inner").select(
        surrogate_key(F.col("class_id"), F.col("subclass_id"), F.col("month")).alias(
            "return_key"
        ),
        "class_key",
        *SERIES,
        "class_type",
        "month",
        "obs_days",
        "month_return",
        "month_end_net_assets",
        "month_end_holders",
    )


def top_by_month(
    fact: DataFrame,
    top_n: int = TOP_N,
    min_days: int = MIN_DAYS,
    min_net_assets: float = MIN_NET_ASSETS,
    min_holders: int = MIN_HOLDERS,
) -> DataFrame:
    """The ``top_n`` eligible series of each month by return; ties go by key.

    The rank filter sits directly on the window, so every task passes on at most
    ``top_n`` rows per month and a crowded month is no more work than another.
    """
    eligible = fact.filter(
        (F.col("obs_days") >= min_days)
        & (F.col("month_end_net_assets") >= min_net_assets)
        & (F.col("month_end_holders") >= min_holders)
    )
    by_return = Window.partitionBy("month").orderBy(
        F.desc_nulls_last("month_return"), F.asc("class_id"), F.asc("subclass_id")
    )
    ranked = eligible.withColumn("rank", F.row_number().over(by_return)).filter(
        F.col("rank") <= top_n
    )
    return ranked.select(
        "month",
        F.col("rank").cast("bigint").alias("rank"),
        *SERIES,
        "class_type",
        "obs_days",
        "month_return",
        to_pct(F.col("month_return")).alias("return_pct"),
        "month_end_net_assets",
        "month_end_holders",
    )


def in_mart_order(top: DataFrame) -> DataFrame:
    """Newest month first, then by rank."""
    return top.orderBy(F.desc("month"), F.asc("rank"))
