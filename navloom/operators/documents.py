"""Nested documents: one per series, one per ranking month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.functions.measures import to_pct


def series_documents(history: DataFrame) -> DataFrame:
    """Per series an array of month records, in month order.

    A series has one row per month, which bounds the array.
    """
    record = F.struct(
        "month",
        "month_return",
        to_pct(F.col("month_return")).alias("return_pct"),
        "obs_days",
        "month_end_net_assets",
        "month_end_holders",
    )
    return history.groupBy("class_id", "subclass_id").agg(
        F.min("class_type").alias("class_type"),
        F.array_sort(F.collect_list(record)).alias("series"),
    )


def ranking_documents(top: DataFrame) -> DataFrame:
    """Per month the number of ranked series and their records, by rank.

    The ranking holds a fixed number of rows per month, which bounds the array.
    """
    record = F.struct(
        "rank",
        "class_id",
        "class_type",
        "return_pct",
        "obs_days",
        "month_end_net_assets",
        "month_end_holders",
    )
    return top.groupBy("month").agg(
        F.count("*").alias("total"),
        F.array_sort(F.collect_list(record)).alias("ranking"),
    )
