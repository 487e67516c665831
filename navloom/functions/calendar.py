"""Month arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def month_label(day: Column) -> Column:
    """Partition label ``YYYY-MM``."""
    return F.date_format(day, "yyyy-MM")


def period_code(day: Column) -> Column:
    """File period ``YYYYMM``."""
    return F.date_format(day, "yyyyMM")


def month_key(day: Column) -> Column:
    """Text of the first day of the month, ``YYYY-MM-01``."""
    return F.date_format(month_of(day), "yyyy-MM-dd")


def label_from_period(period: Column) -> Column:
    """``YYYYMM`` to ``YYYY-MM``."""
    return F.concat_ws("-", F.substring(period, 1, 4), F.substring(period, 5, 2))


def period_from_label(label: Column) -> Column:
    """``YYYY-MM`` to ``YYYYMM``."""
    return F.regexp_replace(label, "-", "")


def previous_month(day: Column) -> Column:
    """Period ``YYYYMM`` of the last complete month before ``day``."""
    return period_code(F.add_months(month_of(day), -1))


def months_between_inclusive(first: Column, last: Column) -> Column:
    """Array of month starts from ``first`` to ``last``; raises when reversed."""
    start, end = month_of(first), month_of(last)
    return F.when(
        end < start, F.raise_error(F.lit("the last month lies before the first"))
    ).otherwise(F.sequence(start, end, F.expr("interval 1 month")))


def month_spine(spark: SparkSession, first: str, last: str | None = None) -> DataFrame:
    """One row per month ``YYYY-MM`` from ``first`` to ``last``, both included."""
    last = last or first
    if last < first:
        raise ValueError(f"last month {last} lies before first month {first}")
    bounds = spark.range(1).select(
        F.to_date(F.lit(f"{first}-01")).alias("first"),
        F.to_date(F.lit(f"{last}-01")).alias("last"),
    )
    return spine_of(bounds)


def spine_of(bounds: DataFrame) -> DataFrame:
    """Month spine of a one-row DataFrame with the dates ``first`` and ``last``."""
    months = bounds.select(
        F.explode(months_between_inclusive(F.col("first"), F.col("last"))).alias("month")
    )
    return months.select("month", month_label(F.col("month")).alias("year_month"))
