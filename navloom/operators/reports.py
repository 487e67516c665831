"""Market reports, listings and histories read from the marts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.fixed_values import (
    BENCHMARK_DEFAULT_PCT,
    HISTOGRAM_BINS,
    HISTOGRAM_HIGH,
    HISTOGRAM_LOW,
    MIN_DAYS,
    TOP_N,
)
from navloom.functions.measures import (
    histogram_bin,
    share_pct,
    size_band_name,
    size_band_no,
    to_pct,
)
from navloom.operators.benchmark import with_benchmark
from navloom.operators.median import exact_median
from navloom.operators.returns import SERIES


def as_month(month: str | datetime.date) -> datetime.date:
    """The month as a date; raises ``ValueError`` when it is none."""
    return month if isinstance(month, datetime.date) else datetime.date.fromisoformat(month)


def checked_limit(limit: int, most: int = TOP_N) -> int:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must lie between 1 and {most}, not {limit}")
    return limit


def _of_month(rows: DataFrame, month: str | datetime.date | None) -> DataFrame:
    return rows if month is None else rows.filter(F.col("month") == F.lit(as_month(month)))


def market_snapshot(
    fact: DataFrame, min_days: int = MIN_DAYS, month: str | datetime.date | None = None
) -> DataFrame:
    """Series with positive net assets and enough days, with the return in percent."""
    return (
        _of_month(fact, month)
        .filter((F.col("month_end_net_assets") > 0) & (F.col("obs_days") >= min_days))
        .select("month", "month_end_net_assets", to_pct(F.col("month_return")).alias("return_pct"))
    )


def months_desc(fact: DataFrame) -> DataFrame:
    """Months with data, newest first."""
    return fact.select("month").distinct().orderBy(F.desc("month"))


def newest_month(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("month").alias("month"))


def month_kpis(
    fact: DataFrame,
    benchmark: DataFrame,
    min_days: int = MIN_DAYS,
    month: str | datetime.date | None = None,
    default: float = BENCHMARK_DEFAULT_PCT,
) -> DataFrame:
    """Per month: series, net assets, median return, share at or above the benchmark.

    With ``month`` given there is exactly one row, of zeros if nothing qualifies.
    """
    snapshot = market_snapshot(fact, min_days, month)
    compared = with_benchmark(snapshot, benchmark, default)
    totals = compared.groupBy("month", "benchmark_pct").agg(*_totals())
    medians = exact_median(snapshot, ["month"], "return_pct", "median_return_pct", few_groups=True)
    kpis = totals.join(F.broadcast(medians), "month").select(
        "month",
        "benchmark_pct",
        "series_count",
        "net_assets",
        "median_return_pct",
        "share_above_pct",
    )
    if month is not None:
        wanted = fact.sparkSession.range(1).select(F.lit(as_month(month)).alias("month"))
        kpis = with_benchmark(
            wanted.join(kpis.drop("benchmark_pct"), "month", "left"), benchmark, default
        )
    return kpis.select(
        "month",
        "benchmark_pct",
        F.coalesce("series_count", F.lit(0)).cast("bigint").alias("series_count"),
        *[
            F.coalesce(name, F.lit(0.0)).alias(name)
            for name in ("net_assets", "median_return_pct", "share_above_pct")
        ],
    ).select(
        "*",
        (F.col("median_return_pct") - F.col("benchmark_pct")).alias("median_delta_pct"),
        (F.col("share_above_pct") - 50.0).alias("share_delta_pct"),
    )


def size_band_report(
    fact: DataFrame,
    benchmark: DataFrame,
    min_days: int = MIN_DAYS,
    month: str | datetime.date | None = None,
    default: float = BENCHMARK_DEFAULT_PCT,
) -> DataFrame:
    """The same figures per month and size band; order by ``month``, ``band_no``."""
    banded = market_snapshot(fact, min_days, month).withColumn(
        "band_no", size_band_no(F.col("month_end_net_assets"))
    )
    keys = ["month", "band_no"]
    totals = with_benchmark(banded, benchmark, default).groupBy(*keys).agg(*_totals())
    medians = exact_median(banded, keys, "return_pct", "median_return_pct", few_groups=True)
    return totals.join(F.broadcast(medians), keys).select(
        "month",
        "band_no",
        size_band_name(F.col("band_no")).alias("band"),
        "series_count",
        "net_assets",
        "median_return_pct",
        "share_above_pct",
    )


def _totals() -> list[Column]:
    return [
        F.count("*").alias("series_count"),
        F.sum("month_end_net_assets").alias("net_assets"),
        share_pct(F.col("return_pct") >= F.col("benchmark_pct")).alias("share_above_pct"),
    ]


def return_distribution(
    fact: DataFrame,
    low: float = HISTOGRAM_LOW,
    high: float = HISTOGRAM_HIGH,
    min_days: int = MIN_DAYS,
    month: str | datetime.date | None = None,
) -> DataFrame:
    """Monthly returns in percent that lie within ``[low, high]``, edges included."""
    snapshot = market_snapshot(fact, min_days, month)
    return snapshot.filter(F.col("return_pct").between(low, high)).select("month", "return_pct")


def distribution_median(distribution: DataFrame) -> DataFrame:
    """Median of :func:`return_distribution` per month."""
    return exact_median(
        distribution, ["month"], "return_pct", "median_return_pct", few_groups=True
    )


def return_histogram(
    fact: DataFrame,
    low: float = HISTOGRAM_LOW,
    high: float = HISTOGRAM_HIGH,
    bins: int = HISTOGRAM_BINS,
    min_days: int = MIN_DAYS,
    month: str | datetime.date | None = None,
) -> DataFrame:
    """Rows per month and bin of :func:`return_distribution`, empty bins included."""
    counted = (
        return_distribution(fact, low, high, min_days, month)
        .groupBy("month", histogram_bin(F.col("return_pct"), low, high, bins).alias("bin"))
        .agg(F.count("*").alias("rows"))
    )
    # At most ``bins`` entries per month, so a month's bins fit in one small map.
    by_month = counted.groupBy("month").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("bin").cast("int"), "rows"))).alias(
            "filled"
        )
    )
    every_bin = by_month.select(
        "month", "filled", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    )
    width = (high - low) / bins
    return every_bin.select(
        "month",
        F.col("bin").cast("bigint").alias("bin"),
        (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("lower_edge"),
        F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0)).alias("rows"),
    )


def top_of_month(
    top: DataFrame, month: str | datetime.date, limit: int = 10, most: int = TOP_N
) -> DataFrame:
    """First ``limit`` ranks of a month, by rank; ``most`` is the size of the ranking."""
    n = checked_limit(limit, most)
    return _of_month(top, as_month(month)).filter(F.col("rank") <= n).orderBy("rank")


def top_of_newest_month(top: DataFrame, limit: int = 10, most: int = TOP_N) -> DataFrame:
    n = checked_limit(limit, most)
    newest = F.broadcast(newest_month(top))
    return top.join(newest, "month", "left_semi").filter(F.col("rank") <= n).orderBy("rank")


def ranking_report(ranked: DataFrame) -> DataFrame:
    """The columns of a ranking that its readers are shown."""
    return ranked.select(
        "month",
        "rank",
        "class_id",
        "class_type",
        "return_pct",
        "obs_days",
        "month_end_net_assets",
        "month_end_holders",
    )


def global_top(top: DataFrame, n: int = 10) -> DataFrame:
    """First rows of the ranking in mart order."""
    return top.orderBy(F.desc("month"), F.asc("rank")).limit(n)


def class_search(
    fact: DataFrame,
    month: str | datetime.date | None = None,
    prefix: str | None = None,
    limit: int = 50,
) -> DataFrame:
    """First ``limit`` class ids, in order, seen in ``month`` (default: the newest).

    ``prefix`` is a LIKE pattern to which ``%`` is added: ``%`` and ``_`` in it match
    any text.
    """
    if month is None:
        seen = fact.join(F.broadcast(newest_month(fact)), "month", "left_semi")
    else:
        seen = _of_month(fact, month)
    if prefix:
        seen = seen.filter(F.col("class_id").like(f"{prefix}%"))
    return seen.select("class_id").distinct().orderBy("class_id").limit(limit)


def first_subclasses(fact: DataFrame) -> DataFrame:
    """Per class the subclass with the earliest month, the least by name among equals.

    Facts are combined to one row per series first, in hash aggregation; the minimum of
    pairs, which sorts, then runs on those.
    """
    series = fact.groupBy(*SERIES).agg(F.min("month").alias("month"))
    return series.groupBy("class_id").agg(
        F.min(F.struct("month", "subclass_id"))["subclass_id"].alias("subclass_id")
    )


def class_history(
    fact: DataFrame, class_id: str | None = None, subclass_id: str | None = None
) -> DataFrame:
    """Monthly series of a class in order of month, or of every class, unordered.

    Without ``subclass_id`` a class is represented by its first subclass.
    """
    rows = fact if class_id is None else fact.filter(F.col("class_id") == class_id)
    if subclass_id is not None:
        rows = rows.filter(F.col("subclass_id") == subclass_id)
    else:
        rows = rows.join(first_subclasses(rows), SERIES, "left_semi")
    history = rows.select(
        *SERIES,
        "class_type",
        "month",
        "month_return",
        to_pct(F.col("month_return")).alias("return_pct"),
        "obs_days",
        "month_end_net_assets",
        "month_end_holders",
    )
    return history if class_id is None else history.orderBy(*SERIES, "month")
