"""Daily and monthly returns per series.

A series is ``(class_id, subclass_id)`` ordered by ``as_of``; reports of one day
are put in a fixed order by ``row_order``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.functions.calendar import month_of
from navloom.functions.measures import (
    change_ratio,
    latest,
    latest_order,
    subclass_or_none,
)

SERIES = ["class_id", "subclass_id"]
BLOCK = [*SERIES, "month"]
#: What a report holds besides its series and day.
VALUES = ["class_type", "unit_value", "net_assets", "holders", "inflow", "outflow"]
#: What describes a month as its latest known value.
DESCRIBING = ["class_type", "net_assets", "holders"]
DENSE_MONTH = 10_000_000
SLICE_BITS = 28
COPIES_PER_CHUNK = 1_000_000


def row_order() -> Column:
    """Position of a report in its series as one long: the day, then a hash.

    The hash only decides between reports of one series on one day, whose order
    is not given by the data; it makes reruns and retried tasks agree. Reports that
    share it agree in all that a position looks up (quote, type, net assets, holders),
    and :func:`_lag_with_carried` orders them by their values. Being a long, the
    position keeps ``max_by`` in hash aggregation.
    """
    tie = F.xxhash64("class_type", "unit_value", "net_assets", "holders")
    return F.shiftleft(F.unix_date("as_of").cast("bigint"), 40).bitwiseOR(
        F.shiftrightunsigned(tie, 24)
    )


def day_of_order(order: Column) -> Column:
    return F.date_from_unix_date(F.shiftright(order, 40).cast("int"))


def daily_returns(
    staged: DataFrame, rollup: DataFrame | None = None, dense_month: int = DENSE_MONTH
) -> DataFrame:
    """Each report with the quote before it in its series and the return on it.

    The series are cut into months, so that no task sorts more than a month of one
    series, however long the series is. For the first report of a month the last
    quote before it is carried over from the month rollup as an extra row ahead of
    that month, so one shuffle and one plain lag do for all.

    A month of a series has about 20 reports. Should one have more than
    ``dense_month``, as with copies of reports, it is cut further, see
    :func:`_dense_lag`. Without any, Spark drops that branch at run time.

    ``rollup`` is computed from ``staged`` unless a stored one is given, which is
    better: it is read twice.
    """
    reports = staged.select(
        "class_id",
        subclass_or_none(F.col("subclass_id")).alias("subclass_id"),
        "class_type",
        "as_of",
        "unit_value",
        "net_assets",
        "holders",
        "inflow",
        "outflow",
        month_of(F.col("as_of")).alias("month"),
        row_order().alias("row_order"),
    )
    rollup = month_rollup(staged) if rollup is None else rollup
    # At most one row per dense_month reports: a million in 10^13 reports.
    dense = F.broadcast(rollup.filter(F.col("reports") > dense_month).select(*BLOCK))
    in_series = Window.partitionBy(*SERIES).orderBy("month")
    carried = rollup.select(
        *SERIES,
        "unit_value",
        F.lead("month").over(in_series).alias("month"),
        F.lead("first_order").over(in_series).alias("first_order"),
    ).filter(F.col("month").isNotNull())
    lagged = _lag_with_carried(
        reports.join(dense, BLOCK, "left_anti"), carried.drop("first_order"), BLOCK
    ).unionByName(
        _dense_lag(
            reports.join(dense, BLOCK, "left_semi"), carried.join(dense, BLOCK, "left_semi")
        )
    )
    return lagged.select(
        *SERIES,
        "class_type",
        "as_of",
        "unit_value",
        "previous_unit_value",
        change_ratio(F.col("unit_value"), F.col("previous_unit_value")).alias("day_return"),
        "net_assets",
        "holders",
        "inflow",
        "outflow",
    )


def _lag_with_carried(reports: DataFrame, carried: DataFrame, group: list[str]) -> DataFrame:
    """Lag within groups; ``carried`` rows have no ``row_order`` and come first.

    The values themselves come last in the order: reports of one day that differ in flows
    only share ``row_order``, and its hash is short.
    """
    in_group = Window.partitionBy(*group).orderBy(F.asc_nulls_first("row_order"), *VALUES)
    return (
        reports.unionByName(carried, allowMissingColumns=True)
        .withColumn("previous_unit_value", F.lag("unit_value").over(in_group))
        .filter(F.col("row_order").isNotNull())
    )


def _dense_lag(reports: DataFrame, carried: DataFrame) -> DataFrame:
    """The same lag for months with very many reports of one series.

    Copies are counted instead of sorted and written out again at the end: the first
    of them follows the report before, each other one follows a copy of itself. What
    is left of a month is cut into slices of its order, by day and leading bits of
    the hash, with the last quote of each slice carried to the next.
    """
    slice_of = F.shiftright("row_order", SLICE_BITS)
    copied = (
        reports.groupBy(*reports.columns)
        .agg(F.count("*").alias("copies"))
        .withColumn("slice", slice_of)
    )
    group = [*BLOCK, "slice"]
    closings = copied.groupBy(*group).agg(F.max_by("unit_value", "row_order").alias("unit_value"))
    in_month = Window.partitionBy(*BLOCK).orderBy("slice")
    between_slices = closings.select(
        *BLOCK, "unit_value", F.lead("slice").over(in_month).alias("slice")
    ).filter(F.col("slice").isNotNull())
    into_month = carried.select(
        *BLOCK, "unit_value", F.shiftright("first_order", SLICE_BITS).alias("slice")
    )
    lagged = _lag_with_carried(copied, between_slices.unionByName(into_month), group)
    # Copies are written out in two steps, so that no task has to produce all of them.
    last = F.col("copies") - 1
    chunks = lagged.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), (last / COPIES_PER_CHUNK).cast("bigint")))
    ).repartition("class_id", "subclass_id", "row_order", "chunk")
    start = F.col("chunk") * COPIES_PER_CHUNK
    return chunks.withColumn(
        "copy", F.explode(F.sequence(start, F.least(start + (COPIES_PER_CHUNK - 1), last)))
    ).select(
        *reports.columns,
        F.when(F.col("copy") == 0, F.col("previous_unit_value"))
        .otherwise(F.col("unit_value"))
        .alias("previous_unit_value"),
    )


def compound_daily(daily: DataFrame) -> DataFrame:
    """Monthly returns from daily ones; days without a return do not count."""
    observed = daily.filter(F.col("day_return").isNotNull()).withColumn("row_order", row_order())
    by_type = observed.groupBy(
        *SERIES, month_of(F.col("as_of")).alias("month"), "class_type"
    ).agg(
        F.count("*").alias("obs_days"),
        F.sum(F.ln(1 + F.col("day_return"))).alias("log_return"),
        *_latest_columns(["net_assets", "holders"], F.col("row_order")),
        F.max("row_order").alias("type_order"),
    )
    merged = by_type.groupBy(*BLOCK).agg(
        latest(F.col("class_type"), F.col("type_order")).alias("class_type"),
        F.sum("obs_days").alias("obs_days"),
        (F.exp(F.sum("log_return")) - 1).alias("month_return"),
        *_latest_again(["net_assets", "holders"]),
    )
    return merged.select(
        *SERIES,
        "class_type",
        "month",
        "obs_days",
        "month_return",
        F.col("net_assets").alias("month_end_net_assets"),
        F.col("holders").alias("month_end_holders"),
    )


def month_rollup(staged: DataFrame) -> DataFrame:
    """One row per series and month: all that monthly returns and dimension need.

    Reports are combined before they are shuffled, with fixed-width buffers only,
    so the raw rows never move and a hot series costs one row per task and month.
    ``class_type`` is text, which hash aggregation cannot hold in a buffer: it is
    grouped by first and merged on the small result. The second shuffle is by
    series alone, which also serves everything that later runs over a series.
    """
    reports = staged.select(
        "class_id",
        subclass_or_none(F.col("subclass_id")).alias("subclass_id"),
        month_of(F.col("as_of")).alias("month"),
        "class_type",
        "unit_value",
        "net_assets",
        "holders",
        row_order().alias("row_order"),
    )
    order = F.col("row_order")
    by_type = reports.groupBy(*BLOCK, "class_type").agg(
        F.count("*").alias("reports"),
        F.min(order).alias("first_order"),
        F.max(order).alias("last_order"),
        F.min_by("unit_value", order).alias("first_unit_value"),
        F.max_by("unit_value", order).alias("unit_value"),
        F.count("class_type").alias("class_type_known"),
        *[F.count(name).alias(f"{name}_known") for name in ("net_assets", "holders")],
        *_latest_columns(["net_assets", "holders"], order),
    )
    kind, last = F.col("class_type"), F.col("last_order")
    return (
        by_type.repartition(*SERIES)
        .groupBy(*BLOCK)
        .agg(
            F.sum("reports").alias("reports"),
            F.min("first_order").alias("first_order"),
            F.max("last_order").alias("last_order"),
            F.min_by("first_unit_value", "first_order").alias("first_unit_value"),
            F.max_by("unit_value", "last_order").alias("unit_value"),
            latest(kind, last).alias("class_type"),
            latest_order(kind, last).alias("class_type_order"),
            *[F.sum(f"{name}_known").alias(f"{name}_known") for name in DESCRIBING],
            *_latest_again(["net_assets", "holders"], with_order=True),
        )
    )


def monthly_returns(staged: DataFrame) -> DataFrame:
    """Monthly compounded returns straight from staged reports."""
    return returns_of_rollup(month_rollup(staged))


def returns_of_rollup(rollup: DataFrame) -> DataFrame:
    """Monthly compounded returns from a month rollup.

    The product of the daily factors of a month is its last quote over the last
    quote before it. The first report of a series has no return: it does not
    count as a day and its attributes do not describe a month, so a month that
    holds nothing else drops out.
    """
    return returns_of_openings(with_openings(rollup))


def with_openings(rollup: DataFrame) -> DataFrame:
    """Adds ``opening``, the last quote before each month of a series, and ``previous_month``."""
    in_series = Window.partitionBy(*SERIES).orderBy("month")
    return rollup.select(
        "*",
        F.lag("unit_value").over(in_series).alias("opening"),
        F.lag("month").over(in_series).alias("previous_month"),
    )


def returns_of_openings(framed: DataFrame) -> DataFrame:
    """:func:`returns_of_rollup` of a rollup that has its openings."""
    first = F.col("previous_month").isNull()
    observed = framed.withColumn(
        "obs_days", F.when(first, F.col("reports") - 1).otherwise(F.col("reports"))
    ).filter(F.col("obs_days") > 0)

    def described(name: str) -> Column:
        # The latest known value is of the first order, and no copy of that report has it.
        on_first = F.col(f"{name}_order") == F.col("first_order")
        only_on_first_row = first & on_first & (F.col(f"{name}_known") == 1)
        return F.when(~F.coalesce(only_on_first_row, F.lit(False)), F.col(name))

    start = F.when(first, F.col("first_unit_value")).otherwise(F.col("opening"))
    return observed.select(
        *SERIES,
        described("class_type").alias("class_type"),
        "month",
        "obs_days",
        change_ratio(F.col("unit_value"), start).alias("month_return"),
        described("net_assets").alias("month_end_net_assets"),
        described("holders").alias("month_end_holders"),
    )


def _latest_columns(names: list[str], order: Column) -> list[Column]:
    columns = []
    for name in names:
        columns.append(latest(F.col(name), order).alias(name))
        columns.append(latest_order(F.col(name), order).alias(f"{name}_order"))
    return columns


def _latest_again(names: list[str], with_order: bool = False) -> list[Column]:
    """Merge the columns of :func:`_latest_columns`."""
    columns = []
    for name in names:
        order = F.col(f"{name}_order")
        columns.append(F.max_by(F.col(name), order).alias(name))
        if with_order:
            columns.append(F.max(order).alias(f"{name}_order"))
    return columns
