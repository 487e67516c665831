"""Exact median per group without holding a group in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
MARGIN = 0.001


def exact_median(
    values: DataFrame, keys: list[str], value: str, name: str, few_groups: bool = False
) -> DataFrame:
    """Interpolated median of ``value`` per ``keys`` (both without nulls).

    ``F.median`` keeps every distinct value of a group in one buffer. Here each
    group is cut in three at two approximate quantiles around its middle, the
    parts are counted, and only the part that holds the middle ranks is sorted.
    The cut points decide how much that is, not what comes out: any two points
    give the exact median. The values are read three times, so pass stored data.

    ``few_groups`` says that the keys are bounded by their nature, as months are
    (dates with four-digit years have fewer than 120,000); the per-group rows are
    then broadcast instead of left to the join choice at run time.
    """
    per_group = F.broadcast if few_groups else (lambda rows: rows)
    values = values.select(*keys, F.col(value).alias("value"))
    cuts = values.groupBy(*keys).agg(
        F.percentile_approx("value", [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY).alias("cuts"),
        F.count("*").alias("total"),
    )
    cut = values.join(per_group(cuts), keys).select(
        *keys,
        "value",
        F.when(F.col("value") < F.col("cuts")[0], 1)
        .when(F.col("value") <= F.col("cuts")[1], 2)
        .otherwise(3)
        .alias("part"),
        F.floor((F.col("total") + 1) / 2).alias("lower_rank"),
        F.floor(F.col("total") / 2 + 1).alias("upper_rank"),
    )
    part_of = [*keys, "lower_rank", "upper_rank", "part"]
    by_part = Window.partitionBy(*keys).orderBy("part")
    holding = (
        cut.groupBy(*part_of)
        .agg(F.count("*").alias("rows"))
        .withColumn("reached", F.sum("rows").over(by_part))
        .withColumn("before", F.col("reached") - F.col("rows"))
        .filter(
            (F.col("before") < F.col("upper_rank")) & (F.col("reached") >= F.col("lower_rank"))
        )
        .select(*keys, "part", "before")
    )
    by_value = Window.partitionBy(*keys).orderBy("part", "value")
    candidates = (
        cut.join(per_group(holding), [*keys, "part"])
        .groupBy(*part_of, "before", "value")
        .agg(F.count("*").alias("rows"))
    )
    ranked = candidates.withColumn(
        # ``before`` of the first part held counts all rows below the candidates.
        "reached",
        F.sum("rows").over(by_value) + F.min("before").over(Window.partitionBy(*keys)),
    )
    middle = ranked.filter(
        (F.col("reached") >= F.col("lower_rank"))
        & (F.col("reached") - F.col("rows") < F.col("upper_rank"))
    )
    return middle.groupBy(*keys).agg(((F.min("value") + F.max("value")) / 2).alias(name))
