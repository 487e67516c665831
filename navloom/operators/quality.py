"""Data-quality rules as jobs: ``check, failures, total, ratio, passed``.

Rules that look at one row at a time are counted together in one pass per table, or by a
:class:`Watch` while the table is written, without a pass of their own; keys are compared
by shuffles that combine first. ``failing_rows`` gives the rows behind a count.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from navloom.fixed_values import (
    FACT_PER_CLASS_RANGE,
    LOWEST_NET_ASSETS,
    MAX_DAYS_IN_MONTH,
    MAX_NEGATIVE_ASSETS_RATIO,
    MAX_OUTLIER_RATIO,
    MIN_DIMENSION_ROWS,
    MIN_HOLDERS,
    MIN_NET_ASSETS,
    MIN_STAGED_ROWS,
    OUTLIER_RETURN,
    TOP_N,
)


@dataclass(frozen=True)
class Limits:
    """Limits of the rules; the defaults are those for full monthly reports."""

    min_staged_rows: int = MIN_STAGED_ROWS
    min_dimension_rows: int = MIN_DIMENSION_ROWS
    fact_per_class: tuple[float, float] = FACT_PER_CLASS_RANGE
    max_negative_assets_ratio: float = MAX_NEGATIVE_ASSETS_RATIO
    lowest_net_assets: float = LOWEST_NET_ASSETS
    max_days: int = MAX_DAYS_IN_MONTH
    outlier_return: float = OUTLIER_RETURN
    max_outlier_ratio: float = MAX_OUTLIER_RATIO
    top_n: int = TOP_N
    min_net_assets: float = MIN_NET_ASSETS
    min_holders: int = MIN_HOLDERS


@dataclass(frozen=True)
class RowRule:
    """``bad`` rows of a table are failures; up to ``allowed`` of all rows may fail."""

    name: str
    bad: Column
    allowed: float = 0.0
    below: bool = field(default=False)  # the ratio has to stay below, not at, the limit
    needs_rows: bool = False  # an empty table fails

    def passed(self, failures: Column, total: Column) -> Column:
        ratio = F.coalesce(failures / F.nullif(total, F.lit(0)), F.lit(0.0))
        within = ratio < self.allowed if self.below else ratio <= self.allowed
        return within & (total > 0) if self.needs_rows else within


def not_null_rules(table: str, columns: list[str]) -> list[RowRule]:
    return [RowRule(f"{table}.{c} not null", F.col(c).isNull()) for c in columns]


def staged_rules(limits: Limits) -> list[RowRule]:
    assets = F.col("net_assets")
    return [
        *not_null_rules("staged", ["class_id", "as_of", "unit_value"]),
        RowRule("staged.unit_value positive", F.col("unit_value") <= 0),
        RowRule("staged.holders not negative", F.col("holders") < 0),
        RowRule(
            "staged.net_assets rarely negative",
            assets < 0,
            limits.max_negative_assets_ratio,
            below=True,
            needs_rows=True,
        ),
        RowRule("staged.net_assets never far below zero", assets < limits.lowest_net_assets),
    ]


def dimension_rules() -> list[RowRule]:
    return not_null_rules("dimension", ["class_key", "class_id", "last_day"])


def fact_rules(limits: Limits) -> list[RowRule]:
    return [
        *not_null_rules("fact", ["return_key", "class_key", "month"]),
        RowRule("fact.obs_days plausible", F.col("obs_days") > limits.max_days),
        RowRule(
            "fact.month_return rarely above the outlier limit",
            F.col("month_return") > limits.outlier_return,
            limits.max_outlier_ratio,
            needs_rows=True,
        ),
    ]


def top_rules(limits: Limits) -> list[RowRule]:
    return [
        *not_null_rules("top", ["month", "rank", "class_id"]),
        RowRule(
            "top.month_end_net_assets accepted",
            F.col("month_end_net_assets") < limits.min_net_assets,
        ),
        RowRule(
            "top.month_end_holders accepted",
            F.col("month_end_holders") < limits.min_holders,
            needs_rows=True,
        ),
    ]


def count_rules(
    table: DataFrame, rules: list[RowRule], name: str = "", more_than: int | None = None
) -> DataFrame:
    """Result rows of row rules: one pass over the table for all of them.

    ``more_than`` adds the rule that the table (called ``name``) has more rows than that.
    """
    counts = table.agg(*_counts(rules))
    return _rule_results(counts, rules, name, more_than)


def _counts(rules: list[RowRule]) -> list[Column]:
    bad = [F.count_if(rule.bad).alias(f"bad_{i}") for i, rule in enumerate(rules)]
    return [F.count("*").alias("total"), *bad]


def _rule_results(
    counts: DataFrame, rules: list[RowRule], name: str, more_than: int | None
) -> DataFrame:
    total = F.col("total")
    results = [
        _result(rule.name, F.col(f"bad_{i}"), total, rule.passed(F.col(f"bad_{i}"), total))
        for i, rule in enumerate(rules)
    ]
    if more_than is not None:
        enough = total > more_than
        results.append(_result(f"{name} has enough rows", _one_unless(enough), total, enough))
    return _with_ratio(counts.select(F.inline(F.array(*results))))


class Watch:
    """Counts the failures of row rules while a table is written.

    ``on`` goes right before the write: there a task counts once, however often executors
    are lost, while counts before a shuffle may come twice from stages that run again. One
    watch counts one write, and only numbers come back from it.
    """

    def __init__(self, rules: list[RowRule]) -> None:
        self.rules = rules
        self._seen: Observation | None = None

    def on(self, table: DataFrame) -> DataFrame:
        """The same rows, counted by the first job that reads them all."""
        if self._seen is not None:
            raise ValueError("a watch counts one write")
        self._seen = Observation()
        return table.observe(self._seen, *_counts(self.rules))

    def results(
        self, spark: SparkSession, name: str = "", more_than: int | None = None
    ) -> DataFrame:
        """What :func:`count_rules` gives for the table that was written."""
        if self._seen is None:
            raise ValueError("nothing was written under this watch")
        seen = self._seen.get
        names = ["total", *[f"bad_{i}" for i in range(len(self.rules))]]
        counts = spark.createDataFrame(
            [tuple(seen[n] for n in names)], ", ".join(f"{n} bigint" for n in names)
        )
        return _rule_results(counts, self.rules, name, more_than)


def watches(limits: Limits | None = None) -> dict[str, Watch]:
    """A watch for each of the four tables, see ``plans.warehouse.build_marts``."""
    return {name: Watch(rules) for name, rules in _row_rules(limits or Limits()).items()}


def _row_rules(limits: Limits) -> dict[str, list[RowRule]]:
    return {
        "staged": staged_rules(limits),
        "dimension": dimension_rules(),
        "fact": fact_rules(limits),
        "top": top_rules(limits),
    }


def failing_rows(table: DataFrame, rule: RowRule) -> DataFrame:
    return table.filter(rule.bad)


def repeated_keys(table: DataFrame, columns: list[str]) -> DataFrame:
    """Key values that occur more than once; nulls are equal."""
    return (
        table.groupBy(*columns).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
    )


def rows_without_parent(child: DataFrame, parent: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose ``columns`` do not occur in ``parent``."""
    return child.join(parent.select(*columns), columns, "left_anti")


def orphan_facts(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    return rows_without_parent(fact, dimension, ["class_key"])


def ranked_without_fact(top: DataFrame, fact: DataFrame) -> DataFrame:
    keys = ["class_id", "month"]
    return rows_without_parent(top, matching(fact, top, keys), keys)


def matching(fact: DataFrame, top: DataFrame, columns: list[str]) -> DataFrame:
    """The keys of ``fact`` that occur in a ranking.

    The ranking has a fixed number of rows per month, so it goes to the scan of the facts,
    and only what matches moves on.
    """
    return fact.select(*columns).join(F.broadcast(top.select(*columns)), columns, "left_semi")


def most_ranked_in_a_month(top: DataFrame) -> DataFrame:
    per_month = top.groupBy("month").agg(F.count("*").alias("rows"))
    return per_month.agg(F.max("rows").alias("most_rows"))


def unique_check(name: str, table: DataFrame, columns: list[str]) -> DataFrame:
    """Result row of the rule that ``columns`` identify a row; failures are keys."""
    per_key = table.groupBy(*columns).agg(F.count("*").alias("rows"))
    return _counted(name, per_key, F.sum("rows"), F.col("rows") > 1)


def parent_check(
    name: str, child: DataFrame, parent: DataFrame, columns: list[str]
) -> DataFrame:
    """Result row of the rule that every child row has a parent; failures are rows."""
    known = parent.select(*columns).distinct().withColumn("known", F.lit(True))
    joined = child.select(*columns).join(known, columns, "left")
    return _counted(name, joined, F.count("*"), F.col("known").isNull())


def _counted(name: str, rows: DataFrame, total: Column, bad: Column) -> DataFrame:
    counts = rows.agg(
        F.coalesce(total, F.lit(0)).alias("total"), F.count_if(bad).alias("failures")
    )
    failures = F.col("failures")
    return _one_result(counts, _result(name, failures, F.col("total"), failures == 0))


def bound_check(name: str, measured: DataFrame, passed: Column) -> DataFrame:
    """Result row of a rule on the one number in column ``total`` of one row."""
    passed = F.coalesce(passed, F.lit(False))
    return _one_result(measured, _result(name, _one_unless(passed), F.col("total"), passed))


def _result(name: str, failures: Column, total: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        failures.cast("bigint").alias("failures"),
        F.coalesce(total, F.lit(0)).cast("bigint").alias("total"),
        passed.alias("passed"),
    )


def _one_unless(passed: Column) -> Column:
    return F.when(passed, 0).otherwise(1)


def _one_result(counts: DataFrame, result: Column) -> DataFrame:
    return _with_ratio(counts.select(F.inline(F.array(result))))


def _with_ratio(results: DataFrame) -> DataFrame:
    ratio = F.coalesce(F.col("failures") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    return results.select("check", "failures", "total", ratio.alias("ratio"), "passed")


def facts_per_class(fact: DataFrame, dimension: DataFrame, limits: Limits) -> DataFrame:
    """Result row of the rule on the number of facts per dimension row."""
    counted = fact.select(F.lit(1).alias("fact"), F.lit(0).alias("class")).unionAll(
        dimension.select(F.lit(0), F.lit(1))
    )
    both = counted.agg(F.sum("fact").alias("total"), F.sum("class").alias("classes"))
    per_class = F.col("total") / F.nullif(F.col("classes"), F.lit(0))
    low, high = limits.fact_per_class
    return bound_check("fact rows per class plausible", both, per_class.between(low, high))


def run_checks(
    staged: DataFrame,
    dimension: DataFrame,
    fact: DataFrame,
    top: DataFrame,
    limits: Limits | None = None,
    watched: dict[str, Watch] | None = None,
) -> DataFrame:
    """All rules over the four tables, which should be stored ones.

    Tables that were written under a watch (of the same limits) are not read again for the
    rules on single rows.
    """
    limits, watched = limits or Limits(), watched or {}
    tables = {"staged": staged, "dimension": dimension, "fact": fact, "top": top}
    least = {"staged": limits.min_staged_rows, "dimension": limits.min_dimension_rows}
    by_row = [
        watched[name].results(staged.sparkSession, name, least.get(name))
        if name in watched
        else count_rules(tables[name], rules, name, least.get(name))
        for name, rules in _row_rules(limits).items()
    ]
    most = most_ranked_in_a_month(top).withColumnRenamed("most_rows", "total")
    sample = top.orderBy(F.desc("month"), F.asc("rank")).limit(10).select("return_pct")
    results = [
        *by_row,
        facts_per_class(fact, dimension, limits),
        unique_check(
            "staged series and day unique", staged, ["class_id", "subclass_id", "as_of"]
        ),
        unique_check("dimension.class_key unique", dimension, ["class_key"]),
        unique_check("fact.return_key unique", fact, ["return_key"]),
        parent_check("fact.class_key in dimension", fact, dimension, ["class_key"]),
        parent_check(
            "top rows exist in fact",
            top,
            matching(fact, top, ["class_id", "month"]),
            ["class_id", "month"],
        ),
        bound_check("top rows per month limited", most, F.col("total") <= limits.top_n),
        bound_check(
            "top report answers", sample.agg(F.count("*").alias("total")), F.col("total") >= 1
        ),
    ]
    return reduce(DataFrame.unionByName, results)
