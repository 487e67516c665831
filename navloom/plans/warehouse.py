"""From staged reports to the stored tables that reports are read from."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from navloom.fixed_values import MIN_DAYS, MIN_HOLDERS, MIN_NET_ASSETS, RAW_TO_STAGED, TOP_N
from navloom.operators.marts import dimension_of_rollup, monthly_fact, top_by_month
from navloom.operators.quality import Watch
from navloom.operators.returns import month_rollup, returns_of_rollup
from navloom.sources.lake import stored_files

MARTS = ["dimension", "fact", "top"]


@dataclass(frozen=True)
class Ranking:
    """Size and eligibility of the ranking."""

    top_n: int = TOP_N
    min_days: int = MIN_DAYS
    min_net_assets: float = MIN_NET_ASSETS
    min_holders: int = MIN_HOLDERS


def build_marts(
    staged: DataFrame,
    root: str,
    ranking: Ranking = Ranking(),
    watches: dict[str, Watch] | None = None,
) -> dict[str, DataFrame]:
    """Rebuild dimension, fact and ranking below ``root`` and return them as stored.

    The reports are read once, into the month rollup, which is stored because both
    dimension and fact need it. Everything after works on one row per series and
    month; the ranking reads the stored fact. ``watches`` of dimension, fact and top count
    the failures of rules on the way (see ``operators.quality``).
    """
    watch = (watches or {}).get
    spark = staged.sparkSession
    rollup = store(month_rollup(staged), f"{root}/rollup")
    dimension = store(dimension_of_rollup(rollup), f"{root}/dimension", watch=watch("dimension"))
    facts = monthly_fact(returns_of_rollup(rollup), dimension)
    fact = store(facts, f"{root}/fact", by="month", watch=watch("fact"))
    ranked = top_by_month(
        fact, ranking.top_n, ranking.min_days, ranking.min_net_assets, ranking.min_holders
    )
    store(ranked, f"{root}/top", watch=watch("top"))
    return read_marts(spark, root)


def store(
    table: DataFrame, path: str, by: str | None = None, watch: Watch | None = None
) -> DataFrame:
    """Write a table in full and read it back.

    Files follow the partitions of the last shuffle, which Spark sizes at run time.
    With ``by`` the rows of one partition value meet in few files, and a value much
    larger than the others is split over several tasks. A ``watch`` sees the rows last.
    """
    rows = table if by is None else table.hint("rebalance", by)
    rows = rows if watch is None else watch.on(rows)
    writer = rows.write.mode("overwrite").option("compression", "snappy")
    (writer if by is None else writer.partitionBy(by)).parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def read_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    known = schemas(spark)
    return {
        name: spark.read.schema(known[name]).parquet(f"{root}/{name}") for name in MARTS
    }


def schemas(spark: SparkSession) -> dict[str, StructType]:
    """Those of marts over no reports: a table without rows may have no file to tell."""
    columns = ", ".join(f"{name} {kind}" for name, kind in RAW_TO_STAGED.values())
    rollup = month_rollup(spark.createDataFrame([], columns))
    dimension = dimension_of_rollup(rollup)
    fact = monthly_fact(returns_of_rollup(rollup), dimension)
    tables = {"rollup": rollup, "dimension": dimension, "fact": fact, "top": top_by_month(fact)}
    return {name: table.schema for name, table in tables.items()}


def publish(marts: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Copy the tables that readers need to ``root`` in even files, without the rollup."""
    dimension, top = marts["dimension"].hint("rebalance"), marts["top"].hint("rebalance")
    return {
        "dimension": store(dimension, f"{root}/dimension"),
        "fact": store(marts["fact"], f"{root}/fact", by="month"),
        "top": store(top, f"{root}/top"),
    }


def save_tables(tables: dict[str, DataFrame], database: str) -> None:
    """Store tables in a catalog database, replacing them."""
    for name, table in tables.items():
        spark = table.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        table.hint("rebalance").write.mode("overwrite").saveAsTable(f"`{database}`.`{name}`")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables (also those that are not stored) available to ``spark.sql``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each given table and, where it has months, their number and the newest."""
    return reduce(DataFrame.unionByName, [_inventory_row(n, t) for n, t in tables.items()])


def _inventory_row(name: str, table: DataFrame) -> DataFrame:
    if "month" not in table.columns:
        return table.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"),
            "rows",
            F.lit(None).cast("bigint").alias("months"),
            F.lit(None).cast("date").alias("newest_month"),
        )
    # Counted per month first: a distinct count over all rows would move them.
    per_month = table.groupBy("month").agg(F.count("*").alias("rows"))
    return per_month.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count("month").alias("months"),
        F.max("month").alias("newest_month"),
    ).select(F.lit(name).alias("table"), "rows", "months", "newest_month")


def stored_size(spark: SparkSession, root: str) -> DataFrame:
    """Megabytes below ``root``, from the file listing; raises when nothing is there."""
    mb = F.sum("bytes") / (1024 * 1024)
    return stored_files(spark, root).agg(
        F.count("*").alias("files"), F.coalesce(F.round(mb, 2), F.lit(0.0)).alias("size_mb")
    )
