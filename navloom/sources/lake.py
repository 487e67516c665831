"""The raw lake: typed Parquet, one partition per report month."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.fixed_values import RAW_COLUMNS, RAW_TO_STAGED
from navloom.functions.calendar import spine_of

LAKE_SCHEMA = ", ".join(
    [*[f"{name} {kind}" for name, (_, kind) in RAW_TO_STAGED.items()], "year_month string"]
)


def write_lake(reports: DataFrame, root: str, gather: bool = False) -> None:
    """Replace exactly the months that ``reports`` holds; other months stay.

    Every task writes a file for each month it holds. That is right for archives, of
    which a task reads a few whole months. Reports that are spread over tasks should be
    brought together by month with ``gather``; a month much larger than the others is
    then split over several tasks.
    """
    rows = reports.select(*RAW_COLUMNS, "year_month")
    if gather:
        rows = rows.hint("rebalance", "year_month")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("year_month")
        .parquet(root)
    )


def read_lake(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """All months of the lake, or only the labels in ``months`` (partition pruning)."""
    reports = spark.read.schema(LAKE_SCHEMA).parquet(root)
    return reports if months is None else reports.filter(F.col("year_month").isin(months))


def read_month_folders(spark: SparkSession, root: str) -> DataFrame:
    """A lake laid out as ``root/YYYY-MM/*.parquet`` by other writers.

    Such files often hold days as nanosecond timestamps, which Spark reads as longs
    under ``spark.sql.legacy.parquet.nanosAsLong``; set that in the session first.
    """
    reports = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(root)
    )
    day = F.col("DT_COMPTC")
    if dict(reports.dtypes)["DT_COMPTC"] == "bigint":
        day = F.timestamp_micros(F.expr("DT_COMPTC div 1000"))
    columns = [
        (day.cast("date") if name == "DT_COMPTC" else F.col(name)).alias(name)
        for name in RAW_COLUMNS
    ]
    month = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2})/[^/]*$", 1)
    return reports.select(*columns, month.alias("year_month"))


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """Files of a stored table with their bytes, from the listing alone."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", F.col("length").alias("bytes"))
    )


def lake_months(spark: SparkSession, root: str) -> DataFrame:
    """Months present in the lake, from the listing alone; none if there is no lake."""
    try:
        files = stored_files(spark, root)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "year_month string")
    return files.select(_month_of_path().alias("year_month")).distinct()


def missing_months(bounds: DataFrame, present: DataFrame) -> DataFrame:
    """Months from ``first`` to ``last`` of the one-row ``bounds`` that are not present."""
    return spine_of(bounds).join(present, "year_month", "left_anti").select("year_month")


def batch_statistics(reports: DataFrame) -> DataFrame:
    """Per month the number of report rows and of distinct class ids (null is none)."""
    return reports.groupBy("year_month").agg(
        F.count("*").alias("rows"),
        F.count_distinct("CNPJ_FUNDO_CLASSE").alias("classes"),
    )


def stored_statistics(spark: SparkSession, root: str) -> DataFrame:
    """:func:`batch_statistics` of a lake with the bytes of each month."""
    sizes = (
        stored_files(spark, root)
        .groupBy(_month_of_path().alias("year_month"))
        .agg(F.sum("bytes").alias("bytes"))
    )
    return batch_statistics(read_lake(spark, root)).join(sizes, "year_month", "left")


def _month_of_path() -> Column:
    return F.regexp_extract("path", r"year_month=(\d{4}-\d{2})/", 1)
