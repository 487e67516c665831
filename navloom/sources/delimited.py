"""Report files as plain delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from navloom.fixed_values import RAW_COLUMNS, REPORT_CHARSET, REPORT_SEPARATOR


def require_columns(found: list[str], expected: list[str] = RAW_COLUMNS) -> list[str]:
    """``found``, or ``ValueError`` naming what is missing; more columns are fine."""
    missing = sorted(set(expected) - set(found))
    if missing:
        raise ValueError(f"report layout changed, missing columns: {', '.join(missing)}")
    return found


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Report files of one layout, all columns as text, taken by name.

    The layout is the header of the first file. A user schema would be bound by
    position and hide a moved or missing column; ``enforceSchema=false`` makes every
    other file's header agree with the first one's or fail.
    """
    reader = (
        spark.read.option("sep", REPORT_SEPARATOR)
        .option("header", True)
        .option("encoding", REPORT_CHARSET)
        .option("inferSchema", False)
        .option("enforceSchema", False)
    )
    rows = reader.csv(path)
    require_columns(rows.columns)
    return rows.select(*RAW_COLUMNS)
