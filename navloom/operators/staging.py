"""Raw reports to typed, valid, renamed reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.fixed_values import MISSING_CELLS, RAW_TO_STAGED


def coerce_reports(raw: DataFrame) -> DataFrame:
    """Text columns of a report file to their types; what cannot be read becomes null.

    Cells that stand for a missing value are null in every column, whichever reader the
    text came from.
    """
    kinds = {name: kind for name, (_, kind) in RAW_TO_STAGED.items()}
    numbers = [name for name, kind in kinds.items() if kind in ("double", "bigint")]
    # A column of its own per parsed number, since each is looked at more than once.
    parsed = raw.withColumns({f"{n}_parsed": F.col(n).try_cast("double") for n in numbers})
    kept = [c for c in raw.columns if c not in kinds]
    return parsed.select(*kept, *[_coerced(n, kind).alias(n) for n, kind in kinds.items()])


def stage_reports(raw: DataFrame) -> DataFrame:
    """Rename, cast strictly and keep reports with ids, a date and a positive quote.

    A value that does not fit its type raises (ANSI casts): the lake is typed, so
    that is a broken lake and not a broken report.
    """
    types = dict(raw.dtypes)
    staged = raw.select(
        *[
            _strict(F.col(raw_name), types[raw_name], kind).alias(name)
            for raw_name, (name, kind) in RAW_TO_STAGED.items()
        ]
    )
    return staged.filter(
        F.col("class_id").isNotNull()
        & F.col("as_of").isNotNull()
        & (F.col("unit_value") > 0)
        & ~F.isnan("unit_value")
    )


def _coerced(name: str, kind: str) -> Column:
    text = F.col(name)
    if kind == "string":
        return F.when(~text.isin(MISSING_CELLS), text)
    if kind == "date":
        # A cast reads ISO days faster than a pattern does, but takes more forms.
        return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))
    parsed = F.col(f"{name}_parsed")
    # Spark also reads the Java forms "1.5d" and "1.5f"; report files know no such thing.
    # "inf" ends alike, and is a number.
    java_form = F.substring(F.rtrim(text), -1, 1).isin(*"dfDF")
    number = F.when(~F.isnan(parsed) & (~java_form | F.isnan(parsed * 0)), parsed)
    return F.rint(number).try_cast("bigint") if kind == "bigint" else number


def _strict(column: Column, found: str, wanted: str) -> Column:
    if wanted == found:
        return column
    if wanted == "bigint" and found in ("double", "float"):
        # Counts turn into doubles in files that also hold missing counts.
        column = F.rint(column)
    return column.cast(wanted)
