import math

import pytest

from navloom.fixed_values import RAW_COLUMNS
from navloom.operators.staging import coerce_reports, stage_reports
from tests.conftest import day

TEXT_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)
TYPED_SCHEMA = (
    "TP_FUNDO_CLASSE string, CNPJ_FUNDO_CLASSE string, ID_SUBCLASSE string, DT_COMPTC date,"
    " VL_TOTAL double, VL_QUOTA double, VL_PATRIM_LIQ double, CAPTC_DIA double,"
    " RESG_DIA double, NR_COTST {count}"
)


def coerced(spark, **cells):
    row = {c: None for c in RAW_COLUMNS} | cells
    frame = spark.createDataFrame([tuple(row[c] for c in RAW_COLUMNS)], TEXT_SCHEMA)
    return coerce_reports(frame).first()


@pytest.mark.parametrize(
    "text, value",
    [
        ("1.5", 1.5),
        (" 1.5 ", 1.5),
        ("-1e3", -1000.0),
        ("inf", math.inf),
        ("1.5d", None),
        ("2F ", None),
        ("NaN", None),
        ("abc", None),
        ("1,5", None),
        (None, None),
    ],
)
def test_numbers_are_tolerant(spark, text, value):
    assert coerced(spark, VL_QUOTA=text).VL_QUOTA == value


@pytest.mark.parametrize(
    "text, value",
    [
        ("2026-04-01", day("2026-04-01")),
        ("2026-4-1", day("2026-04-01")),
        ("2026-02-30", None),
        ("01/04/2026", None),
        ("soon", None),
        (None, None),
    ],
)
def test_days_are_tolerant(spark, text, value):
    assert coerced(spark, DT_COMPTC=text).DT_COMPTC == value


@pytest.mark.parametrize("text, value", [("7", 7), ("7.0", 7), ("x", None), ("1e300", None)])
def test_counts_are_tolerant(spark, text, value):
    assert coerced(spark, NR_COTST=text).NR_COTST == value


def test_coercion_keeps_further_columns(spark):
    frame = spark.createDataFrame(
        [(*["1"] * len(RAW_COLUMNS), "2026-04")], TEXT_SCHEMA + ", year_month string"
    )
    assert coerce_reports(frame).columns == ["year_month", *RAW_COLUMNS]


def raw(spark, rows, count="bigint"):
    return spark.createDataFrame(rows, TYPED_SCHEMA.format(count=count))


def test_staging_keeps_valid_reports_only(spark):
    good = ("FIF", "c", None, day("2026-04-01"), 1.0, 1.1, -5.0, 0.0, 0.0, 3)

    def changed(position, value):
        return (*good[:position], value, *good[position + 1 :])

    rows = [
        good,
        changed(1, None),
        changed(3, None),
        changed(5, None),
        changed(5, 0.0),
        changed(5, -1.0),
        changed(5, math.nan),
    ]
    staged = stage_reports(raw(spark, rows)).collect()
    assert len(staged) == 1
    assert staged[0].asDict() == {
        "class_type": "FIF",
        "class_id": "c",
        "subclass_id": None,
        "as_of": day("2026-04-01"),
        "total_value": 1.0,
        "unit_value": 1.1,
        "net_assets": -5.0,
        "inflow": 0.0,
        "outflow": 0.0,
        "holders": 3,
    }


@pytest.mark.parametrize("value, rounded", [(3.7, 4), (2.5, 2), (3.5, 4), (None, None)])
def test_double_counts_are_rounded(spark, value, rounded):
    row = ("FIF", "c", None, day("2026-04-01"), 1.0, 1.1, 1.0, 0.0, 0.0, value)
    assert stage_reports(raw(spark, [row], "double")).first().holders == rounded


def test_text_that_is_no_number_is_an_error_in_staging(spark):
    row = ("FIF", "c", None, day("2026-04-01"), 1.0, 1.1, 1.0, 0.0, 0.0, "many")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_reports(raw(spark, [row], "string")).collect()
