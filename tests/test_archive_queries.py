"""Queries on archives make their reports once, however often these are written."""

import datetime

import pytest

from navloom_checks import queries

LABELLED = (
    "TP_FUNDO_CLASSE string, CNPJ_FUNDO_CLASSE string, ID_SUBCLASSE string, DT_COMPTC date,"
    " VL_TOTAL double, VL_QUOTA double, VL_PATRIM_LIQ double, CAPTC_DIA double, RESG_DIA double,"
    " NR_COTST bigint, year_month string"
)


@pytest.mark.parametrize("name, rows", [("missing_cells", 10), ("archive_replaced", 5)])
def test_reports_are_made_once(spark, monkeypatch, name, rows):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    cells = [
        ("K", str(n), None, datetime.date(1996, 1 + n % 2, 3), 1.0, 2.0, 3.0, 4.0, 5.0, 1 + n % 2, f"1996-0{1 + n % 2}")
        for n in range(5)
    ]
    reports = spark.createDataFrame(cells, LABELLED).mapInArrow(counted, LABELLED)
    monkeypatch.setattr(queries, "labelled", lambda *_: reports)
    assert queries.QUERIES[name](spark, "").count() == rows
    assert made.value == len(cells)
