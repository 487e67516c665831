import pytest
from pyspark.sql import functions as F

from navloom.functions import calendar
from tests.conftest import day


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("today, period", [("2026-05-15", "202604"), ("2026-01-10", "202512")])
def test_previous_month(spark, today, period):
    assert one(spark, calendar.previous_month(F.lit(day(today)))) == period


def test_month_texts(spark):
    when = F.lit(day("2026-04-17"))
    assert one(spark, calendar.month_of(when)) == day("2026-04-01")
    assert one(spark, calendar.month_label(when)) == "2026-04"
    assert one(spark, calendar.period_code(when)) == "202604"
    assert one(spark, calendar.month_key(when)) == "2026-04-01"
    assert one(spark, calendar.label_from_period(F.lit("202604"))) == "2026-04"
    assert one(spark, calendar.period_from_label(F.lit("2026-04"))) == "202604"


def test_spine_includes_both_ends_and_turns_the_year(spark):
    labels = [r.year_month for r in calendar.month_spine(spark, "2025-11", "2026-02").collect()]
    assert labels == ["2025-11", "2025-12", "2026-01", "2026-02"]
    assert calendar.month_spine(spark, "2026-03").count() == 1


def test_spine_refuses_reversed_months(spark):
    with pytest.raises(ValueError):
        calendar.month_spine(spark, "2026-02", "2026-01")
    reversed_ = spark.range(1).select(
        F.lit(day("2026-02-01")).alias("first"), F.lit(day("2026-01-01")).alias("last")
    )
    with pytest.raises(Exception, match="lies before"):
        calendar.spine_of(reversed_).collect()
