"""Distinct ids over any span of months, from exact bitmaps stored per month.

Counts of distinct ids do not add up over months, their sets do. Every id gets a number
in a stored dictionary, and a month keeps the numbers of its ids as bitmaps of 32,768 bits,
one per range of numbers that it uses. The ids of a span are the bits that any of its months
has: a few kilobytes per month and range are combined inside the scan tasks, and neither
reports nor ids are read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.sources.shared import new_folder, remove_folder

DICTIONARY = "id string, number bigint"
BITMAPS = "bucket bigint, bits binary, rows bigint, year_month string"


class DistinctIds:
    """Bitmaps of a report table under ``root``; one writer at a time.

    ``id_col`` names the ids. Rows without id count as rows, not as ids.
    """

    def __init__(self, spark: SparkSession, root: str, id_col: str = "CNPJ_FUNDO_CLASSE") -> None:
        self.spark, self.id_col = spark, id_col
        self.dictionary_folder, self.bitmap_folder = f"{root}/dictionary", f"{root}/bitmaps"

    def dictionary(self) -> DataFrame:
        return self._read(self.dictionary_folder, DICTIONARY)

    def bitmaps(self) -> DataFrame:
        return self._read(self.bitmap_folder, BITMAPS)

    def _read(self, folder: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(folder)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def refresh(self, reports: DataFrame) -> None:
        """Replace the months that ``reports`` (with ``year_month``) holds; others stay.

        Ids keep the number they got first. A run that fails before its end leaves at most
        numbers that no bitmap uses.
        """
        folder = new_folder(self.spark, "ids-of-months")
        per_id = reports.groupBy("year_month", F.col(self.id_col).alias("id")).agg(F.count("*").alias("rows"))
        per_id.write.parquet(folder)
        try:
            counted = self.spark.read.schema(per_id.schema).parquet(folder)
            self._number(counted)
            self._draw(counted)
        finally:
            remove_folder(self.spark, folder)

    def _number(self, counted: DataFrame) -> None:
        """Numbers from 1 for new ids: without gaps inside a task, whose ids fill whole ranges."""
        known = self.dictionary()
        last = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        new = counted.where("id is not null").select("id").distinct().join(known, "id", "left_anti")
        numbered = new.withColumn("number", F.monotonically_increasing_id() + F.lit(last + 1))
        numbered.write.mode("append").parquet(self.dictionary_folder)

    def _draw(self, counted: DataFrame) -> None:
        number = F.col("number")
        drawn = (
            counted.join(self.dictionary(), "id", "left")
            .groupBy("year_month", F.bitmap_bucket_number(number).alias("bucket"))
            .agg(
                F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"),
                F.sum("rows").alias("rows"),
            )
        )
        (
            drawn.select("bucket", "bits", "rows", "year_month")
            .hint("rebalance", "year_month")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("year_month")
            .parquet(self.bitmap_folder)
        )

    def of_spans(self, spans: DataFrame) -> DataFrame:
        """``first, last, rows, classes`` of each span of months ``YYYY-MM``, both included.

        Spans without reports, reversed ones too, have zeros; equal spans give one row.
        """
        spans = spans.select("first", "last").distinct()
        start, end = (F.to_date(F.concat(c, F.lit("-01"))) for c in ("first", "last"))
        months = F.when(start <= end, F.sequence(start, end, F.expr("interval 1 month")))
        wanted = spans.select("first", "last", F.explode(months).alias("month")).select(
            "first", "last", F.date_format("month", "yyyy-MM").alias("year_month")
        )
        met = self.bitmaps().join(wanted, "year_month")
        per_range = met.groupBy("first", "last", "bucket").agg(
            F.bitmap_count(F.bitmap_or_agg("bits")).alias("classes"), F.sum("rows").alias("rows")
        )
        found = per_range.groupBy("first", "last").agg(
            F.sum("rows").alias("rows"), F.sum("classes").alias("classes")
        )
        return spans.join(found, ["first", "last"], "left").fillna(0, ["rows", "classes"])
