"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Besides the queries
there are three runs at the size of a year of reports (6.3 million rows in about 13
months, made from the reports of the given tables): ``year_ingest`` brings their monthly
ZIP archives into the lake, ``year_build`` goes from the lake to all stored marts, and
``year_reports`` computes the market reports of all months from them.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navloom.operators import reports
from navloom.operators.staging import stage_reports
from navloom.plans.ingest import ingest_archives
from navloom.plans.warehouse import build_marts
from navloom.sources import lake
from navloom.sources.lineitem_reports import orders_benchmark
from navloom.sources.shared import new_folder
from navloom_checks import queries as checks

HEADLINE = [
    "staged_reports",
    "daily_return",
    "monthly_return",
    "monthly_return_from_daily",
    "class_dimension",
    "monthly_fact",
    "top_by_month",
    "month_kpis",
    "size_band_report",
    "return_histogram",
    "class_history",
    "series_document",
    "benchmark_delta",
    "cumulative_vs_benchmark",
    "series_kpis",
    "quality_summary",
    "delimited_scan",
    "lake_roundtrip",
]
YEAR_ROWS = int(os.environ.get("BENCH_YEAR_ROWS", "6300000"))


def run(result: DataFrame) -> None:
    result.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def year_of_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Reports in the shape of real ones: dense business days, about 13 months.

    Each series keeps its values but gets consecutive business days instead of its
    own sparse ones, and is copied under new class ids up to the wanted size.
    """
    once = checks.raw(spark, folder)
    copies = max(1, round(YEAR_ROWS / once.count()))
    in_series = Window.partitionBy("CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE").orderBy("DT_COMPTC")
    nth = F.row_number().over(in_series) - 1
    # 2025-05-05 is a Monday; five days a week.
    day = F.date_add(F.lit("2025-05-05").cast("date"), (nth + 2 * F.floor(nth / 5)).cast("int"))
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    dense = once.withColumn("day", day).withColumn("copy", copy)
    return dense.select(
        "TP_FUNDO_CLASSE",
        F.concat_ws("/", "CNPJ_FUNDO_CLASSE", "copy").alias("CNPJ_FUNDO_CLASSE"),
        "ID_SUBCLASSE",
        F.col("day").alias("DT_COMPTC"),
        *checks.RAW_COLUMNS[4:],
        F.date_format("day", "yyyy-MM").alias("year_month"),
    )


def year_runs(spark: SparkSession, folder: str) -> tuple[dict[str, float], int]:
    root, marts = (new_folder(spark, name) for name in ("lake", "year-marts"))
    source = new_folder(spark, "year-archives")
    checks.pack_archives(year_of_reports(spark, folder), source)
    seconds = {"year_ingest": timed(lambda: ingest_archives(spark, source, root))}
    seconds["year_build"] = timed(
        lambda: build_marts(stage_reports(lake.read_lake(spark, root)), marts, checks.RANKING)
    )
    fact, rates = spark.read.parquet(f"{marts}/fact"), orders_benchmark(spark, folder)

    def report() -> None:
        run(reports.month_kpis(fact, rates, checks.MIN_DAYS))
        run(reports.size_band_report(fact, rates, checks.MIN_DAYS))
        run(reports.return_histogram(fact, min_days=checks.MIN_DAYS))

    seconds["year_reports"] = timed(report)
    return seconds, lake.read_lake(spark, root).count()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.maxConcurrentOutputFileWriters", "64")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    run(checks.staged(spark, folder))
    seconds = {"build_marts": timed(lambda: checks.stored_marts(spark, folder))}
    source = new_folder(spark, "archives")
    checks.pack_archives(checks.labelled(spark, folder), source)
    seconds["archive_ingest"] = timed(
        lambda: ingest_archives(spark, source, new_folder(spark, "lake"))
    )
    for name in HEADLINE:
        seconds[name] = timed(lambda: run(checks.QUERIES[name](spark, folder)))
    year_rows = 0
    if YEAR_ROWS:
        figures, year_rows = year_runs(spark, folder)
        seconds.update(figures)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
                "year_rows": year_rows,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
