"""Every query of the library over the given tables, as ``(spark, folder) -> DataFrame``.

Doubles are rounded so that engines can be compared. Queries on marts
read stored tables, as reports do in use: they are built from the whole tables once
per session and folder.
"""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyarrow import compute, csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.fixed_values import RAW_COLUMNS, REPORT_CHARSET, REPORT_SEPARATOR
from navloom.functions import calendar
from navloom.functions.measures import surrogate_key_null_safe
from navloom.operators import benchmark as bench
from navloom.operators import documents, marts, quality, reports, returns
from navloom.operators.distinct import DistinctIds
from navloom.operators.staging import coerce_reports, stage_reports
from navloom.plans.ingest import ingest_archives
from navloom.plans.refresh import VersionedMarts
from navloom.plans.warehouse import Ranking, build_marts, publish, store, table_inventory
from navloom.sources import delimited, lake
from navloom.sources.lineitem_reports import lineitem_reports, orders_benchmark
from navloom.sources.shared import new_folder
from navloom.sources.snapshots import MonthTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANKING = Ranking(top_n=10, min_days=4, min_net_assets=1_000_000.0, min_holders=1)
MIN_DAYS = RANKING.min_days
LIMITS = quality.Limits(
    min_staged_rows=1_000, min_dimension_rows=10, fact_per_class=(0.5, 100.0), top_n=10,
    min_holders=1,
)
_ROOTS: dict[tuple[str, str], str] = {}
_WRITTEN: set[str] = set()


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(table: DataFrame, places: int = 6) -> DataFrame:
    """All doubles to fixed places, without negative zeros.

    Quotes have two decimals, so some returns end exactly half-way between two rounded
    values, where the last bit of a double decides. A billionth moves them off it.
    """
    return table.select(
        *[
            (F.round(F.col(name) + 1e-9, places) + F.lit(0.0)).alias(name) if kind == "double" else F.col(name)
            for name, kind in table.dtypes
        ]
    )


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return lineitem_reports(spark, folder)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Raw reports with the month label that the lake is partitioned by."""
    reports_ = raw(spark, folder)
    return reports_.withColumn("year_month", calendar.month_label(F.col("DT_COMPTC")))


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return stage_reports(raw(spark, folder))


def stored_staged(spark: SparkSession, folder: str) -> DataFrame:
    """The staged reports as a table, which all further tables are built from."""
    path = f"{_root(spark, folder)}/staged"
    if path not in _WRITTEN:
        store(staged(spark, folder), path)
        _WRITTEN.add(path)
    return spark.read.parquet(path)


def stored_rollup(spark: SparkSession, folder: str) -> DataFrame:
    reports_ = stored_staged(spark, folder)
    return store(returns.month_rollup(reports_), new_folder(spark, "rollup"))


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return returns.daily_returns(stored_staged(spark, folder), stored_rollup(spark, folder))


def stored(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The staged reports and the marts built from them, each stored."""
    root = _root(spark, folder)
    if root not in _WRITTEN:
        build_marts(stored_staged(spark, folder), root, RANKING)
        _WRITTEN.add(root)
    names = ("staged", "dimension", "fact", "top")
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


def _root(spark: SparkSession, folder: str) -> str:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _ROOTS:
        _ROOTS[key] = new_folder(spark, "marts")
    return _ROOTS[key]


def stored_marts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    tables = stored(spark, folder)
    return {name: tables[name] for name in ("dimension", "fact", "top")}


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return stored_marts(spark, folder)["fact"]


def top(spark: SparkSession, folder: str) -> DataFrame:
    return stored_marts(spark, folder)["top"]


# Staging and the ranking in one plan from the tables; returns and marts from staging.


@query
def staged_reports(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(staged(spark, folder))


@query
def daily_return(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(daily(spark, folder))


@query
def monthly_return(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(returns.monthly_returns(stored_staged(spark, folder)))


@query
def monthly_return_of_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly returns of all reports twice: copies count as days without a change."""
    reports_ = stored_staged(spark, folder)
    return rounded(returns.monthly_returns(reports_.unionByName(reports_)))


@query
def monthly_return_from_daily(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(returns.compound_daily(daily(spark, folder)))


@query
def class_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(marts.class_dimension(stored_staged(spark, folder)))


@query
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Both forms of the dimension key."""
    return marts.class_dimension(stored_staged(spark, folder)).select(
        "class_id",
        "subclass_id",
        "class_key",
        surrogate_key_null_safe(F.col("class_id"), F.col("subclass_id")).alias("null_safe_key"),
    )


@query
def monthly_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Fact from a stored rollup, which keeps both sides of its join to one scan."""
    rollup = stored_rollup(spark, folder)
    return rounded(
        marts.monthly_fact(returns.returns_of_rollup(rollup), marts.dimension_of_rollup(rollup))
    )


@query
def top_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Reports to ranking in one lazy plan; the ranking needs no dimension."""
    ranked = marts.top_by_month(
        returns.monthly_returns(staged(spark, folder)),
        RANKING.top_n,
        RANKING.min_days,
        RANKING.min_net_assets,
        RANKING.min_holders,
    )
    return rounded(marts.in_mart_order(ranked))


# Reports, from stored marts.


@query
def top_of_newest_month(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.top_of_newest_month(top(spark, folder), 5))


@query
def ranking_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.ranking_report(top(spark, folder)))


@query
def global_top(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.global_top(top(spark, folder)))


@query
def months_desc(spark: SparkSession, folder: str) -> DataFrame:
    return reports.months_desc(fact(spark, folder))


@query
def newest_month(spark: SparkSession, folder: str) -> DataFrame:
    return reports.newest_month(fact(spark, folder))


@query
def month_kpis(spark: SparkSession, folder: str) -> DataFrame:
    rates = orders_benchmark(spark, folder)
    return rounded(reports.month_kpis(fact(spark, folder), rates, MIN_DAYS))


@query
def size_band_report(spark: SparkSession, folder: str) -> DataFrame:
    rates = orders_benchmark(spark, folder)
    return rounded(reports.size_band_report(fact(spark, folder), rates, MIN_DAYS))


@query
def return_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.return_distribution(fact(spark, folder), min_days=MIN_DAYS))


@query
def distribution_median(spark: SparkSession, folder: str) -> DataFrame:
    within = reports.return_distribution(fact(spark, folder), min_days=MIN_DAYS)
    return rounded(reports.distribution_median(within))


@query
def return_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.return_histogram(fact(spark, folder), min_days=MIN_DAYS))


@query
def class_search(spark: SparkSession, folder: str) -> DataFrame:
    return reports.class_search(fact(spark, folder))


@query
def class_prefix_search(spark: SparkSession, folder: str) -> DataFrame:
    return reports.class_search(fact(spark, folder), prefix="1", limit=200)


@query
def class_history(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.class_history(fact(spark, folder)))


@query
def series_document(spark: SparkSession, folder: str) -> DataFrame:
    """The nested series of every class, with all its records by their place."""
    nested = documents.series_documents(reports.class_history(fact(spark, folder)))
    records = nested.select(
        "class_id", "subclass_id", F.col("class_type").alias("document_type"),
        F.posexplode("series").alias("place", "record"),
    )
    return rounded(records.select("class_id", "subclass_id", "document_type", "place", "record.*"))


@query
def ranking_document(spark: SparkSession, folder: str) -> DataFrame:
    """The nested ranking of every month, with all its records by their place."""
    nested = documents.ranking_documents(top(spark, folder))
    records = nested.select("month", "total", F.posexplode("ranking").alias("place", "record"))
    return rounded(records.select("month", "total", "place", "record.*"))


@query
def top_of_month(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.top_of_month(top(spark, folder), "1997-03-01", 5))


@query
def history_of_class(spark: SparkSession, folder: str) -> DataFrame:
    """One class by its first subclass, and by a subclass given."""
    facts = fact(spark, folder)
    first = reports.class_history(facts, "7").withColumn("asked", F.lit("class"))
    given = reports.class_history(facts, "7", "F").withColumn("asked", F.lit("subclass"))
    return rounded(first.unionByName(given))


@query
def kpis_of_empty_month(spark: SparkSession, folder: str) -> DataFrame:
    rates = orders_benchmark(spark, folder)
    return rounded(reports.month_kpis(fact(spark, folder), rates, MIN_DAYS, "2031-05-01"))


@query
def untyped_series(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of series of which every other one has no type."""
    facts = fact(spark, folder).withColumn(
        "class_type", F.when(F.col("class_id").cast("long") % 2 == 0, F.col("class_type"))
    )
    running = bench.cumulative_vs_benchmark(facts, orders_benchmark(spark, folder))
    kpis = bench.series_kpis(running)
    return rounded(kpis.select("class_id", "subclass_id", "class_type", "months", "cumulative_pct"), 4)


@query
def benchmark_delta(spark: SparkSession, folder: str) -> DataFrame:
    rates = orders_benchmark(spark, folder)
    return rounded(bench.top_against_benchmark(top(spark, folder), rates))


@query
def cumulative_vs_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    rates = orders_benchmark(spark, folder)
    running = bench.cumulative_vs_benchmark(fact(spark, folder), rates)
    return rounded(running, 4)


@query
def series_kpis(spark: SparkSession, folder: str) -> DataFrame:
    rates = orders_benchmark(spark, folder)
    kpis = bench.series_kpis(bench.cumulative_vs_benchmark(fact(spark, folder), rates))
    return rounded(kpis, 4)


@query
def report_table(spark: SparkSession, folder: str) -> DataFrame:
    rates = orders_benchmark(spark, folder)
    running = bench.cumulative_vs_benchmark(fact(spark, folder), rates)
    return rounded(bench.report_table(running), 4)


# Calendar.


@query
def month_spine(spark: SparkSession, folder: str) -> DataFrame:
    days = raw(spark, folder).agg(
        F.min("DT_COMPTC").alias("first"), F.max("DT_COMPTC").alias("last")
    )
    return calendar.spine_of(days)


@query
def previous_month(spark: SparkSession, folder: str) -> DataFrame:
    """Every report day with the period that an ingest on that day is for."""
    days = raw(spark, folder).select(F.col("DT_COMPTC").alias("day")).distinct()
    period = calendar.previous_month(F.col("day"))
    return days.select(
        "day",
        period.alias("period"),
        calendar.label_from_period(period).alias("label"),
        calendar.period_from_label(calendar.month_label(F.col("day"))).alias("own_period"),
        calendar.month_key(F.col("day")).alias("month_key"),
    )


# Ingest: report files, archives and the lake, each with the whole tables through it.


@query
def delimited_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Reports written as text files and read back by column name."""
    path = new_folder(spark, "delimited")
    (
        raw(spark, folder)
        .select(*reversed(RAW_COLUMNS))
        .write.option("sep", REPORT_SEPARATOR)
        .option("header", True)
        .option("encoding", REPORT_CHARSET)
        .csv(path)
    )
    return rounded(coerce_reports(delimited.scan_csv(spark, path)))


@query
def archive_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Reports packed into monthly archives, ingested, and read from the lake."""
    source, root = new_folder(spark, "archives"), new_folder(spark, "lake")
    pack_archives(labelled(spark, folder), source)
    ingest_archives(spark, source, root)
    return rounded(lake.read_lake(spark, root))


@query
def archive_status(spark: SparkSession, folder: str) -> DataFrame:
    """The status of monthly archives, some of which hold months that the lake has."""
    source, root = new_folder(spark, "archives"), new_folder(spark, "lake")
    reports_ = labelled(spark, folder)
    lake.write_lake(reports_.filter("year_month < '1997-01'"), root, gather=True)
    pack_archives(reports_, source)
    return ingest_archives(spark, source, root).select("year_month", "state", "ok", "rows")


@query
def archive_replaced(spark: SparkSession, folder: str) -> DataFrame:
    """Two archives of each month; the lake has the rows of the newer one."""
    source, root = new_folder(spark, "archives"), new_folder(spark, "lake")
    reports_ = store(labelled(spark, folder), new_folder(spark, "labelled"))
    pack_archives(reports_.filter("NR_COTST > 1"), f"{source}/z-first")
    pack_archives(reports_, f"{source}/a-second")
    ingest_archives(spark, source, root)
    return rounded(lake.read_lake(spark, root))


@query
def archive_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Every third month's archive is cut short: its status, and the rows in the lake."""
    source, root = new_folder(spark, "archives"), new_folder(spark, "lake")
    pack_archives(labelled(spark, folder), source, broken=3)
    status = ingest_archives(spark, source, root)
    counts = lake.read_lake(spark, root).groupBy("year_month").agg(F.count("*").alias("in_lake"))
    return status.join(counts, "year_month", "left").select(
        "year_month", "state", "rows", F.col("error").isNotNull().alias("has_error"),
        F.coalesce("in_lake", F.lit(0)).cast("bigint").alias("in_lake"),
    )


@query
def lake_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per month that a reader saw who began before some months were replaced, and one after."""
    reports_ = labelled(spark, folder)
    table = MonthTable(spark, new_folder(spark, "versions"), lake.LAKE_SCHEMA)
    table.replace(reports_.filter("NR_COTST > 1 OR year_month >= '1998-01'"))
    before = table.read()
    table.replace(reports_.filter("year_month < '1998-01'"))
    count = lambda rows, name: rows.groupBy("year_month").agg(F.count("*").alias(name))
    both = count(before, "rows_before").join(count(table.read(), "rows_after"), "year_month", "full")
    return both.select("year_month", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("rows_before", "rows_after")])


@query
def archives_to_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Archives ingested into a versioned lake, broken ones among them."""
    source, root = new_folder(spark, "archives"), new_folder(spark, "versions")
    pack_archives(labelled(spark, folder), source, broken=3)
    table = MonthTable(spark, root, lake.LAKE_SCHEMA)
    ingest_archives(spark, source, table)
    return rounded(table.read())


def _after_one_month(spark: SparkSession, folder: str) -> VersionedMarts:
    """Marts built while one month had other quotes and lacked series, then refreshed for that month."""
    reports_ = stored_staged(spark, folder)
    in_month = F.date_trunc("month", "as_of") == F.lit("1996-03-01").cast("date")
    other = reports_.filter(~in_month | (F.col("holders") > 1)).withColumn(
        "unit_value", F.when(in_month, F.col("unit_value") / 2).otherwise(F.col("unit_value"))
    )
    versioned = VersionedMarts(spark, new_folder(spark, "versioned-marts"), RANKING)
    versioned.build(other)
    versioned.refresh(reports_.filter(in_month), ["1996-03-01"])
    return versioned


@query
def marts_after_one_month(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after the refresh of one month: the same as of a full build."""
    return rounded(_after_one_month(spark, folder).read("fact"))


@query
def ranking_after_one_month(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_after_one_month(spark, folder).read("top"))


@query
def missing_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that are texts for a missing value, read as plain text and from archives."""
    marked = labelled(spark, folder).withColumn(
        "ID_SUBCLASSE",
        F.coalesce("ID_SUBCLASSE", F.when(F.col("CNPJ_FUNDO_CLASSE") % 2 == 0, "NA").otherwise("n/a")),
    )
    marked = store(marked, new_folder(spark, "marked"))
    path, source, root = (new_folder(spark, n) for n in ("delimited", "archives", "lake"))
    (
        marked.select(*RAW_COLUMNS)
        .write.option("sep", REPORT_SEPARATOR)
        .option("header", True)
        .option("encoding", REPORT_CHARSET)
        .csv(path)
    )
    pack_archives(marked, source)
    ingest_archives(spark, source, root)
    plain = coerce_reports(delimited.scan_csv(spark, path)).withColumn("reader", F.lit("text"))
    packed = lake.read_lake(spark, root).drop("year_month").withColumn("reader", F.lit("archive"))
    return rounded(plain.unionByName(packed))


@query
def lake_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    root = new_folder(spark, "lake")
    lake.write_lake(labelled(spark, folder), root, gather=True)
    return rounded(lake.read_lake(spark, root))


@query
def lake_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per month after the first write and after writing all months again."""
    root = new_folder(spark, "lake")
    reports_ = labelled(spark, folder)
    counts = []
    for name in ("rows_first", "rows_again"):
        lake.write_lake(reports_, root, gather=True)
        copy = new_folder(spark, name)
        per_month = lake.read_lake(spark, root).groupBy("year_month")
        per_month.agg(F.count("*").alias(name)).write.parquet(copy)
        counts.append(spark.read.parquet(copy))
    return counts[0].join(counts[1], "year_month", "full")


@query
def missing_months(spark: SparkSession, folder: str) -> DataFrame:
    """Months between first and last report in which no report lacks a quote."""
    reports_ = labelled(spark, folder)
    days = reports_.agg(F.min("DT_COMPTC").alias("first"), F.max("DT_COMPTC").alias("last"))
    present = reports_.filter(F.col("VL_QUOTA") == 0).select("year_month").distinct()
    return lake.missing_months(days, present)


@query
def batch_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return lake.batch_statistics(labelled(spark, folder))


@query
def count_distinct_ids(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder).agg(
        F.count("*").alias("rows"), F.count_distinct("CNPJ_FUNDO_CLASSE").alias("classes")
    )


@query
def distinct_ids_of_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Reports and classes of each quarter of a year that ends in a month, from bitmaps.

    They are refreshed twice: a month in the middle comes again with what follows.
    """
    reports_ = labelled(spark, folder)
    ids = DistinctIds(spark, new_folder(spark, "distinct-ids"))
    ids.refresh(reports_.filter(F.col("year_month") <= "1995-06"))
    ids.refresh(reports_.filter(F.col("year_month") >= "1995-06"))
    month = calendar.month_of(F.col("DT_COMPTC"))
    spans = reports_.select(
        calendar.month_label(F.add_months(month, -2)).alias("first"), F.col("year_month").alias("last")
    )
    return ids.of_spans(spans)


@query
def published_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, months and newest month of the published tables."""
    published = publish(stored_marts(spark, folder), new_folder(spark, "published"))
    return table_inventory(published)


@query
def inventory_with_staging(spark: SparkSession, folder: str) -> DataFrame:
    return table_inventory(stored(spark, folder))


# Data quality.


@query
def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.run_checks(**stored(spark, folder), limits=LIMITS))


@query
def quality_while_writing(spark: SparkSession, folder: str) -> DataFrame:
    """The same rules, those on single rows counted by the jobs that write the tables."""
    root, watched = new_folder(spark, "watched"), quality.watches(LIMITS)
    reports_ = store(staged(spark, folder), f"{root}/staged", watch=watched["staged"])
    marts_ = build_marts(reports_, root, RANKING, watched)
    return rounded(quality.run_checks(reports_, **marts_, limits=LIMITS, watched=watched))


@query
def repeated_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier and day of reports that differ only in their subclass."""
    return quality.repeated_keys(staged(spark, folder), ["class_id", "as_of"])


@query
def orphan_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of classes that are absent from a dimension of funded classes only."""
    tables = stored_marts(spark, folder)
    funded = tables["dimension"].filter(F.col("net_assets") > 0)
    return rounded(quality.orphan_facts(tables["fact"], funded))


@query
def ranked_without_fact(spark: SparkSession, folder: str) -> DataFrame:
    tables = stored_marts(spark, folder)
    return quality.ranked_without_fact(tables["top"], tables["fact"]).agg(
        F.count("*").alias("failures")
    )


@query
def most_ranked_in_a_month(spark: SparkSession, folder: str) -> DataFrame:
    return quality.most_ranked_in_a_month(top(spark, folder))


@query
def negative_assets(spark: SparkSession, folder: str) -> DataFrame:
    """Staged reports behind the rule on net assets far below zero."""
    rule = {r.name: r for r in quality.staged_rules(LIMITS)}[
        "staged.net_assets never far below zero"
    ]
    return rounded(quality.failing_rows(staged(spark, folder), rule))


def pack_archives(reports_: DataFrame, folder: str, broken: int | None = None) -> None:
    """One ZIP file per month below ``folder``; of every ``broken`` months one is cut short.

    A task writes its months one after the other and holds one batch of rows.
    """
    text = (
        reports_.select("year_month", *[F.col(c).cast("string") for c in RAW_COLUMNS])
        .repartition("year_month")
        .sortWithinPartitions("year_month")
    )
    target = folder.removeprefix("file:")
    pack = partial(_pack, folder=target, broken=broken)
    text.mapInArrow(pack, "path string").write.format("noop").mode("overwrite").save()


def _pack(batches: Iterable[pa.RecordBatch], folder: str, broken: int | None) -> Iterator[pa.RecordBatch]:
    month, archive, member, done = None, None, None, []
    os.makedirs(folder, exist_ok=True)

    def close() -> None:
        if archive is None:
            return
        member.close()
        archive.close()
        path = archive.filename
        if broken and int(month[-2:]) % broken == 0:
            with open(path, "r+b") as file:
                file.truncate(os.path.getsize(path) // 2)
        done.append(path)

    for batch in batches:
        for label in batch.column("year_month").unique().to_pylist():
            rows = batch.filter(compute.field("year_month") == label).select(RAW_COLUMNS)
            new = label != month
            if new:
                close()
                month, period = label, label.replace("-", "")
                archive = zipfile.ZipFile(
                    f"{folder}/reports_{period}.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1
                )
                member = archive.open(f"reports_{period}.csv", "w")
            text = io.BytesIO()
            csv.write_csv(
                rows, text, csv.WriteOptions(include_header=new, delimiter=REPORT_SEPARATOR,
                                             quoting_style="none", quoting_header="none")
            )
            member.write(text.getvalue())
    close()
    yield pa.RecordBatch.from_pydict({"path": pa.array(done, pa.string())})
