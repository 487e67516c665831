import io
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from navloom.fixed_values import RAW_COLUMNS
from navloom.operators.staging import coerce_reports, stage_reports
from navloom.plans.ingest import failed, ingest_archives
from navloom.sources import archives, delimited, lake
from navloom.streaming.arrivals import ingest_arrivals
from tests.conftest import BROKEN, HEADER, VALID, archive, day


@pytest.fixture
def drop(tmp_path):
    """Folder of archives, filled by ``drop(period=content, ...)``."""
    folder = tmp_path / "archives"
    folder.mkdir()

    def put(**contents):
        for period, content in contents.items():
            (folder / f"reports_{period.lstrip('p')}.zip").write_bytes(content)
        return str(folder)

    return put


def status_of(frame):
    return {r.year_month: r for r in frame.collect()}


def test_valid_archive(spark, drop):
    rows, status = archives.read_archives(spark, drop(p202604=archive(VALID)))
    found = coerce_reports(rows).orderBy("CNPJ_FUNDO_CLASSE").collect()
    assert len(found) == 3
    assert found[0].asDict() == {
        "year_month": "2026-04",
        "TP_FUNDO_CLASSE": "KIND A",
        "CNPJ_FUNDO_CLASSE": "alpha",
        "ID_SUBCLASSE": None,
        "DT_COMPTC": day("2026-04-07"),
        "VL_TOTAL": 734.25,
        "VL_QUOTA": 4.5,
        "VL_PATRIM_LIQ": 701.0,
        "CAPTC_DIA": 12.0,
        "RESG_DIA": 0.5,
        "NR_COTST": 17,
    }
    statistics = lake.batch_statistics(coerce_reports(rows)).first()
    assert (statistics["rows"], statistics["classes"]) == (3, 3)
    assert [(r.ok, r["rows"], r.error) for r in status.collect()] == [(True, 3, None)]


def test_broken_archives_are_named_and_the_others_go_on(spark, drop, tmp_path):
    source = drop(
        p202601=archive(BROKEN),
        p202602=archive("no report", "readme.txt"),
        p202603=b"not a zip",
        p202604=archive(VALID),
        p202605=archive(VALID + "x;y;z;2026-04-02;1;1;1;1;1;1;too many\n"),
        nodate=archive(VALID),
    )
    root = str(tmp_path / "lake")
    status = ingest_archives(spark, source, root)
    by_month = status_of(status)
    assert {m: r.ok for m, r in by_month.items()} == {
        "2026-01": False, "2026-02": False, "2026-03": False, "2026-04": True,
        "2026-05": False, None: False,
    }
    assert "layout changed" in by_month["2026-01"].error
    assert "NR_COTST" in by_month["2026-01"].error
    assert "no CSV" in by_month["2026-02"].error
    assert "BadZipFile" in by_month["2026-03"].error
    assert "period" in by_month[None].error
    assert failed(status).count() == 5
    assert [r.year_month for r in lake.read_lake(spark, root).collect()] == ["2026-04"] * 3


def test_layout_and_text_details(spark, drop):
    columns = ["EXTRA", *reversed(RAW_COLUMNS)]
    cells = {c: "" for c in columns} | {
        "TP_FUNDO_CLASSE": "Ações São João",
        "CNPJ_FUNDO_CLASSE": '"with;separator"',
        "DT_COMPTC": "bad day",
        "VL_QUOTA": "1.5",
        "VL_TOTAL": "n/a",
        "NR_COTST": "NULL",
    }
    short = ";".join(["e", "7", "1"])
    text = "\n".join([";".join(columns), ";".join(cells[c] for c in columns), "", short]) + "\n"
    rows, _ = archives.read_archives(spark, drop(p202604=archive(text)))
    long, filled = sorted(coerce_reports(rows).collect(), key=lambda r: r.NR_COTST or 0)
    assert long.TP_FUNDO_CLASSE == "Ações São João"
    assert long.CNPJ_FUNDO_CLASSE == "with;separator"
    assert (long.ID_SUBCLASSE, long.DT_COMPTC, long.VL_TOTAL, long.NR_COTST) == (None,) * 4
    assert long.VL_QUOTA == 1.5
    assert (filled.NR_COTST, filled.RESG_DIA, filled.CAPTC_DIA) == (7, 1.0, None)


def test_first_report_file_counts_and_large_files_stream(spark, drop, monkeypatch):
    monkeypatch.setattr(archives, "BLOCK_BYTES", 1 << 12)
    line = "FIF;{0};;2026-04-01;1;1;1;1;1;{0}\n"
    body = HEADER + "\n" + "".join(line.format(n) for n in range(5000)) + "FIF;last;1\n"
    batches = list(archives._batches(io.BytesIO(archive(body))))
    assert len(batches) > 10
    assert sum(b.num_rows for b in batches) == 5001


def test_archives_are_opened_by_path(spark, drop, tmp_path):
    """Odd names, a subfolder; and no content of archives in any scan or exchange."""
    source = drop(p202603=archive(VALID))
    odd = tmp_path / "archives" / "a b%20c+é"
    odd.mkdir()
    (odd / "reports_202604.zip").write_bytes(archive(VALID))
    files = archives.archive_files(spark, source)
    assert files.columns == ["path", "year_month", "modified", "bytes"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        status = archives.newest_sound(archives.archive_status(files))
        rows = archives.archive_rows(archives.readable(files, status))
        assert rows.count() == 6
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "content" not in plan and "REBALANCE" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_months_are_skipped_or_replaced(spark, drop, tmp_path):
    root = str(tmp_path / "lake")

    def states(status):
        return {r.year_month: r.state for r in status.collect()}

    source = drop(p202603=archive(VALID), p202604=archive(VALID))
    assert states(ingest_archives(spark, source, root)) == {"2026-03": "ok", "2026-04": "ok"}
    again = ingest_archives(spark, source, root)
    assert states(again) == {"2026-03": "present", "2026-04": "present"}
    assert lake.read_lake(spark, root).count() == 6

    one_line = "\n".join(VALID.splitlines()[:2]) + "\n"
    drop(p202604=archive(one_line), p202605=archive(VALID))
    log = str(tmp_path / "log")
    assert states(ingest_archives(spark, source, root, log=log))["2026-05"] == "ok"
    assert spark.read.parquet(log).count() == 3
    assert lake.read_lake(spark, root).count() == 9

    again = ingest_archives(spark, source, root, skip_present=False)
    assert set(states(again).values()) == {"ok"}
    counts = {r.year_month: r["rows"] for r in lake.batch_statistics(lake.read_lake(spark, root)).collect()}
    assert counts == {"2026-03": 3, "2026-04": 1, "2026-05": 3}


def versions(folder):
    """Three archives of one month, of 3, 1 and 2 rows; the newest is broken. One of another."""
    lines = VALID.splitlines()
    contents = {
        "b/reports_202604.zip": archive(VALID),
        "a/reports_202604.zip": archive("\n".join(lines[:2]) + "\n"),
        "c/late_202604.zip": archive("\n".join(lines[:3]) + "\n")[:-30],
        "c/reports_202605.zip": archive(VALID),
    }
    for age, (name, content) in enumerate(contents.items()):
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
        os.utime(path, (1_700_000_000 + age * 10,) * 2)


def test_a_month_has_the_rows_of_its_newest_sound_archive(spark, tmp_path):
    versions(tmp_path / "archives")
    root = str(tmp_path / "lake")
    status = ingest_archives(spark, str(tmp_path / "archives"), root)
    found = {r.path.split("/archives/")[1]: r.state for r in status.collect()}
    assert found == {
        "b/reports_202604.zip": "superseded", "a/reports_202604.zip": "ok",
        "c/late_202604.zip": "failed", "c/reports_202605.zip": "ok",
    }
    assert lake.read_lake(spark, root).filter("year_month = '2026-04'").count() == 1


@pytest.mark.parametrize("per_batch", [1, 10])
def test_lakes_are_equal_at_any_batch_size(spark, tmp_path, per_batch):
    versions(tmp_path / "archives")
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")
    query = ingest_arrivals(spark, str(tmp_path / "archives"), root, state, per_batch)
    assert query.awaitTermination(240)
    months = lake.read_lake(spark, root).groupBy("year_month").count().collect()
    assert {r.year_month: r["count"] for r in months} == {"2026-04": 1, "2026-05": 3}
    assert spark.read.parquet(f"{state}/status").count() == 4


def test_missing_cells_are_null_from_both_readers(spark, drop, tmp_path):
    text = f"{HEADER}\nNone;a;NA;2026-04-01;1;1;1;1;1;1\nFIF;b;n/a;2026-04-01;1;1;1;1;1;1\n"
    (tmp_path / "a.csv").write_text(text)
    plain = coerce_reports(delimited.scan_csv(spark, str(tmp_path / "a.csv")))
    packed, _ = archives.read_archives(spark, drop(p202604=archive(text)))
    for frame in (plain, coerce_reports(packed)):
        rows = frame.orderBy("CNPJ_FUNDO_CLASSE").collect()
        assert [(r.TP_FUNDO_CLASSE, r.ID_SUBCLASSE) for r in rows] == [(None, None), ("FIF", None)]


def test_stream_takes_each_archive_once(spark, drop, tmp_path):
    root, state = str(tmp_path / "lake"), str(tmp_path / "state")

    def run():
        query = ingest_arrivals(spark, source, root, state)
        assert query.awaitTermination(120)

    source = drop(p202603=archive(VALID), p202602=archive(BROKEN))
    run()
    drop(p202604=archive(VALID))
    run()
    assert lake.read_lake(spark, root).count() == 6
    status = spark.read.parquet(f"{state}/status")
    assert {r.year_month: r.ok for r in status.collect()} == {
        "2026-02": False, "2026-03": True, "2026-04": True,
    }


def test_lake_reads_pruned_months_and_statistics(spark, drop, tmp_path):
    root = str(tmp_path / "lake")
    ingest_archives(spark, drop(p202603=archive(VALID), p202604=archive(VALID)), root)
    april = lake.read_lake(spark, root, ["2026-04"])
    assert april.count() == 3
    plan = april._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    rows = lake.stored_statistics(spark, root).orderBy("year_month").collect()
    assert [(r.year_month, r["rows"], r.classes) for r in rows] == [
        ("2026-03", 3, 3), ("2026-04", 3, 3),
    ]
    assert all(r.bytes > 0 for r in rows)
    assert stage_reports(lake.read_lake(spark, root)).count() == 6


def test_missing_months(spark, drop, tmp_path):
    root = str(tmp_path / "lake")
    bounds = spark.range(1).select(
        F.lit(day("2026-02-01")).alias("first"), F.lit(day("2026-04-30")).alias("last")
    )

    def missing():
        rows = lake.missing_months(bounds, lake.lake_months(spark, root)).collect()
        return sorted(r.year_month for r in rows)

    assert missing() == ["2026-02", "2026-03", "2026-04"]
    ingest_archives(spark, drop(p202603=archive(VALID)), root)
    assert missing() == ["2026-02", "2026-04"]


def test_null_ids_are_not_distinct_classes(spark):
    frame = spark.createDataFrame(
        [("2026-04", "a"), ("2026-04", None), ("2026-04", "a")],
        "year_month string, CNPJ_FUNDO_CLASSE string",
    )
    row = lake.batch_statistics(frame).first()
    assert (row["rows"], row.classes) == (3, 1)


def test_csv_by_name(spark, tmp_path):
    path = tmp_path / "text"
    path.mkdir()
    moved = ["EXTRA", *reversed(RAW_COLUMNS)]
    cells = {c: c.lower() for c in moved} | {"ID_SUBCLASSE": "", "TP_FUNDO_CLASSE": "Ação"}
    (path / "a.csv").write_bytes(
        "\n".join([";".join(moved), ";".join(cells[c] for c in moved)]).encode("latin-1")
    )
    frame = delimited.scan_csv(spark, str(path))
    assert frame.columns == RAW_COLUMNS
    row = frame.first()
    assert (row.TP_FUNDO_CLASSE, row.ID_SUBCLASSE, row.VL_QUOTA) == ("Ação", None, "vl_quota")


def test_csv_without_a_required_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text(BROKEN)
    with pytest.raises(ValueError, match="VL_QUOTA"):
        delimited.scan_csv(spark, str(tmp_path / "a.csv"))


def test_csv_files_of_two_layouts_are_an_error(spark, tmp_path):
    path = tmp_path / "text"
    path.mkdir()
    for name, columns in (("a", RAW_COLUMNS), ("b", RAW_COLUMNS[::-1])):
        (path / f"{name}.csv").write_text(";".join(columns) + "\n" + ";".join("1" for _ in columns) + "\n")
    with pytest.raises(Exception):
        delimited.scan_csv(spark, str(path)).collect()


def test_month_folders_with_nanosecond_days(spark, tmp_path):
    folder = tmp_path / "2026-04"
    folder.mkdir()
    table = pd.DataFrame(
        {
            "TP_FUNDO_CLASSE": ["FIF"] * 2,
            "CNPJ_FUNDO_CLASSE": ["a", "b"],
            "ID_SUBCLASSE": [None, "1"],
            "DT_COMPTC": pd.to_datetime(["2026-04-01", None]).astype("datetime64[ns]"),
            "VL_TOTAL": [1.0, 2.0],
            "VL_QUOTA": [1.1, 2.2],
            "VL_PATRIM_LIQ": [1.0, None],
            "CAPTC_DIA": [0.0, 0.0],
            "RESG_DIA": [0.0, 0.0],
            "NR_COTST": [3.0, None],
        }
    )
    pq.write_table(
        pa.Table.from_pandas(table, preserve_index=False), folder / "reports.parquet", version="2.6"
    )
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        frame = lake.read_month_folders(spark, str(tmp_path))
        rows = frame.orderBy("CNPJ_FUNDO_CLASSE").collect()
        assert [(r.DT_COMPTC, r.year_month) for r in rows] == [
            (day("2026-04-01"), "2026-04"), (None, "2026-04"),
        ]
        staged = stage_reports(frame).collect()
        assert [(r.class_id, r.holders) for r in staged] == [("a", 3)]
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")
