"""Versions of month tables, archives opened once, and marts refreshed by month."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from navloom.plans.ingest import ingest_archives
from navloom.plans.refresh import VersionedMarts
from navloom.plans.warehouse import Ranking, build_marts
from navloom.sources import archives, lake
from navloom.sources.snapshots import Conflict, MonthTable
from tests.conftest import BROKEN, VALID, archive

SCHEMA = "value bigint, year_month string"


@pytest.fixture
def table(spark, tmp_path):
    return MonthTable(spark, str(tmp_path / "table"), SCHEMA)


@pytest.fixture
def rows(spark):
    return lambda *pairs: spark.createDataFrame(pairs, SCHEMA)


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_a_reader_sees_the_old_or_the_new_month(table, rows):
    assert table.version() == 0 and found(table.read()) == [] and found(table.months()) == []
    table.replace(rows((1, "2026-01"), (2, "2026-02")))
    before = table.read()
    folders = table.write(rows((3, "2026-02"), (4, "2026-03")))
    # Written, but not published: nobody sees it.
    assert found(table.read()) == found(before) == [(1, "2026-01"), (2, "2026-02")]
    assert table.publish(folders) == 2
    assert found(before) == [(1, "2026-01"), (2, "2026-02")]
    assert found(table.read()) == [(1, "2026-01"), (3, "2026-02"), (4, "2026-03")]
    assert found(table.read(version=1)) == found(before)
    assert found(table.months()) == [("2026-01",), ("2026-02",), ("2026-03",)]


def test_named_months_alone_are_listed_and_read(table, rows):
    table.replace(rows((1, "2026-01"), (2, "2026-02"), (3, "2026-03")))
    some = table.read(["2026-02", "2031-01"])
    assert found(some) == [(2, "2026-02")]
    assert all("year_month=2026-02" in path for path in some.inputFiles())
    assert found(table.read(["2031-01"])) == []


def test_months_without_rows_leave(table, rows):
    table.replace(rows((1, "2026-01"), (2, "2026-02")))
    table.replace(rows((5, "2026-02")), months=["2026-01", "2026-02"])
    assert found(table.read()) == [(5, "2026-02")]
    table.replace(rows((5, "2026-02")).limit(0), months=["2026-02"])
    assert found(table.read()) == [] and found(table.read(version=1)) == [(1, "2026-01"), (2, "2026-02")]


def test_the_second_of_two_writers_is_told(table, rows, monkeypatch):
    table.replace(rows((1, "2026-01")))
    folders = table.write(rows((2, "2026-01")))
    table.replace(rows((3, "2026-02")))
    with pytest.raises(Conflict):
        table.publish(folders, base=1)
    # Both look at the same time: the file system decides.
    monkeypatch.setattr(MonthTable, "version", lambda self: 1)
    with pytest.raises(Conflict):
        table.publish(folders)
    monkeypatch.undo()
    assert found(table.read()) == [(1, "2026-01"), (3, "2026-02")]
    assert table.publish(folders) == 3
    assert found(table.read()) == [(2, "2026-01"), (3, "2026-02")]


def test_old_versions_go(table, rows):
    for value in range(4):
        table.replace(rows((value, "2026-01"), *[(9, "2026-02")] * (value == 0)))
    assert table.forget(keep=2) == 2
    assert table.versions() == [3, 4]
    assert found(table.read()) == [(3, "2026-01"), (9, "2026-02")]
    assert found(table.read(version=3)) == [(2, "2026-01"), (9, "2026-02")]
    assert table.forget(keep=2) == 0


def test_an_archive_is_opened_once(spark, tmp_path, monkeypatch):
    contents = {"202601": archive(VALID), "202602": archive(BROKEN), "202603": b"no zip", "202604": archive(VALID)[:-30]}
    paths = []
    for period, content in contents.items():
        path = tmp_path / f"reports_{period}.zip"
        path.write_bytes(content)
        paths.append(f"file:{path}")
    opened, real = [], archives.open_archive

    def counted(path):
        opened.append(path)
        return real(path)

    monkeypatch.setattr(archives, "open_archive", counted)
    batch = pa.RecordBatch.from_pydict({
        "path": [*paths, "file:/nodate.zip"],
        "year_month": ["2026-01", "2026-02", "2026-03", "2026-04", None],
        "modified": pa.array([0] * 5, pa.timestamp("us", "UTC")),
        "archive": [5, 6, 7, 8, 9],
    })
    out = pa.Table.from_batches(archives._read_through([batch])).to_pylist()
    assert opened == paths
    closing = [r for r in out if r["ok"] is not None]
    assert [(r["archive"], r["ok"], r["rows"], r["error"] is None) for r in closing] == [
        (5, True, 3, True), (6, False, 0, False), (7, False, 0, False), (8, False, 0, False), (9, False, 0, False),
    ]
    assert [r["archive"] for r in out if r["ok"] is None] == [5, 5, 5]
    # The ingest has one Python pass over the archives, and its rows are not shuffled in it.
    files = archives.archive_files(spark, str(tmp_path))
    plan = archives.staged_archives(files)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan and "content" not in plan


def test_half_an_archive_stays_in_staging(spark, tmp_path):
    """Rows before a break are staged, and neither promoted nor left behind."""
    line = "FIF;{0};;2026-04-01;1;1;1;1;1;{0}\n"
    text = VALID + "".join(line.format(n) for n in range(300_000)) + "x;y;z;2026-04-02;1;1;1;1;1;1;too many\n"
    source = tmp_path / "archives"
    source.mkdir()
    (source / "reports_202604.zip").write_bytes(archive(text))
    (source / "reports_202605.zip").write_bytes(archive(VALID))
    staged = archives.staged_archives(archives.archive_files(spark, str(source)))
    counts = {r.year_month: r["count"] for r in staged.filter("ok is null").groupBy("year_month").count().collect()}
    assert 0 < counts["2026-04"] < 300_004 and counts["2026-05"] == 3
    table = MonthTable(spark, str(tmp_path / "lake"), lake.LAKE_SCHEMA)
    status = {r.year_month: (r.state, r["rows"]) for r in ingest_archives(spark, str(source), table).collect()}
    assert status == {"2026-04": ("failed", 0), "2026-05": ("ok", 3)}
    assert table.read().count() == 3
    again = ingest_archives(spark, str(source), table)
    assert {r.year_month: r.state for r in again.collect()} == {"2026-04": "failed", "2026-05": "present"}


RANKING = Ranking(top_n=3, min_days=1, min_net_assets=0.0, min_holders=1)


def series(chance, names, months):
    """Reports with gaps: some series miss months, some have one only."""
    rows = []
    for name in names:
        for month in months:
            for day in (3, 11, 27):
                if chance.random() < 0.55:
                    rows.append((name, None, f"{month}-{day:02d}", round(chance.uniform(1, 9), 3)))
    return rows


def test_refreshed_marts_equal_those_of_a_full_build(spark, make_staged, tmp_path):
    chance = random.Random(3)
    months = ["2025-11", "2025-12", "2026-01", "2026-02", "2026-04", "2026-05"]
    rows = series(chance, [f"c{i}" for i in range(12)], months)
    marts = VersionedMarts(spark, str(tmp_path / "marts"), RANKING)
    assert marts.read("fact").count() == 0
    marts.build(make_staged(rows))
    steps = [
        ["2026-01"], ["2025-11", "2026-02"], ["2026-03"], ["2026-05"], ["2025-12", "2026-01"],
    ]
    for n, changed in enumerate(steps):
        kept = [r for r in rows if r[2][:7] not in changed]
        # Some series vanish from the month, others come; at the last step nobody reports.
        fresh = [] if n == len(steps) - 1 else series(chance, [f"c{i}" for i in range(3 + n, 14)], changed)
        rows = kept + fresh
        before = marts.read("fact")
        seen = found(before)
        marts.refresh(make_staged(fresh), [f"{m}-01" for m in changed])
        assert found(before) == seen
        full = build_marts(make_staged(rows), str(tmp_path / f"full{n}"), RANKING)
        for name in ("dimension", "fact", "top"):
            assert sorted(map(str, found(marts.read(name)))) == sorted(map(str, found(full[name].select(*marts.read(name).columns))))


def test_a_refresh_leaves_other_months_alone(spark, make_staged, tmp_path):
    rows = [(c, None, f"2026-{m:02d}-{d:02d}", 1.0 + m + d / 10) for c in ("a", "b") for m in range(1, 7) for d in (1, 9)]
    marts = VersionedMarts(spark, str(tmp_path / "marts"), RANKING)
    marts.build(make_staged(rows))
    before = marts.table("fact").manifest()
    marts.refresh(make_staged([r for r in rows if r[2][:7] == "2026-03"]), ["2026-03-01"])
    after = marts.table("fact").manifest()
    # The month itself and the next one, whose opening quote moved.
    assert {m for m in after if after[m] != before[m]} == {"2026-03-01", "2026-04-01"}
    top = marts.table("top")
    assert {m for m in top.manifest() if top.manifest()[m] != top.manifest(1)[m]} == {"2026-03-01", "2026-04-01"}
    rollup = marts.table("rollup")
    assert {m for m in rollup.manifest() if rollup.manifest()[m] != rollup.manifest(1)[m]} == {"2026-03-01"}
    assert all("month=2026-03-01" in p for p in marts.read("fact", ["2026-03-01"]).inputFiles())
    assert marts.read("fact").filter(F.col("month") == "2026-03-01").count() == 2


def test_marts_published_meanwhile_are_not_overwritten(spark, make_staged, tmp_path, monkeypatch):
    rows = [("a", None, f"2026-{m:02d}-09", float(m)) for m in range(1, 4)]
    marts = VersionedMarts(spark, str(tmp_path / "marts"), RANKING)
    marts.build(make_staged(rows))
    real = VersionedMarts._following

    def slow(self, version, months):
        monkeypatch.setattr(VersionedMarts, "_following", real)
        marts.refresh(make_staged([("a", None, "2026-02-09", 7.0)]), ["2026-02-01"])
        return real(self, version, months)

    monkeypatch.setattr(VersionedMarts, "_following", slow)
    with pytest.raises(Conflict):
        marts.refresh(make_staged([("a", None, "2026-03-09", 8.0)]), ["2026-03-01"])
    quotes = {str(r.month): r.month_return for r in marts.read("fact").collect()}
    assert quotes == {"2026-02-01": 6.0, "2026-03-01": pytest.approx(3 / 7 - 1)}
