"""A refresh orders the rows of the months it needs, once, and not of all months."""

from navloom.plans import refresh
from navloom.plans.warehouse import Ranking
from tests.conftest import day

MONTHS = [f"2025-{m:02d}-01" for m in range(1, 10)]


def test_months_that_a_refresh_orders(spark, make_staged, tmp_path, monkeypatch):
    """April changes: a series without May, one that only had April, one that only gets it."""
    def rows(april, gone):
        reports = []
        for n, month in enumerate(MONTHS):
            for name, missing in (("one", ()), ("two", (5,)), ("three", (4, 5, 6)), ("four", (2, 3, 4))):
                # ``four`` and ``three`` differ in whether April was or is reported.
                has = n + 1 not in missing and not (n == 3 and name in gone)
                if has or (n == 3 and name not in gone and name in ("three", "four")):
                    for d in (3, 17):
                        reports.append((name, None, f"{month[:8]}{d:02d}", 10.0 + n * d + (april if n == 3 else 0)))
        return make_staged(reports)

    ranking = Ranking(top_n=3, min_days=1, min_net_assets=1.0, min_holders=1)
    marts = refresh.VersionedMarts(spark, str(tmp_path / "marts"), ranking)
    marts.build(rows(5.0, gone=("three",)))
    ordered, make = [], refresh.with_openings
    monkeypatch.setattr(refresh, "with_openings", lambda table: ordered.append(table) or make(table))
    now = rows(1.0, gone=("four",))
    marts.refresh(now.filter("as_of >= '2025-04-01' and as_of < '2025-05-01'"), ["2025-04-01"])
    # The last month in which a series without April or more opens anew is July.
    assert [table.agg({"month": "max"}).first()[0] for table in ordered] == [day("2025-07-01")]
    whole = refresh.VersionedMarts(spark, str(tmp_path / "whole"), ranking)
    whole.build(now)
    for name in refresh.TABLES:
        got, expected = (sorted(map(str, m.read(name).collect())) for m in (marts, whole))
        assert got == expected and got


def test_months_that_follow_in_either_version(spark, make_staged, tmp_path):
    """Also for no months, months without reports and texts that are no days."""
    old = [("a", None, f"2025-{m:02d}-05", 10.0 + m) for m in (1, 2, 5, 8)]
    new = [("a", None, "2025-01-05", 11.0), ("b", None, "2025-03-05", 9.0), ("a", None, "2025-05-05", 15.0),
           ("a", None, "2025-08-05", 18.0)]
    marts = refresh.VersionedMarts(spark, str(tmp_path / "marts"))
    marts.build(make_staged([*old, ("b", None, "2025-06-05", 3.0)]))
    marts.refresh(make_staged(new[1:2]), ["2025-02-01", "2025-03-01"])
    following = lambda months: sorted(str(r.month) for r in marts._following((1, 2), months).collect())
    assert following(["2025-02-01", "2025-03-01"]) == ["2025-05-01", "2025-06-01"]
    assert following([]) == following(["no day"]) == following(["2026-01-01"]) == []
    marts.refresh(make_staged([]), [])
    assert sorted(str(r.month) for r in marts.read("rollup").collect()) == [
        "2025-01-01", "2025-03-01", "2025-05-01", "2025-06-01", "2025-08-01"
    ]
