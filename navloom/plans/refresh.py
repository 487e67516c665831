"""Marts with versions, of which only the months that changed are computed again.

A changed month of reports changes the rollup of that month, the returns of that month, and
those of the month in which each of its series reports next, since that one's opening quote
moved. The raw reports of no other month are read. From the rollup, which has one row per series
and month, the keys of later months tell where series open anew, and four columns of earlier
ones the openings; facts and rankings of other months are neither read nor written. All tables
of a version are published together, by one manifest of their versions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from navloom.operators.marts import dimension_of_rollup, monthly_fact, top_by_month
from navloom.operators.returns import BLOCK, SERIES, month_rollup, returns_of_openings, with_openings
from navloom.plans.warehouse import Ranking, schemas
from navloom.sources.snapshots import MonthTable

TABLES = ["rollup", "dimension", "fact", "top"]
#: The dimension has no months: it is one partition.
WHOLE = "whole"


@dataclass(frozen=True)
class VersionedMarts:
    """Rollup, dimension, fact and ranking below ``root``, each a :class:`MonthTable`."""

    spark: SparkSession
    root: str
    ranking: Ranking = field(default_factory=Ranking)

    def table(self, name: str) -> MonthTable:
        schema = self._schemas[name]
        by = "month"
        if name == "dimension":
            schema, by = StructType([*schema.fields]).add(WHOLE, "string"), WHOLE
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        return MonthTable(self.spark, f"{self.root}/{name}", ddl, by)

    @cached_property
    def _schemas(self) -> dict[str, StructType]:
        return schemas(self.spark)

    def versions(self) -> dict[str, int]:
        """The version of each table that the newest marts are made of; empty before the first."""
        return {name: int(version) for name, version in self._published().manifest().items()}

    def read(self, name: str, months: Iterable[str] | None = None) -> DataFrame:
        """A table of the newest marts; of facts, rankings and the rollup also some months only."""
        found = self.table(name).read(months, self.versions().get(name, 0))
        return found.drop(WHOLE) if name == "dimension" else found

    def build(self, staged: DataFrame) -> None:
        """All tables from all reports."""
        base = self._published().version()
        rollup = self.table("rollup")
        folders = rollup.write(month_rollup(staged))
        self._follow(base, rollup.publish({m: folders.get(m) for m in [*rollup.manifest(), *folders]}), None)

    def refresh(self, staged: DataFrame, months: Iterable[str]) -> None:
        """Bring the marts up to date after the reports of ``months`` (first days) changed.

        ``staged`` holds the reports of these months, all of them; reports of others are not
        looked at. A month without reports leaves the marts. Raises ``Conflict``, and changes
        nothing that readers see, if other marts were published meanwhile.
        """
        base, known = self._published().version(), self.versions()
        months = sorted({str(month) for month in months})
        rollup = self.table("rollup")
        changed = month_rollup(staged).filter(F.col("month").cast("string").isin(months))
        version = rollup.replace(changed, months, base=known["rollup"], alone=False)
        # Months, of which there are never many.
        found = self._following((known["rollup"], version), months).collect()
        self._follow(base, version, sorted({*months, *[str(row.month) for row in found]}))

    def _openings(self, version: int, months: list[str]) -> DataFrame:
        """The openings of ``months``, for which no later month is read."""
        until = self.table("rollup").read(version=version).filter(F.col("month") <= F.array_max(_days(months)))
        opened = with_openings(until.select(*BLOCK, "unit_value"))
        return opened.filter(F.col("month").cast("string").isin(months))

    def _following(self, versions: tuple[int, int], months: list[str]) -> DataFrame:
        """Where a series opens anew: its month after a changed one, before or after the change.

        The versions differ in the changed months only. With the series of both in them, the
        row before one of another month is a changed one just if it is so in some version, and
        no month before the first changed one has to be read.
        """
        (before, after), rollup = versions, self.table("rollup")
        since = rollup.read(version=after).filter(F.col("month") >= F.array_min(_days(months)))
        reported = since.select(*BLOCK).unionByName(rollup.read(months, before).select(*BLOCK))
        in_series = Window.partitionBy(*SERIES).orderBy("month")
        opened = reported.withColumn("previous_month", F.lag("month").over(in_series))
        return opened.filter(F.col("previous_month").cast("string").isin(months)).select("month").distinct()

    def _follow(self, base: int, rollup_version: int, months: list[str] | None) -> None:
        """Dimension, and facts and rankings of ``months`` (all), from a rollup; then publish."""
        known = self.versions()
        versions = {"rollup": rollup_version}
        rollup = self.table("rollup").read(version=rollup_version)
        dimension = self.table("dimension")
        rows = dimension_of_rollup(rollup).withColumn(WHOLE, F.lit("all"))
        versions["dimension"] = dimension.replace(rows, ["all"], known.get("dimension", 0), alone=False)
        keys = dimension.read(version=versions["dimension"]).drop(WHOLE)
        fact, top = self.table("fact"), self.table("top")
        if months is None:
            framed, gone = with_openings(rollup), list(fact.manifest(known.get("fact", 0)))
        else:
            here = self.table("rollup").read(months, rollup_version)
            opened = self._openings(rollup_version, months).drop("unit_value")
            framed, gone = here.join(opened, BLOCK), months
        facts = monthly_fact(returns_of_openings(framed), keys)
        versions["fact"] = fact.replace(facts, gone, known.get("fact", 0), alone=False)
        limits = self.ranking
        ranked = top_by_month(
            fact.read(months, versions["fact"]), limits.top_n, limits.min_days, limits.min_net_assets, limits.min_holders
        )
        versions["top"] = top.replace(ranked, gone, known.get("top", 0), alone=False)
        self._published().publish({name: str(version) for name, version in versions.items()}, base)

    def _published(self) -> MonthTable:
        """The manifest of table versions: its entries are tables, not months."""
        return MonthTable(self.spark, f"{self.root}/published", "", "name")


def _days(months: list[str]) -> Column:
    """The days that the texts name; null for others, and where there are none."""
    return F.array(F.lit(None).cast("date"), *[F.lit(month).try_cast("date") for month in months])
