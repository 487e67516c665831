"""Tables of monthly partitions with versions: readers see the old or the new months, never half.

The rows of a month lie in a folder that is written once and never changed. A version of the
table is a manifest: a small file that names the folder of each month. Writing months makes new
folders beside the old ones; only then a manifest is put in place by one rename, which fails if
another writer was first. A reader takes its folders from a manifest and keeps them, whatever is
written meanwhile. Only the manifest, one line per month, is read by the driver; folders of
months that a query does not ask for are neither listed nor read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from navloom.sources.shared import remove_folder

MANIFEST = "month string, folder string"


class Conflict(Exception):
    """Another writer has published a version since this one began."""


@dataclass(frozen=True)
class MonthTable:
    """A versioned table below ``root``; ``by`` is its partition column, of strings or days."""

    spark: SparkSession
    root: str
    schema: str
    by: str = "year_month"

    def version(self) -> int:
        """The newest version, 0 before the first."""
        return max(self.versions(), default=0)

    def versions(self) -> list[int]:
        files, path = self._files(f"{self.root}/manifests")
        if not files.exists(path):
            return []
        names = [str(status.getPath().getName()) for status in files.listStatus(path)]
        return sorted(int(name.removeprefix("v")) for name in names if name.startswith("v"))

    def manifest(self, version: int | None = None) -> dict[str, str]:
        """The folder of each month of a version, by default of the newest."""
        version = self.version() if version is None else version
        if not version:
            return {}
        # One row per month: four-digit years have fewer than 120,000.
        rows = self.spark.read.schema(MANIFEST).json(self._manifest(version)).collect()
        return {row.month: row.folder for row in rows}

    def months(self, version: int | None = None) -> DataFrame:
        months = [(month,) for month in self.manifest(version)]
        return self.spark.createDataFrame(months, f"{self.by} string")

    def read(self, months: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version, of all months or of the named ones only."""
        folders = self.manifest(version)
        chosen = folders if months is None else {str(m): folders[str(m)] for m in months if str(m) in folders}
        wanted = StructType.fromDDL(self.schema)
        if not chosen:
            return self.spark.createDataFrame([], wanted)
        reader = self.spark.read.option("basePath", f"{self.root}/data")
        found = reader.schema(StructType([*wanted.fields]).add("part", "string")).parquet(
            *[f"{self.root}/data/{folder}" for folder in chosen.values()]
        )
        return found.select(*[f"`{name}`" for name in wanted.names])

    def write(self, rows: DataFrame) -> dict[str, str]:
        """Store rows in folders of their own, which no reader knows; returns those folders.

        Rows of a month are gathered by a rebalance, large months in several files.
        """
        part = f"part={uuid.uuid4().hex}"
        names = StructType.fromDDL(self.schema).names
        laid = rows.select(*names).hint("rebalance", self.by)
        laid.write.option("compression", "snappy").partitionBy(self.by).parquet(f"{self.root}/data/{part}")
        files, path = self._files(f"{self.root}/data/{part}")
        found = [str(s.getPath().getName()) for s in files.listStatus(path) if s.isDirectory()]
        return {name.partition("=")[2]: f"{part}/{name}" for name in found}

    def publish(self, changed: dict[str, str | None], base: int | None = None, alone: bool = True) -> int:
        """A version with the months of version ``base`` (the newest) but for the changed ones.

        A month changed to None is left out. With ``alone`` a ``base`` that is not the newest
        any more raises :class:`Conflict`.
        """
        newest = self.version()
        base = newest if base is None else base
        if alone and base != newest:
            raise Conflict(f"version {newest} was published after version {base}")
        entries = {**self.manifest(base), **changed}
        rows = [(month, folder) for month, folder in sorted(entries.items()) if folder]
        draft = f"{self.root}/drafts/{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(draft)
        files, target = self._files(f"{self.root}/manifests")
        files.mkdirs(target)
        self._rename(draft, self._manifest(newest + 1))
        return newest + 1

    def replace(
        self, rows: DataFrame, months: Iterable[str] = (), base: int | None = None, alone: bool = True
    ) -> int:
        """Replace exactly the months that ``rows`` holds, all at once; other months stay.

        Of the named ``months`` those without rows leave the table. For ``base`` and ``alone``
        see :meth:`publish`.
        """
        base = self.version() if base is None else base
        gone = {str(month): None for month in months}
        return self.publish({**gone, **self.write(rows)}, base, alone)

    def forget(self, keep: int = 2) -> int:
        """Remove all but the newest ``keep`` versions, and folders that none of those names.

        Call it when no reader of an older version and no writer is at work. Returns the number of
        removed folders of months.
        """
        versions = self.versions()
        kept = versions[-keep:]
        named = {folder for version in kept for folder in self.manifest(version).values()}
        for version in versions[: len(versions) - len(kept)]:
            remove_folder(self.spark, self._manifest(version))
        files, data = self._files(f"{self.root}/data")
        removed = 0
        for part in files.listStatus(data) if files.exists(data) else []:
            for month in files.listStatus(part.getPath()):
                name = f"{part.getPath().getName()}/{month.getPath().getName()}"
                if month.isDirectory() and name not in named:
                    remove_folder(self.spark, f"{self.root}/data/{name}")
                    removed += 1
        return removed

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/v{version:012d}"

    def _files(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _rename(self, source: str, target: str) -> None:
        """Put a folder in place unless there is one: the file system decides which writer is first."""
        jvm, configuration = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        hadoop = jvm.org.apache.hadoop.fs
        options = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        place = hadoop.Path(target)
        try:
            hadoop.FileContext.getFileContext(place.getFileSystem(configuration).getUri(), configuration).rename(
                hadoop.Path(source), place, options
            )
        except Exception as problem:
            files, _ = self._files(target)
            if files.exists(place):
                raise Conflict(f"{target} was published by another writer") from problem
            raise


