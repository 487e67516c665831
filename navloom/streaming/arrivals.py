"""The scheduled monthly ingest as a file stream: every run takes what has arrived since."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from navloom.plans.ingest import ingest_files
from navloom.sources.archives import STATUS_SCHEMA, with_period

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_arrivals(
    spark: SparkSession, source: str, lake: str, state: str, archives_per_batch: int = 1000
) -> StreamingQuery:
    """Bring archives that no earlier run has seen into ``lake``, then stop.

    Subfolders of ``source`` are looked into. A month has the rows of its newest sound
    archive, however the archives fall into batches and runs; one that is republished,
    under its old name or another, replaces the month.

    ``state`` keeps which archives are done, in ``state/checkpoint``, and the status of
    each, in ``state/status``. A batch that is run again after a failure replaces its own
    status and the months it had begun to write, so nothing is doubled.
    """
    arrived = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", archives_per_batch)
        .load(source)
    )

    def take(batch: DataFrame, number: int) -> None:
        log = f"{state}/status/batch={number}"
        ingest_files(with_period(batch), lake, log, earlier=_held(spark, state, number))

    return (
        arrived.writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _held(spark: SparkSession, state: str, number: int) -> DataFrame | None:
    """Status of the archives that batches before this one brought into the lake."""
    try:
        status = spark.read.schema(f"{STATUS_SCHEMA}, batch int").parquet(f"{state}/status")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return status.filter(f"state = 'ok' AND batch < {number}").drop("batch")
