"""Analytics on daily-quoted instruments (investment-fund classes) as Spark jobs.

Everything takes and returns lazy DataFrames; only the sinks (``sources.lake``,
``plans.warehouse``, ``plans.ingest``) start jobs.
"""
