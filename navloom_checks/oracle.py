"""The results of ``navloom_checks.queries`` as plain SQL over the given tables."""

from __future__ import annotations

from navloom.fixed_values import NO_TYPE_LABEL

RAW = """
raw AS (
  SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS "TP_FUNDO_CLASSE",
         CAST(l_suppkey AS VARCHAR) AS "CNPJ_FUNDO_CLASSE",
         NULLIF(l_linestatus, 'O') AS "ID_SUBCLASSE",
         CAST(l_shipdate AS DATE) AS "DT_COMPTC",
         MAX(l_extendedprice) * 1000 AS "VL_TOTAL",
         CASE WHEN MAX(l_discount) = 0 AND MAX(l_tax) = 0 THEN 0.0
              ELSE MAX(l_extendedprice) END AS "VL_QUOTA",
         CAST((SUM(CAST(l_quantity AS BIGINT)) - 3)
              * CAST(POW(10, 4 + l_suppkey % 6) AS BIGINT) AS DOUBLE) AS "VL_PATRIM_LIQ",
         MAX(l_quantity) AS "CAPTC_DIA",
         MIN(l_quantity) AS "RESG_DIA",
         COUNT(*) AS "NR_COTST"
  FROM lineitem
  GROUP BY l_suppkey, NULLIF(l_linestatus, 'O'), CAST(l_shipdate AS DATE)
)"""

STAGED = RAW + """,
staged AS (
  SELECT "TP_FUNDO_CLASSE" AS class_type, "CNPJ_FUNDO_CLASSE" AS class_id,
         "ID_SUBCLASSE" AS subclass_id, "DT_COMPTC" AS as_of, "VL_TOTAL" AS total_value,
         "VL_QUOTA" AS unit_value, "VL_PATRIM_LIQ" AS net_assets, "CAPTC_DIA" AS inflow,
         "RESG_DIA" AS outflow, "NR_COTST" AS holders
  FROM raw
  WHERE "CNPJ_FUNDO_CLASSE" IS NOT NULL AND "DT_COMPTC" IS NOT NULL AND "VL_QUOTA" > 0
)"""

DAILY = STAGED + """,
lagged AS (
  SELECT class_id, COALESCE(subclass_id, '__sem_subclasse__') AS subclass_id, class_type,
         as_of, unit_value, net_assets, holders, inflow, outflow,
         LAG(unit_value) OVER (
           PARTITION BY class_id, COALESCE(subclass_id, '__sem_subclasse__') ORDER BY as_of
         ) AS previous_unit_value
  FROM staged
),
daily AS (
  SELECT *, CASE WHEN previous_unit_value <> 0
                 THEN unit_value / previous_unit_value - 1 END AS day_return
  FROM lagged
)"""

MONTHLY = DAILY + """,
monthly AS (
  SELECT class_id, subclass_id, MIN(class_type) AS class_type,
         CAST(DATE_TRUNC('month', as_of) AS DATE) AS month,
         COUNT(*) AS obs_days,
         EXP(SUM(LN(1 + day_return))) - 1 AS month_return,
         ARG_MAX(net_assets, as_of) AS month_end_net_assets,
         ARG_MAX(holders, as_of) AS month_end_holders
  FROM daily
  WHERE day_return IS NOT NULL
  GROUP BY class_id, subclass_id, CAST(DATE_TRUNC('month', as_of) AS DATE)
)"""

DIMENSION = """,
dimension AS (
  SELECT MD5(class_id || '|' || COALESCE(subclass_id, '__sem_subclasse__')) AS class_key,
         class_id, COALESCE(subclass_id, '__sem_subclasse__') AS subclass_id,
         MIN(class_type) AS class_type, MIN(as_of) AS first_day, MAX(as_of) AS last_day,
         ARG_MAX(net_assets, as_of) AS net_assets, ARG_MAX(holders, as_of) AS holders
  FROM staged
  GROUP BY class_id, COALESCE(subclass_id, '__sem_subclasse__')
)"""

FACT = MONTHLY + DIMENSION + """,
fact AS (
  SELECT MD5(m.class_id || '|' || m.subclass_id || '|' || CAST(m.month AS VARCHAR))
           AS return_key,
         d.class_key, m.class_id, m.subclass_id, m.class_type, m.month, m.obs_days,
         m.month_return, m.month_end_net_assets, m.month_end_holders
  FROM monthly m JOIN dimension d
    ON m.class_id = d.class_id AND m.subclass_id = d.subclass_id
)"""

TOP = FACT + """,
ranked AS (
  SELECT *, ROW_NUMBER() OVER (
           PARTITION BY month ORDER BY month_return DESC, class_id, subclass_id) AS rank
  FROM fact
  WHERE obs_days >= 4 AND month_end_net_assets >= 1000000 AND month_end_holders >= 1
),
top AS (
  SELECT month, rank, class_id, subclass_id, class_type, obs_days, month_return,
         month_return * 100 AS return_pct, month_end_net_assets, month_end_holders
  FROM ranked WHERE rank <= 10
)"""

RATES = """,
rates AS (
  SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month,
         (COUNT(*) % 9) / 4.0::DOUBLE AS rate
  FROM orders
  WHERE EXTRACT(month FROM o_orderdate) <> 12
  GROUP BY CAST(DATE_TRUNC('month', o_orderdate) AS DATE)
)"""

SNAPSHOT = FACT + RATES + """,
snapshot AS (
  SELECT f.month, f.month_end_net_assets, f.month_return * 100 AS return_pct,
         COALESCE(r.rate, 1.10::DOUBLE) AS benchmark_pct
  FROM fact f LEFT JOIN rates r ON f.month = r.month
  WHERE f.month_end_net_assets > 0 AND f.obs_days >= 4
)"""

CUMULATIVE = FACT + RATES + """,
compared AS (
  SELECT f.*, f.month_return * 100 AS return_pct,
         COALESCE(r.rate, 1.10::DOUBLE) AS benchmark_pct
  FROM fact f LEFT JOIN rates r ON f.month = r.month
),
running AS (
  SELECT *, PRODUCT(1 + return_pct / 100) OVER to_date - 1 AS cumulative,
         PRODUCT(1 + benchmark_pct / 100) OVER to_date - 1 AS benchmark_cumulative
  FROM compared
  WINDOW to_date AS (PARTITION BY class_id, subclass_id ORDER BY month
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
cumulated AS (
  SELECT *, (cumulative - benchmark_cumulative) * 100 AS delta_cumulative_pp FROM running
)"""

HISTORY = FACT + """,
first_months AS (
  SELECT class_id, subclass_id,
         ROW_NUMBER() OVER (PARTITION BY class_id ORDER BY month, subclass_id) AS position
  FROM fact
),
history AS (
  SELECT f.* FROM fact f JOIN first_months s
    ON f.class_id = s.class_id AND f.subclass_id = s.subclass_id
  WHERE s.position = 1
)"""


def r(expression: str, name: str | None = None, places: int = 6) -> str:
    """Rounded as in ``queries.rounded``."""
    return f"ROUND(({expression}) + 1e-9, {places}) + 0.0 AS {name or expression}"


RAW_SELECT = f"""
  SELECT "TP_FUNDO_CLASSE", "CNPJ_FUNDO_CLASSE", "ID_SUBCLASSE", "DT_COMPTC",
         {r('"VL_TOTAL"')}, {r('"VL_QUOTA"')}, {r('"VL_PATRIM_LIQ"')}, {r('"CAPTC_DIA"')},
         {r('"RESG_DIA"')}, "NR_COTST" """

STAGED_SELECT = f"""
  SELECT class_type, class_id, subclass_id, as_of, {r("total_value")}, {r("unit_value")},
         {r("net_assets")}, {r("inflow")}, {r("outflow")}, holders """

MONTHLY_SELECT = f"""
  SELECT class_id, subclass_id, class_type, month, obs_days, {r("month_return")},
         {r("month_end_net_assets")}, month_end_holders """

FACT_SELECT = MONTHLY_SELECT.replace("SELECT", "SELECT return_key, class_key,", 1)

TOP_SELECT = f"""
  SELECT month, rank, class_id, subclass_id, class_type, obs_days, {r("month_return")},
         {r("return_pct")}, {r("month_end_net_assets")}, month_end_holders FROM top"""

HISTORY_SELECT = f"""
  SELECT class_id, subclass_id, class_type, month, {r("month_return")},
         {r("month_return * 100", "return_pct")}, obs_days, {r("month_end_net_assets")},
         month_end_holders FROM history"""

BAND_NO = """CASE WHEN month_end_net_assets < 1e6 THEN 1 WHEN month_end_net_assets < 1e7 THEN 2
       WHEN month_end_net_assets < 1e8 THEN 3 WHEN month_end_net_assets < 1e9 THEN 4 ELSE 5 END"""
BAND = """CASE band_no WHEN 1 THEN '< R$ 1M' WHEN 2 THEN 'R$ 1M – 10M'
       WHEN 3 THEN 'R$ 10M – 100M' WHEN 4 THEN 'R$ 100M – 1B' ELSE '> R$ 1B' END"""
SHARE_ABOVE = "AVG(CASE WHEN return_pct >= benchmark_pct THEN 1.0 ELSE 0.0 END) * 100"


def select(tables: str, body: str) -> str:
    return f"WITH {tables.strip()} {body.strip()}"


def inventory(names: list[str]) -> str:
    rows = []
    for name in names:
        months = (
            "COUNT(DISTINCT month) AS months, MAX(month) AS newest_month"
            if name in ("fact", "top")
            else "CAST(NULL AS BIGINT) AS months, CAST(NULL AS DATE) AS newest_month"
        )
        rows.append(f"""SELECT '{name}' AS "table", COUNT(*) AS "rows", {months} FROM {name}""")
    return " UNION ALL ".join(rows)


def row_rule(
    name: str, table: str, bad: str, passed: str = "failures = 0"
) -> str:
    return f"""
  SELECT '{name}' AS "check", failures, total,
         COALESCE(failures / NULLIF(total, 0), 0.0::DOUBLE) AS ratio, {passed} AS passed
  FROM (SELECT CAST(COUNT(*) FILTER (WHERE {bad}) AS BIGINT) AS failures, COUNT(*) AS total
        FROM {table})"""


def count_rule(name: str, failures: str, table: str) -> str:
    return f"""
  SELECT '{name}' AS "check", failures, total,
         COALESCE(failures / NULLIF(total, 0), 0.0::DOUBLE) AS ratio, failures = 0 AS passed
  FROM (SELECT (SELECT COUNT(*) FROM ({failures})) AS failures,
               (SELECT COUNT(*) FROM {table}) AS total)"""


def bound_rule(name: str, measured: str, passed: str) -> str:
    return f"""
  SELECT '{name}' AS "check",
         CAST(CASE WHEN {passed} THEN 0 ELSE 1 END AS BIGINT) AS failures, total,
         COALESCE(CASE WHEN {passed} THEN 0 ELSE 1 END / NULLIF(total, 0), 0.0::DOUBLE) AS ratio,
         {passed} AS passed
  FROM ({measured})"""


def repeated(table: str, columns: str) -> str:
    return f"SELECT {columns} FROM {table} GROUP BY {columns} HAVING COUNT(*) > 1"


QUALITY = [
    bound_rule("staged has enough rows", "SELECT COUNT(*) AS total FROM staged", "total > 1000"),
    bound_rule(
        "dimension has enough rows", "SELECT COUNT(*) AS total FROM dimension", "total > 10"
    ),
    bound_rule(
        "fact rows per class plausible",
        "SELECT COUNT(*) AS total, (SELECT COUNT(*) FROM dimension) AS classes FROM fact",
        "total / classes BETWEEN 0.5 AND 100",
    ),
    *[
        row_rule(f"{table}.{column} not null", table, f"{column} IS NULL")
        for table, columns in {
            "staged": ["class_id", "as_of", "unit_value"],
            "dimension": ["class_key", "class_id", "last_day"],
            "fact": ["return_key", "class_key", "month"],
            "top": ["month", "rank", "class_id"],
        }.items()
        for column in columns
    ],
    row_rule("staged.unit_value positive", "staged", "unit_value <= 0"),
    row_rule("staged.holders not negative", "staged", "holders < 0"),
    row_rule(
        "staged.net_assets rarely negative",
        "staged",
        "net_assets < 0",
        "total > 0 AND failures / total < 0.001",
    ),
    row_rule("staged.net_assets never far below zero", "staged", "net_assets < -1000000"),
    row_rule("fact.obs_days plausible", "fact", "obs_days > 25"),
    row_rule(
        "fact.month_return rarely above the outlier limit",
        "fact",
        "month_return > 1.0",
        "total > 0 AND failures / total <= 0.01",
    ),
    row_rule("top.month_end_net_assets accepted", "top", "month_end_net_assets < 1000000"),
    row_rule(
        "top.month_end_holders accepted",
        "top",
        "month_end_holders < 1",
        "total > 0 AND failures = 0",
    ),
    count_rule(
        "staged series and day unique",
        repeated("staged", "class_id, subclass_id, as_of"),
        "staged",
    ),
    count_rule("dimension.class_key unique", repeated("dimension", "class_key"), "dimension"),
    count_rule("fact.return_key unique", repeated("fact", "return_key"), "fact"),
    count_rule(
        "fact.class_key in dimension",
        "SELECT 1 FROM fact f LEFT JOIN dimension d ON f.class_key = d.class_key"
        " WHERE d.class_key IS NULL",
        "fact",
    ),
    count_rule(
        "top rows exist in fact",
        "SELECT 1 FROM top t WHERE NOT EXISTS (SELECT 1 FROM fact f"
        " WHERE f.class_id = t.class_id AND f.month = t.month)",
        "top",
    ),
    bound_rule(
        "top rows per month limited",
        "SELECT MAX(n) AS total FROM (SELECT COUNT(*) AS n FROM top GROUP BY month)",
        "total <= 10",
    ),
    bound_rule(
        "top report answers",
        "SELECT COUNT(*) AS total FROM (SELECT 1 FROM top ORDER BY month DESC, rank LIMIT 10)",
        "total >= 1",
    ),
]

QUALITY_SUMMARY = select(
    TOP,
    f"""SELECT "check", failures, total, {r("ratio")}, passed
        FROM ({" UNION ALL ".join(QUALITY)})""",
)

SQL: dict[str, str] = {
    "staged_reports": select(STAGED, f"{STAGED_SELECT} FROM staged"),
    "daily_return": select(
        DAILY,
        f"""SELECT class_id, subclass_id, class_type, as_of, {r("unit_value")},
            {r("previous_unit_value")}, {r("day_return")}, {r("net_assets")}, holders,
            {r("inflow")}, {r("outflow")} FROM daily""",
    ),
    "monthly_return": select(MONTHLY, f"{MONTHLY_SELECT} FROM monthly"),
    "monthly_return_of_copies": select(
        MONTHLY.replace("FROM staged\n", "FROM (FROM staged UNION ALL FROM staged)\n"),
        f"{MONTHLY_SELECT} FROM monthly",
    ),
    "monthly_return_from_daily": select(MONTHLY, f"{MONTHLY_SELECT} FROM monthly"),
    "class_dimension": select(
        STAGED + DIMENSION,
        f"""SELECT class_key, class_id, subclass_id, class_type, first_day, last_day,
            {r("net_assets")}, holders FROM dimension""",
    ),
    "surrogate_keys": select(
        STAGED + DIMENSION,
        """SELECT class_id, subclass_id, class_key,
           MD5(COALESCE(class_id, '_dbt_utils_surrogate_key_null_') || '-' ||
               COALESCE(subclass_id, '_dbt_utils_surrogate_key_null_')) AS null_safe_key
           FROM dimension""",
    ),
    "monthly_fact": select(FACT, f"{FACT_SELECT} FROM fact"),
    "top_by_month": select(TOP, TOP_SELECT),
    "top_of_newest_month": select(
        TOP, f"{TOP_SELECT} WHERE month = (SELECT MAX(month) FROM top) AND rank <= 5"
    ),
    "ranking_report": select(
        TOP,
        f"""SELECT month, rank, class_id, class_type, {r("return_pct")}, obs_days,
            {r("month_end_net_assets")}, month_end_holders FROM top""",
    ),
    "global_top": select(TOP, f"{TOP_SELECT} ORDER BY month DESC, rank LIMIT 10"),
    "months_desc": select(FACT, "SELECT DISTINCT month FROM fact ORDER BY month DESC"),
    "newest_month": select(FACT, "SELECT MAX(month) AS month FROM fact"),
    "month_kpis": select(
        SNAPSHOT,
        f"""SELECT month, {r("benchmark_pct")}, series_count, {r("net_assets")},
            {r("median_return_pct")}, {r("share_above_pct")},
            {r("median_return_pct - benchmark_pct", "median_delta_pct")},
            {r("share_above_pct - 50", "share_delta_pct")}
            FROM (SELECT month, MAX(benchmark_pct) AS benchmark_pct, COUNT(*) AS series_count,
                         SUM(month_end_net_assets) AS net_assets,
                         MEDIAN(return_pct) AS median_return_pct, {SHARE_ABOVE} AS share_above_pct
                  FROM snapshot GROUP BY month)""",
    ),
    "size_band_report": select(
        SNAPSHOT,
        f"""SELECT month, band_no, {BAND} AS band, series_count, {r("net_assets")},
            {r("median_return_pct")}, {r("share_above_pct")}
            FROM (SELECT month, {BAND_NO} AS band_no, COUNT(*) AS series_count,
                         SUM(month_end_net_assets) AS net_assets,
                         MEDIAN(return_pct) AS median_return_pct, {SHARE_ABOVE} AS share_above_pct
                  FROM snapshot GROUP BY month, {BAND_NO})""",
    ),
    "return_distribution": select(
        SNAPSHOT,
        f"SELECT month, {r('return_pct')} FROM snapshot WHERE return_pct BETWEEN -10 AND 10",
    ),
    "distribution_median": select(
        SNAPSHOT,
        f"""SELECT month, {r("MEDIAN(return_pct)", "median_return_pct")}
            FROM snapshot WHERE return_pct BETWEEN -10 AND 10 GROUP BY month""",
    ),
    "return_histogram": select(
        SNAPSHOT
        + """,
within AS (SELECT month, LEAST(CAST(FLOOR((return_pct + 10) / (20.0::DOUBLE / 60)) AS BIGINT) + 1,
                               60) AS bin
           FROM snapshot WHERE return_pct BETWEEN -10 AND 10),
spine AS (SELECT DISTINCT w.month, s.bin FROM within w, (SELECT UNNEST(RANGE(1, 61)) AS bin) s)""",
        f"""SELECT s.month, s.bin,
            {r("-10 + (s.bin - 1) * (20.0::DOUBLE / 60)", "lower_edge")},
            COUNT(w.bin) AS "rows"
            FROM spine s LEFT JOIN within w ON s.month = w.month AND s.bin = w.bin
            GROUP BY s.month, s.bin""",
    ),
    "class_search": select(
        FACT,
        """SELECT DISTINCT class_id FROM fact WHERE month = (SELECT MAX(month) FROM fact)
           ORDER BY class_id LIMIT 50""",
    ),
    "class_prefix_search": select(
        FACT,
        """SELECT DISTINCT class_id FROM fact WHERE month = (SELECT MAX(month) FROM fact)
           AND class_id LIKE '1%' ORDER BY class_id LIMIT 200""",
    ),
    "class_history": select(HISTORY, HISTORY_SELECT),
    "series_document": select(
        HISTORY,
        f"""SELECT class_id, subclass_id,
            MIN(class_type) OVER (PARTITION BY class_id, subclass_id) AS document_type,
            CAST(ROW_NUMBER() OVER (PARTITION BY class_id, subclass_id ORDER BY month) - 1
                 AS INTEGER) AS place,
            month, {r("month_return")}, {r("month_return * 100", "return_pct")}, obs_days,
            {r("month_end_net_assets")}, month_end_holders FROM history""",
    ),
    "ranking_document": select(
        TOP,
        f"""SELECT month, COUNT(*) OVER (PARTITION BY month) AS total,
            CAST(ROW_NUMBER() OVER (PARTITION BY month ORDER BY rank) - 1 AS INTEGER) AS place,
            rank, class_id, class_type, {r("return_pct")}, obs_days,
            {r("month_end_net_assets")}, month_end_holders FROM top""",
    ),
    "top_of_month": select(TOP, f"{TOP_SELECT} WHERE month = DATE '1997-03-01' AND rank <= 5"),
    "history_of_class": select(
        HISTORY,
        f"""{HISTORY_SELECT.replace("FROM history", ", 'class' AS asked FROM history")}
            WHERE class_id = '7' UNION ALL
            {HISTORY_SELECT.replace("FROM history", ", 'subclass' AS asked FROM fact")}
            WHERE class_id = '7' AND subclass_id = 'F'""",
    ),
    "kpis_of_empty_month": """SELECT DATE '2031-05-01' AS month, 1.1::DOUBLE AS benchmark_pct,
        CAST(COUNT(*) AS BIGINT) AS series_count, 0.0::DOUBLE AS net_assets,
        0.0::DOUBLE AS median_return_pct, 0.0::DOUBLE AS share_above_pct,
        -1.1::DOUBLE AS median_delta_pct, -50.0::DOUBLE AS share_delta_pct
        FROM lineitem WHERE l_shipdate >= DATE '2031-05-01' AND l_shipdate < DATE '2031-06-01'""",
    "untyped_series": select(
        CUMULATIVE,
        f"""SELECT class_id, subclass_id,
            CASE WHEN CAST(class_id AS BIGINT) % 2 = 0 THEN MIN(class_type)
                 ELSE '{NO_TYPE_LABEL}' END AS class_type, COUNT(*) AS months,
            {r("ARG_MAX(cumulative, month) * 100", "cumulative_pct", 4)}
            FROM cumulated GROUP BY class_id, subclass_id""",
    ),
    "benchmark_delta": select(
        TOP + RATES,
        f"""SELECT t.month, t.rank, t.class_id, t.subclass_id, {r("t.return_pct", "return_pct")},
            {r("COALESCE(r.rate, 1.10::DOUBLE)", "benchmark_pct")},
            {r("t.return_pct - COALESCE(r.rate, 1.10::DOUBLE)", "delta_pct")},
            {r("GREATEST(MAX(t.return_pct) OVER (PARTITION BY t.month), "
               "COALESCE(r.rate, 1.10::DOUBLE) * 1.5)", "chart_bound_pct")}
            FROM top t LEFT JOIN rates r ON t.month = r.month""",
    ),
    "cumulative_vs_benchmark": select(
        CUMULATIVE,
        f"""SELECT class_id, subclass_id, class_type, month, {r("return_pct", places=4)},
            {r("month_end_net_assets", places=4)}, month_end_holders,
            {r("benchmark_pct", places=4)}, {r("cumulative", places=4)},
            {r("benchmark_cumulative", places=4)}, {r("delta_cumulative_pp", places=4)},
            CASE WHEN return_pct >= benchmark_pct THEN 'above' ELSE 'below' END
              AS month_position,
            CASE WHEN cumulative >= benchmark_cumulative THEN 'above' ELSE 'below' END
              AS cumulative_position
            FROM cumulated""",
    ),
    "series_kpis": select(
        CUMULATIVE,
        f"""SELECT class_id, subclass_id, MIN(class_type) AS class_type, COUNT(*) AS months,
            {r("ARG_MAX(cumulative, month) * 100", "cumulative_pct", 4)},
            {r("ARG_MAX(benchmark_cumulative, month) * 100", "benchmark_cumulative_pct", 4)},
            {r("ARG_MAX(delta_cumulative_pp, month)", "delta_cumulative_pp", 4)},
            {r("MAX(return_pct)", "best_month_pct", 4)},
            {r("MIN(return_pct)", "worst_month_pct", 4)},
            {r("STDDEV_POP(return_pct)", "volatility_pct", 4)},
            CASE WHEN ARG_MAX(cumulative, month) >= ARG_MAX(benchmark_cumulative, month)
                 THEN 'above' ELSE 'below' END AS verdict
            FROM cumulated GROUP BY class_id, subclass_id""",
    ),
    "report_table": select(
        CUMULATIVE,
        f"""SELECT class_id, subclass_id, STRFTIME(month, '%Y-%m') AS month_label,
            {r("return_pct", places=4)}, {r("benchmark_pct", places=4)},
            {r("delta_cumulative_pp", places=4)}, {r("month_end_net_assets", places=4)},
            month_end_holders FROM cumulated""",
    ),
    "month_spine": select(
        RAW,
        """SELECT CAST(month AS DATE) AS month, STRFTIME(month, '%Y-%m') AS year_month
           FROM (SELECT UNNEST(GENERATE_SERIES(
                   CAST(DATE_TRUNC('month', MIN("DT_COMPTC")) AS TIMESTAMP),
                   CAST(DATE_TRUNC('month', MAX("DT_COMPTC")) AS TIMESTAMP),
                   INTERVAL 1 MONTH)) AS month FROM raw)""",
    ),
    "previous_month": select(
        RAW,
        """SELECT DISTINCT "DT_COMPTC" AS day,
           STRFTIME(DATE_TRUNC('month', "DT_COMPTC") - INTERVAL 1 DAY, '%Y%m') AS period,
           STRFTIME(DATE_TRUNC('month', "DT_COMPTC") - INTERVAL 1 DAY, '%Y-%m') AS label,
           STRFTIME("DT_COMPTC", '%Y%m') AS own_period,
           STRFTIME("DT_COMPTC", '%Y-%m-01') AS month_key FROM raw""",
    ),
    "delimited_scan": select(RAW, f"{RAW_SELECT} FROM raw"),
    "archive_ingest": select(
        RAW, f"""{RAW_SELECT}, STRFTIME("DT_COMPTC", '%Y-%m') AS year_month FROM raw"""
    ),
    "archive_status": select(
        RAW,
        """SELECT STRFTIME("DT_COMPTC", '%Y-%m') AS year_month,
           CASE WHEN MIN("DT_COMPTC") < '1997-01-01' THEN 'present' ELSE 'ok' END AS state,
           CASE WHEN MIN("DT_COMPTC") >= '1997-01-01' THEN TRUE END AS ok,
           CASE WHEN MIN("DT_COMPTC") >= '1997-01-01' THEN COUNT(*) END AS "rows"
           FROM raw GROUP BY STRFTIME("DT_COMPTC", '%Y-%m')""",
    ),
    "archive_replaced": select(
        RAW, f"""{RAW_SELECT}, STRFTIME("DT_COMPTC", '%Y-%m') AS year_month FROM raw"""
    ),
    "archive_failures": select(
        RAW,
        """SELECT STRFTIME("DT_COMPTC", '%Y-%m') AS year_month,
           CASE WHEN MIN(MONTH("DT_COMPTC")) % 3 = 0 THEN 'failed' ELSE 'ok' END AS state,
           CASE WHEN MIN(MONTH("DT_COMPTC")) % 3 = 0 THEN 0 ELSE COUNT(*) END AS "rows",
           MIN(MONTH("DT_COMPTC")) % 3 = 0 AS has_error,
           CASE WHEN MIN(MONTH("DT_COMPTC")) % 3 = 0 THEN 0 ELSE COUNT(*) END AS in_lake
           FROM raw GROUP BY STRFTIME("DT_COMPTC", '%Y-%m')""",
    ),
    "lake_versions": select(
        RAW,
        """SELECT STRFTIME("DT_COMPTC", '%Y-%m') AS year_month,
           COUNT(*) FILTER (WHERE "NR_COTST" > 1 OR STRFTIME("DT_COMPTC", '%Y-%m') >= '1998-01') AS rows_before,
           COUNT(*) AS rows_after FROM raw GROUP BY STRFTIME("DT_COMPTC", '%Y-%m')""",
    ),
    "archives_to_versions": select(
        RAW,
        f"""{RAW_SELECT}, STRFTIME("DT_COMPTC", '%Y-%m') AS year_month FROM raw
            WHERE MONTH("DT_COMPTC") % 3 <> 0""",
    ),
    "marts_after_one_month": select(FACT, f"{FACT_SELECT} FROM fact"),
    "ranking_after_one_month": select(TOP, TOP_SELECT),
    "missing_cells": select(
        RAW,
        f"""{RAW_SELECT}, reader
            FROM raw CROSS JOIN (SELECT UNNEST(['text', 'archive']) AS reader)""",
    ),
    "lake_roundtrip": select(
        RAW, f"""{RAW_SELECT}, STRFTIME("DT_COMPTC", '%Y-%m') AS year_month FROM raw"""
    ),
    "lake_rewrite": select(
        RAW,
        """SELECT STRFTIME("DT_COMPTC", '%Y-%m') AS year_month, COUNT(*) AS rows_first,
           COUNT(*) AS rows_again FROM raw GROUP BY STRFTIME("DT_COMPTC", '%Y-%m')""",
    ),
    "missing_months": select(
        RAW,
        """SELECT STRFTIME(month, '%Y-%m') AS year_month
           FROM (SELECT UNNEST(GENERATE_SERIES(
                   CAST(DATE_TRUNC('month', MIN("DT_COMPTC")) AS TIMESTAMP),
                   CAST(DATE_TRUNC('month', MAX("DT_COMPTC")) AS TIMESTAMP),
                   INTERVAL 1 MONTH)) AS month FROM raw)
           WHERE STRFTIME(month, '%Y-%m') NOT IN
             (SELECT STRFTIME("DT_COMPTC", '%Y-%m') FROM raw WHERE "VL_QUOTA" = 0)""",
    ),
    "batch_statistics": select(
        RAW,
        """SELECT STRFTIME("DT_COMPTC", '%Y-%m') AS year_month, COUNT(*) AS "rows",
           COUNT(DISTINCT "CNPJ_FUNDO_CLASSE") AS classes
           FROM raw GROUP BY STRFTIME("DT_COMPTC", '%Y-%m')""",
    ),
    "count_distinct_ids": select(
        RAW,
        """SELECT COUNT(*) AS "rows", COUNT(DISTINCT "CNPJ_FUNDO_CLASSE") AS classes FROM raw""",
    ),
    "distinct_ids_of_spans": select(
        RAW,
        """SELECT STRFTIME(m - INTERVAL 2 MONTH, '%Y-%m') AS "first", STRFTIME(m, '%Y-%m') AS "last",
           COUNT(*) AS "rows", COUNT(DISTINCT "CNPJ_FUNDO_CLASSE") AS classes
           FROM (SELECT DISTINCT DATE_TRUNC('month', "DT_COMPTC") AS m FROM raw) AS months
           JOIN raw ON "DT_COMPTC" >= m - INTERVAL 2 MONTH AND "DT_COMPTC" < m + INTERVAL 1 MONTH
           GROUP BY m""",
    ),
    "published_inventory": select(TOP, inventory(["dimension", "fact", "top"])),
    "inventory_with_staging": select(TOP, inventory(["staged", "dimension", "fact", "top"])),
    "quality_summary": QUALITY_SUMMARY,
    "quality_while_writing": QUALITY_SUMMARY,
    "repeated_reports": select(
        STAGED,
        """SELECT class_id, as_of, COUNT(*) AS "rows" FROM staged GROUP BY class_id, as_of
           HAVING COUNT(*) > 1""",
    ),
    "orphan_facts": select(
        FACT,
        f"""{FACT_SELECT} FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dimension d
            WHERE d.class_key = f.class_key AND d.net_assets > 0)""",
    ),
    "ranked_without_fact": select(
        TOP,
        """SELECT COUNT(*) AS failures FROM top t WHERE NOT EXISTS (
           SELECT 1 FROM fact f WHERE f.class_id = t.class_id AND f.month = t.month)""",
    ),
    "most_ranked_in_a_month": select(
        TOP,
        """SELECT MAX(n) AS most_rows
           FROM (SELECT month, COUNT(*) AS n FROM top GROUP BY month)""",
    ),
    "negative_assets": select(STAGED, f"{STAGED_SELECT} FROM staged WHERE net_assets < -1000000"),
}
