"""Values that have to equal those of the published data and of existing results.

They are stated here once, as plain text; the rest of the package imports them.
"""

# Required columns of a monthly report file, with the name each
# gets after staging and its type there.
RAW_TO_STAGED = {
    "TP_FUNDO_CLASSE": ("class_type", "string"),
    "CNPJ_FUNDO_CLASSE": ("class_id", "string"),
    "ID_SUBCLASSE": ("subclass_id", "string"),
    "DT_COMPTC": ("as_of", "date"),
    "VL_TOTAL": ("total_value", "double"),
    "VL_QUOTA": ("unit_value", "double"),
    "VL_PATRIM_LIQ": ("net_assets", "double"),
    "CAPTC_DIA": ("inflow", "double"),
    "RESG_DIA": ("outflow", "double"),
    "NR_COTST": ("holders", "bigint"),
}
RAW_COLUMNS = list(RAW_TO_STAGED)

# Fixed value: subclass text of a class that reports without subclasses.
NO_SUBCLASS = "__sem_subclasse__"

# Labels of a series whose type or subclass is never given.
NO_TYPE_LABEL = "Classe de fundo"
NO_SUBCLASS_LABEL = "—"

# Format of a monthly report file.
REPORT_SEPARATOR = ";"
REPORT_CHARSET = "ISO-8859-1"

# Cells that a CSV reader takes as missing (the pandas defaults).
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Eligibility for the ranking, and its size.
MIN_DAYS = 15
MIN_NET_ASSETS = 1_000_000.0
MIN_HOLDERS = 5
TOP_N = 50

# Upper bounds (exclusive) of the size bands and the band names.
SIZE_BANDS = [
    (1e6, "< R$ 1M"),
    (1e7, "R$ 1M – 10M"),
    (1e8, "R$ 10M – 100M"),
    (1e9, "R$ 100M – 1B"),
    (None, "> R$ 1B"),
]

# Range (percentage points) and bins of the return histogram.
HISTOGRAM_LOW = -10.0
HISTOGRAM_HIGH = 10.0
HISTOGRAM_BINS = 60

# Monthly rate of the interbank benchmark in percent, by first day
# of the month, and the rate of every month that is not listed.
BENCHMARK_PCT = {
    "2024-12-01": 1.06,
    "2025-01-01": 1.01,
    "2025-02-01": 0.99,
    "2025-03-01": 1.04,
    "2025-04-01": 1.03,
    "2025-05-01": 1.13,
    "2025-06-01": 1.18,
    "2025-07-01": 1.18,
    "2025-08-01": 1.18,
    "2025-09-01": 1.13,
    "2025-10-01": 1.18,
    "2025-11-01": 1.13,
    "2025-12-01": 1.13,
    "2026-01-01": 1.13,
    "2026-02-01": 1.03,
    "2026-03-01": 1.13,
    "2026-04-01": 1.13,
}
BENCHMARK_DEFAULT_PCT = 1.10

# Limits of the data-quality rules.
MIN_STAGED_ROWS = 100_000
MIN_DIMENSION_ROWS = 1_000
FACT_PER_CLASS_RANGE = (0.5, 12.0)
MAX_NEGATIVE_ASSETS_RATIO = 0.001
LOWEST_NET_ASSETS = -1_000_000.0
MAX_DAYS_IN_MONTH = 25
OUTLIER_RETURN = 1.0
MAX_OUTLIER_RATIO = 0.01
