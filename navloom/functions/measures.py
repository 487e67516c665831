"""Small Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from navloom.fixed_values import NO_SUBCLASS, SIZE_BANDS


def subclass_or_none(subclass: Column) -> Column:
    """Missing subclass as a fixed text, so that it joins and groups."""
    return F.coalesce(subclass, F.lit(NO_SUBCLASS))


def change_ratio(value: Column, previous: Column) -> Column:
    """``value / previous - 1``; null without a previous value or when it is 0."""
    return F.when(previous != 0, value / previous - 1)


def to_pct(ratio: Column) -> Column:
    return ratio * 100


def share_pct(condition: Column) -> Column:
    """Aggregate: percent of rows for which ``condition`` holds (null counts as no)."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))) * 100


def latest(value: Column, order: Column) -> Column:
    """Aggregate: the non-null value at the greatest ``order``."""
    return F.max_by(value, F.when(value.isNotNull(), order))


def latest_order(value: Column, order: Column) -> Column:
    """Aggregate: the ``order`` at which :func:`latest` found its value."""
    return F.max(F.when(value.isNotNull(), order))


def above_or_below(value: Column, reference: Column) -> Column:
    return F.when(value >= reference, "above").otherwise("below")


def size_band_no(amount: Column) -> Column:
    """Position 1..5 of the size band of ``amount``."""
    bounded = [(bound, n) for n, (bound, _) in enumerate(SIZE_BANDS, 1) if bound is not None]
    (bound, n), rest = bounded[0], bounded[1:]
    band = F.when(amount < bound, n)
    for bound, n in rest:
        band = band.when(amount < bound, n)
    return band.otherwise(len(SIZE_BANDS))


def size_band_name(band_no: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for _, name in SIZE_BANDS]), band_no)


def histogram_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin 1..``bins`` of a value within ``[low, high]``; the top edge is in the last bin."""
    return F.least(F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts joined by ``|``; null when a part is null."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit("|"), part.cast("string")]
    return F.md5(F.concat(*pieces))


def surrogate_key_null_safe(*parts: Column) -> Column:
    """md5 over the parts joined by ``-``, as the public dbt_utils macro makes it."""
    # Fixed value: text that stands for a missing part.
    missing = F.lit("_dbt_utils_surrogate_key_null_")
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), missing) for p in parts]))
