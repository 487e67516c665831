"""Mixing sources to target weights by entropy balancing.

Every source should give the mix a target number of words. Among all rates of documents
between zero and ``most`` that meet the targets, entropy balancing takes those closest to
one: the rate of a document is ``exp(multiplier * z)``, cut at ``most``, where ``z`` is its
size over the mean size of its source. The multiplier of a source maximises a concave dual,
whose gradient and curvature are sums over all its documents. Each Newton step is a Spark
aggregate of these sums over all sources at once; documents of equal source and size are
counted together before, and a step that leaves the bracket of the root halves it. Terms are
rounded to fixed fractions and summed as whole numbers, so that the order of rows and tasks
cannot change the multipliers.

Rates become whole copies by systematic rounding in order of size: a source's first ``i``
documents get the sum of their rates within one half, which keeps its words within one
half of its largest document.

Null and empty texts have size zero, rate one and are taken zero words. A null source is a
source of its own, last in order. Rows may repeat; each is rounded by its own place in the
order (size, id, source row). Columns other than the three named ones are not carried along.
A source without words has target and rates zero, and tables without rows give empty results.
Reruns over equal tables agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.llm.common import BLANK, picked, ranked, stored

#: Newton steps at most, and the error of a source's words, in parts of its target, that ends them.
STEPS, TOLERANCE = 60, 1e-7
#: Sizes of a source that a task of a step should hold.
SIZES = 500_000
#: Fractions of one that rates and sums are kept in.
UNIT = float(1 << 30)


def n_words(text: Column) -> Column:
    """Number of runs of characters other than space and tab to carriage return."""
    one_each = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(one_each, BLANK, "")).cast("long")


def _targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Adds ``target`` to ``source, source_size, weight``.

    Every source gets the same multiple of its weight, but at most ``most`` times its size;
    what is cut off goes to the others by weight, until none is above. The multiple is
    found from sums over the sources alone.
    """
    limit = F.col("source_size") * most
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    multiple = 0.0
    while True:
        above = F.col("weight") * multiple >= limit
        taken, weights = sources.agg(
            F.coalesce(F.sum(F.when(above & (F.lit(multiple) > 0), limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above | (F.lit(multiple) <= 0), F.col("weight"))), F.lit(0.0)),
        ).first()
        if not weights or (total - taken) / weights <= multiple * (1 + 1e-12):
            break
        multiple = (total - taken) / weights
    return sources.withColumn("target", F.least(limit, F.col("weight") * multiple).cast("double"))


def _whole(value: Column) -> Column:
    """Non-negative doubles as whole numbers of units, whose sums are exact."""
    return F.floor(value * UNIT + 0.5).cast("decimal(38,0)")


def _rate(most: float) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.col("multiplier") * F.col("size") / F.col("mean")))


def balanced(sizes: DataFrame, targets: DataFrame, most: float, steps: int = STEPS) -> DataFrame:
    """``source, multiplier, mean``: solutions of the dual, for sources with a target above zero.

    ``sizes`` has ``source, size, n``, one row per source and size, and ``targets`` has
    ``source, source_size, target``; both should be stored tables.
    """
    worded = sizes.where("size > 0")
    ends = worded.groupBy("source").agg(F.sum("n").alias("n"), F.min("size").alias("least"))
    ends = ends.withColumnRenamed("source", "of_source")
    same = F.col("source").eqNullSafe(F.col("of_source"))
    wanted = targets.where("target > 0").join(ends, same).withColumn("mean", F.col("source_size") / F.col("n"))
    # At these ends even the least document is cut at ``most``, or has the rate of all.
    unit = F.col("mean") / F.col("least")
    full = F.col("target") >= F.col("source_size") * F.lit(float(most))
    top = F.log(F.lit(float(most))) * unit * 1.0001
    low = F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) * unit)
    state = wanted.select(
        "source", "target", "mean", low.alias("low"), top.alias("high"),
        F.when(full, top).otherwise(0.0).alias("multiplier"),
    )
    state = stored(state, "mix-multipliers")
    for _ in range(steps):
        of = state.withColumnRenamed("source", "of_source")
        rate = _rate(most)
        words = F.col("n") * F.col("size") / F.col("target") * rate
        bend = F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            worded.join(of, same)
            .groupBy("of_source", "target", "mean", "low", "high", "multiplier")
            .agg((F.sum(_whole(words)) / UNIT).alias("words"), (F.sum(_whole(bend)) / UNIT).alias("bend"))
        )
        over, now = F.col("words").cast("double") - 1, F.col("multiplier")
        step = now - over / F.nullif(F.col("bend").cast("double"), F.lit(0.0))
        low = F.when(over < 0, now).otherwise(F.col("low"))
        high = F.when(over > 0, now).otherwise(F.col("high"))
        inside = (step > low) & (step < high)
        done = F.abs(over) <= TOLERANCE
        moved = F.when(done, now).when(inside, step).otherwise((low + high) / 2)
        sums = sums.select(
            F.col("of_source").alias("source"), "target", "mean",
            low.alias("low"), high.alias("high"), moved.alias("multiplier"), done.alias("done"),
        )
        state = stored(sums, "mix-multipliers")
        if not state.where("not done").limit(1).count():
            break
        state = state.drop("done")
    return state.select("source", "multiplier", "mean")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row: ``doc_id, source, size, source_size, target, rate, copies, taken``.

    Sources in code point order take ``weights`` in turn; the mix has ``share`` times the
    words of all documents, a source and a document at most ``most`` times its own. Where
    ``most`` (1 at least) is no whole number, single documents may be rounded up to the next.
    """
    chosen = picked(docs, doc_id=id_col, text=text_col, source=source_col)
    sized = chosen.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    # The last keys make the order of repeated rows plain; equal rows may change places.
    order = [F.desc("size"), F.asc_nulls_last("doc_id")]
    rows = stored(ranked(sized, "source", order, "mix-order"), "mix-ranks")
    sources = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    by_name = sources.withColumn("all", F.lit(1))
    by_name = ranked(by_name, "all", [F.asc_nulls_last("source")], "mix-sources").drop("all")
    turns = F.array(*[F.lit(float(w)) for w in weights])
    weighted = by_name.withColumn(
        "weight", F.element_at(turns, (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int"))
    ).drop("position")
    targets = stored(_targets(stored(weighted, "mix-weights"), share, most), "mix-targets")
    counted = rows.groupBy("source", "size").agg(F.count("*").alias("n"), F.min("position").alias("first"))
    n_sizes = stored(counted, "mix-sizes")
    sizes = stored(n_sizes.repartition(n_sizes.count() // SIZES + 1, "source", "size"), "mix-sizes")
    solved = balanced(sizes, targets, most).withColumnRenamed("source", "of_source")
    # Rates in whole units: rows of equal size share one, and sums over sizes are exact.
    rated = sizes.join(solved, F.col("source").eqNullSafe(F.col("of_source")), "left")
    units = rated.select("source", "size", "n", "first", F.coalesce(_whole(_rate(most)), F.lit(0)).alias("units"))
    earlier = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("units") * F.col("n")).over(earlier), F.lit(0)).cast("decimal(38,0)")
    units = stored(units.withColumn("before", before).drop("n"), "mix-rates").select(
        F.col("source").alias("of_source"), F.col("size").alias("of_size"), "first", "units", "before"
    )
    of_sources = targets.select(F.col("source").alias("of"), "source_size", "target")
    joined = rows.join(
        units, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size"))
    ).join(of_sources, F.col("source").eqNullSafe(F.col("of")))
    # Units of the rows up to the one at a place, as whole numbers.
    inside = lambda place: F.col("before") + F.col("units") * (place - F.col("first")).cast("decimal(18,0)")
    upto = lambda place: F.floor((inside(place) / int(UNIT) + 0.5).cast("decimal(38,10)"))
    copies = (upto(F.col("position") + 1) - upto(F.col("position"))).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("units") / UNIT).cast("double").alias("rate"),
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )
