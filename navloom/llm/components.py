"""Connected components of an edge table, by stars, with a stored table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import join_hot, stored

#: Edges that a task of a round should write: few edges make few tasks, whatever the session
#: takes for shuffles.
EDGES = 500_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the least one around it."""
    back = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.select(F.inline(F.array(F.struct("a", "b"), back)))
    larger = F.count_if(F.col("b") > F.col("a")).alias("larger")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"), larger)
    moved = join_hot(both.where("b > a"), least, "a", "larger")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("smaller"))
    moved = join_hot(down, least, "a", "smaller").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def _gathered(edges: DataFrame, rows: int, purpose: str) -> DataFrame:
    """The different edges that join two vertices, stored in as many files as ``rows`` ask for."""
    laid = edges.where("a != b").repartition(rows // EDGES + 1, "a", "b")
    return stored(laid.distinct(), purpose)


def components(edges: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of ``edges (a, b)``; the root is the least vertex.

    Rounds of large and small stars go on until a round changes nothing; their number
    grows with the logarithm of the longest chain. The many edges of a hub stay where they
    are, see ``join_hot``. Vertices are not null; edges may repeat, lead to themselves, and
    be in either direction. Without edges there are no rows.
    """
    current = stored(edges.where("a != b").distinct(), "edges")
    rows, state = current.count(), None
    current = _gathered(current, rows, "edges")
    while True:
        large = _gathered(_large_star(current), rows, "stars")
        current = _gathered(_small_star(large), rows, "stars")
        now = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == state:
            break
        rows, state = now[0], now
    leaves = current.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    roots = current.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return leaves.unionByName(roots)
