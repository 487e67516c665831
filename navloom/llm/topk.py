"""Exact search for the highest inner products by a pivot-distance index.

With one more coordinate that lifts all vectors to the same length, the highest inner
product with a query is the least Euclidean distance to it. The index keys each vector by
its nearest pivot (its cell) and its distance to it, and cuts each cell into rings of that
distance. A query first meets one block of its own ring, which bounds the distance of its
k-th best. By the triangle inequality a vector within that bound lies, in every cell, in
the annulus from ``d - bound`` to ``d + bound``, where ``d`` is the query's distance to the
pivot. The query is sent only to rings that meet this annulus, and there reads sorted
vectors outwards from ``d`` until the bound, which falls on the way, ends the search.

A ring is spread over blocks of about ``BLOCK`` vectors, and the queries that reach it over
sets of about ``QUERIES``, so neither side is ever whole in a task. Only rings that a query
reaches are moved, once per set. What the driver holds are the pivots and one row per ring,
of which there are at most ``PIVOTS * RINGS``.

Scores are exact: products are taken in doubles, longs or integers of any size, whichever
holds ``width`` times the square of the largest component. Distances are floating and
compared with a margin for their error. Pivots are a bounded sample of the vectors; the
result does not depend on them.

Null vectors, and vectors holding null or non-finite components, take no part, nor do rows
without id, empty vectors, or vectors whose length differs from the most common one
(the greater of equals). A component whose whole number does not fit a long counts as not
finite. A score that does not fit a long is null, but ranked by its value. Rows that repeat
an id are rows of their own, in the order of the index; only the query's own row is left
out. Columns other than the two named ones are not carried along; tables without rows give
empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navloom.llm.common import picked, stored

PIVOTS = 32
#: Most rings of a cell.
RINGS = 64
#: Candidates of a block and queries of a set, on average.
BLOCK, QUERIES = 16_384, 2_048
#: Vectors read at first around a query's own distance; each further step reads twice as many.
NEAR = 256


def scaled(table: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``row, id, v``: whole components of the vectors that take part."""
    chosen = picked(table, id=id_col, v=vector_col).where("id is not null and size(v) > 0")
    doubles = chosen.withColumn("v", F.transform("v", lambda x: x.cast("double")))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float(2**63)))
    whole = doubles.where(sound).withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))
    rows = stored(whole.withColumn("row", F.monotonically_increasing_id()), "vectors")
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (usual[0] if usual else 0))


def _whole(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(-1, width)


def _lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    """One more coordinate, so that all squared lengths are ``most``."""
    vectors = vectors.astype(np.float64)
    rest = np.maximum(0.0, most - (vectors**2).sum(1))
    return np.concatenate([vectors, np.sqrt(rest)[:, None]], 1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(0.0, squares))


@dataclass(frozen=True)
class Space:
    """What all tasks know: pivots, the largest squared length, and how products are exact."""

    centres: np.ndarray
    width: int
    most: float
    kind: type

    @property
    def margin(self) -> float:
        """Beyond the error of a distance: the root of that of its square, a few times."""
        return 3 * float(np.sqrt(16 * (self.width + 4) * np.finfo(float).eps * max(1.0, self.most)))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        return _distances(_lifted(vectors, self.most), self.centres)

    def farthest(self, score) -> float:
        """The distance at which lifted vectors have that product, with the margin."""
        return float(np.sqrt(max(0.0, 2 * self.most - 2 * float(score)))) + self.margin


def exact_kind(width: int, largest: int) -> type:
    """The number type in which sums of ``width`` products are exact."""
    bound = width * largest * largest
    return np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object


class Block:
    """Vectors of one ring, sorted by their distance to the pivot."""

    def __init__(self, space: Space, rows, ids, vectors, own) -> None:
        order = np.argsort(own, kind="stable")
        self.space, self.rows, self.ids, self.own = space, rows[order], ids[order], own[order]
        self.vectors = vectors[order].astype(space.kind)

    def best(self, row: int, query: np.ndarray, d: float, bound: float, k: int):
        """Places and scores of the ``k`` best within ``bound``, ties to smaller ids."""
        middle = left = right = int(np.searchsorted(self.own, d))
        places, scores = np.zeros(0, np.int64), np.zeros(0, self.space.kind)
        step = NEAR
        while True:
            low = int(np.searchsorted(self.own, d - bound))
            high = int(np.searchsorted(self.own, d + bound, "right"))
            a, b = max(min(low, middle), left - step, 0), min(max(high, middle), right + step)
            a, b = max(a, low) if left > low else left, min(b, high) if right < high else right
            if a == left and b == right:
                return places, scores
            new = np.concatenate([np.arange(a, left), np.arange(right, b)])
            new = new[self.rows[new] != row]
            places = np.concatenate([places, new])
            scores = np.concatenate([scores, self.vectors[new] @ query])
            places, scores = self._top(places, scores, k)
            if len(scores) == k:
                bound = min(bound, self.space.farthest(scores[-1]))
            left, right, step = a, b, 2 * step

    def _top(self, places: np.ndarray, scores: np.ndarray, k: int):
        if self.space.kind is object:
            order = sorted(range(len(places)), key=lambda i: (-scores[i], self.ids[places[i]], self.rows[places[i]]))
            order = np.array(order[:k], np.int64)
            return places[order], scores[order]
        if len(scores) > 4 * k:
            kept = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            places, scores = places[kept], scores[kept]
        order = np.lexsort((self.rows[places], self.ids[places], -scores))[:k]
        return places[order], scores[order]


def _met(space: Space, k: int, out: Callable) -> Callable[[pa.Table], pa.Table]:
    """Searches the candidates of a group for each of its queries."""

    def search(group: pa.Table) -> pa.Table:
        vectors, mark = _whole(group.column("v"), space.width), group.column("asked").to_numpy()
        ids, rows, own = (group.column(c).to_numpy() for c in ("id", "row", "d"))
        block = Block(space, rows[~mark], ids[~mark], vectors[~mark], own[~mark])
        bounds, least = group.column("bound").to_numpy()[mark], group.column("least").to_numpy()[mark]
        asked = vectors[mark].astype(space.kind)
        found = []
        for row, query_id, query, d, bound, floor in zip(rows[mark], ids[mark], asked, own[mark], bounds, least):
            places, scores = block.best(row, query, d, bound, k)
            found.append((int(row), int(query_id), block, places, scores, floor))
        return out(found, group.schema.field("id").type)

    return search


def _first_bounds(space: Space, k: int):
    def out(found, _) -> pa.Table:
        kept = [(row, float(scores[-1])) for row, _, _, _, scores, _ in found if len(scores) == k]
        bounds = [space.farthest(score) for _, score in kept]
        # Rounded down, so that ties with it are kept.
        least = [score - abs(score) * 1e-9 - 1 for _, score in kept]
        columns = [pa.array([row for row, _ in kept], pa.int64()), pa.array(bounds, pa.float64()), pa.array(least, pa.float64())]
        return pa.table(columns, names=["query_row", "first_bound", "first_least"])

    return out


#: A score is ``high * 2^62 + low``: its order holds beyond longs.
_LOW = 62


def _results(found, id_type) -> pa.Table:
    out: list[list] = [[], [], [], [], [], [], []]
    for row, query_id, block, places, scores, least in found:
        for place, score in zip(places, scores):
            score = int(score)
            if score >= least:
                high = score >> _LOW
                whole = score if -(2**63) <= score < 2**63 else None
                values = query_id, row, int(block.ids[place]), int(block.rows[place]), whole, high, score - (high << _LOW)
                for column, value in zip(out, values):
                    column.append(value)
    types = [id_type, pa.int64(), id_type, pa.int64(), pa.int64(), pa.decimal128(38, 0), pa.int64()]
    names = ["query_id", "query_row", "vec_id", "vec_row", "score", "high", "low"]
    return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=names)


def _space(rows: DataFrame, pivots: int) -> tuple[Space, int]:
    doubles = F.transform("v", lambda x: x.cast("double"))
    squares = F.aggregate(doubles, F.lit(0.0), lambda s, x: s + x * x)
    most, low, high, n = rows.agg(
        F.coalesce(F.max(squares), F.lit(0.0)), F.min(F.array_min("v")), F.max(F.array_max("v")), F.count("*")
    ).first()
    chosen = rows.orderBy(F.xxhash64("id", "row"), "row").limit(pivots).select("v").toArrow()
    width = len(chosen.column("v")[0]) if n else 1
    vectors = _whole(chosen.column("v"), width) if n else np.zeros((1, width))
    kind = exact_kind(width, max(abs(low), abs(high))) if n else np.float64
    return Space(_lifted(vectors, most), width, most, kind), n


def _placed(rows: DataFrame, space: Space, n: int) -> tuple[DataFrame, list]:
    """The vectors with ``cell, own, ring, block``, and a row per ring."""

    def key(batches):
        for batch in batches:
            far = space.keys(_whole(batch.column("v"), space.width))
            cell = far.argmin(1)
            own = far[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(own)], [*batch.schema.names, "cell", "own"]
            )

    keyed = stored(rows.mapInArrow(key, f"{rows._jdf.schema().toDDL()}, cell int, own double"), "vector-keys")
    rings = min(RINGS, max(1, n // (len(space.centres) * BLOCK)))
    cuts = keyed.groupBy("cell").agg(
        F.percentile_approx("own", [(i + 1) / rings for i in range(rings)], 1_000).alias("cuts")
    )
    # A row per pivot.
    inside = F.least(F.size(F.filter("cuts", lambda c: c < F.col("own"))), F.lit(rings - 1))
    ringed = keyed.join(F.broadcast(cuts), "cell").withColumn("ring", F.col("cell") * rings + inside).drop("cuts")
    per_ring = ringed.groupBy("ring", "cell").agg(
        F.min("own").alias("low"), F.max("own").alias("high"), F.count("*").alias("rows"),
        F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"),
    ).orderBy("ring").collect()
    return ringed, per_ring


def top_k(
    table: DataFrame,
    every: int = 100,
    k: int = 10,
    scale: int = 1024,
    pivots: int = PIVOTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows for each query row.

    Queries are the rows whose id is divisible by ``every``; a vector is taken as the whole
    numbers ``floor(scale * x)``.
    """
    spark = table.sparkSession
    rows = scaled(table, scale, id_col, vector_col)
    id_kind = dict(rows.dtypes)["id"]
    space, n = _space(rows, pivots)
    ringed, per_ring = _placed(rows, space, n)
    ring_schema = "ring int, cell int, low double, high double, rows bigint, blocks int"
    # At most PIVOTS * RINGS rows.
    rings = F.broadcast(spark.createDataFrame(per_ring, ring_schema))
    block_of = lambda row: F.pmod(F.xxhash64(row), F.col("blocks")).cast("int")
    vectors = ringed.join(rings.select("ring", "blocks"), "ring").withColumn("block", block_of("row"))
    asked = rows.where(F.pmod("id", F.lit(every)) == 0)

    def meeting(queries: DataFrame) -> DataFrame:
        """Candidates and queries of the same ring, block and set."""
        # A row per ring.
        sets = F.broadcast(queries.groupBy("ring", "block").count().groupBy("ring").agg(
            F.ceil(F.max("count") / F.lit(QUERIES)).cast("int").alias("sets")
        ))
        every_set = F.explode(F.sequence(F.lit(0), F.col("sets") - 1)).alias("set")
        group = ["ring", "block"]
        many = vectors.join(sets, "ring").select(
            *group, every_set, "row", "id", "v", F.col("own").alias("d"),
            F.lit(0.0).alias("bound"), F.lit(0.0).alias("least"), F.lit(False).alias("asked"),
        )
        own_set = F.pmod(F.xxhash64("row", F.lit("set")), F.col("sets")).cast("int").alias("set")
        few = queries.join(sets, "ring").select(
            *group, own_set, "row", "id", "v", "d", "bound", "least", F.lit(True).alias("asked")
        )
        return many.unionByName(few).groupBy(*group, "set")

    no_bound = [F.lit(float("inf")).alias("bound"), F.lit(float("-inf")).alias("least")]
    at_home = vectors.where(F.pmod("id", F.lit(every)) == 0).withColumn("d", F.col("own")).select("*", *no_bound)
    first = meeting(at_home).applyInArrow(
        _met(space, k, _first_bounds(space, k)), "query_row bigint, first_bound double, first_least double"
    )
    first = stored(first, "vector-bounds")

    low, high = (np.array([r[c] for r in per_ring], float) for c in ("low", "high"))
    cells, numbers = (np.array([r[c] for r in per_ring], int) for c in ("cell", "ring"))

    def reach(batches):
        """Each query once per ring that its annulus meets, with its distance to the pivot."""
        for batch in batches:
            d = space.keys(_whole(batch.column("v"), space.width))[:, cells]
            bound = batch.column("bound").to_numpy()[:, None]
            at, ring = np.nonzero((d - bound <= high) & (d + bound >= low))
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(numbers[ring], pa.int32()), pa.array(d[at, ring])],
                [*batch.schema.names, "ring", "d"],
            )

    bounded = asked.join(first, asked["row"] == first["query_row"], "left").select(
        "row", "id", "v",
        F.coalesce("first_bound", F.lit(float("inf"))).alias("bound"),
        F.coalesce("first_least", F.lit(float("-inf"))).alias("least"),
    )
    schema = f"row bigint, id {id_kind}, v array<bigint>, bound double, least double, ring int, d double"
    reached = stored(bounded.mapInArrow(reach, schema), "vector-reach").join(rings.select("ring", "blocks"), "ring")
    sent = reached.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    result = (
        f"query_id {id_kind}, query_row bigint, vec_id {id_kind}, vec_row bigint, "
        "score bigint, high decimal(38,0), low bigint"
    )
    found = meeting(sent).applyInArrow(_met(space, k, _results), result)
    best = Window.partitionBy("query_row").orderBy(F.desc("high"), F.desc("low"), "vec_id", "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
