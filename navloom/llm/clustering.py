"""Centroid clustering of whole-number vectors, with centroids filtered by n-simplex projection.

The distances of a vector to a few pivots are taken once. With the distances between the
pivots they give the vector a place in a space of as many dimensions as there are pivots, the
apex of a simplex over them: the base pivots lie in the first dimensions, the last
coordinate is the vector's height above them and not negative. The Euclidean distance of
two apexes is a lower bound of the distance of their vectors, and that of one apex to the
other's mirror image an upper bound. The apex coordinates are stored with the vectors. A round
gives the centroids their apexes, bounds all distances by short products, and compares whole
vectors, in whole numbers, only with centroids whose lower bound is within the least upper
bound. The margin for rounding of the bounds is far beyond their error, so they never leave
out a nearest centroid.

Each round is one pass over the stored vectors: tasks assign their vectors and send sums per
centroid, which Spark adds up; only these sums, a few numbers per centroid, come to the driver.

Vectors take part if they have exactly ``width`` components, none null or not finite, and the
whole number of each fits a long. Distances are exact; one that does not fit a long is null,
as are inertias that do not. Repeated rows take part each; of start vectors with equal hashes
that with the smaller components comes first. A row without id takes part, hashed as an
empty id. Fewer vectors than centroids give fewer centroids; empty tables give empty results.
Columns other than the two named ones are not carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import picked, stored

#: Pivots at most, chosen from a sample of so many vectors.
PIVOTS, SAMPLE = 16, 512
#: Bounds are widened by this part of the lengths, far above the rounding of a height, and by
#: that many times the rounding of the squares that other coordinates are solved from.
MARGIN, ROUNDING = 1e-6, 256 * np.finfo(float).eps
#: Pivots are added while rounding is not magnified more than so many times.
CONDITION = 1e5


def kept_vectors(
    table: DataFrame, width: int, scale: int, id_col: str, vector_col: str
) -> DataFrame:
    """``vec_id, v``: the whole components of the vectors that take part."""
    chosen = picked(table, vec_id=id_col, v=vector_col).where(F.size("v") == width)
    doubles = chosen.withColumn("v", F.transform("v", lambda x: x.cast("double") * F.lit(float(scale))))
    fits = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (x >= -(2.0**63)) & (x < 2.0**63))
    return doubles.where(fits).withColumn("v", F.transform("v", lambda x: F.floor(x)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` and ``b``, which may be a single row."""
    most = max((float(np.abs(x.astype(np.float64)).max()) for x in (a, b) if x.size), default=0.0)
    # Beyond this the squares of differences might not add up within a long.
    if 4 * most**2 * a.shape[-1] >= 2.0**62:
        a, b = a.astype(object), b.astype(object)
    else:
        a, b = a.astype(np.int64), b.astype(np.int64)
    return ((a - b) ** 2).sum(-1)


class Simplex:
    """A base of pivots, and the apexes of vectors above it."""

    def __init__(self, sample: np.ndarray, most: int = PIVOTS):
        """Takes pivots far from all before, as long as they add a dimension."""
        self.pivots = np.zeros((0, sample.shape[1]))
        self.base = np.zeros((0, 0))
        floats = sample.astype(np.float64)
        #: Length that bounds are widened by a part of.
        self.scale = 1.0 + (np.sqrt((floats**2).sum(1)).max() if len(floats) else 0.0)
        #: Norm of the inverse of the triangle that coordinates are solved with.
        self.inverse = 0.0
        nearest = np.full(len(floats), np.inf)
        while len(self.pivots) < most and len(floats):
            pick = int(np.argmax(nearest))
            apex = self.apexes(floats[pick : pick + 1])[0] if len(self.pivots) else np.zeros(0)
            grown = np.zeros((len(self.pivots) + 1, len(self.pivots)))
            grown[:-1, : self.base.shape[1]] = self.base
            grown[-1] = apex
            if len(apex):
                if apex[-1] <= self.scale / CONDITION:
                    break
                inverse = float(np.linalg.norm(np.linalg.inv(grown[1:]), 2))
                if inverse * self.scale > CONDITION:
                    break
                self.inverse = inverse
            self.base, self.pivots = grown, np.concatenate([self.pivots, floats[pick : pick + 1]])
            nearest = np.minimum(nearest, np.sqrt(((floats - floats[pick]) ** 2).sum(1)))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates of each vector, as many as there are pivots, the last not negative.

        Pivot ``i`` stands at ``base[i]``, with a positive coordinate ``i - 1`` and none after it.
        The difference of the squared distances to it and to the first pivot gives that coordinate.
        """
        vectors = vectors.astype(np.float64)
        far = np.stack([((vectors - p) ** 2).sum(1) for p in self.pivots], 1)
        n = len(self.pivots)
        found = np.zeros((len(vectors), n))
        for i in range(1, n):
            own = self.base[i, :i]
            inner = found[:, : i - 1] @ own[: i - 1]
            found[:, i - 1] = ((far[:, 0] - far[:, i] + own @ own) / 2 - inner) / own[i - 1]
        found[:, n - 1] = np.sqrt(np.maximum(0.0, far[:, 0] - (found[:, : n - 1] ** 2).sum(1)))
        return found

    def slack(self, lengths: np.ndarray) -> np.ndarray:
        """What bounds are widened by for vectors of these lengths."""
        far = self.scale + lengths
        return len(self.pivots) * (MARGIN * far + ROUNDING * far**2 * self.inverse)


def bounds(apexes: np.ndarray, others: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of all ``apexes`` to all ``others``."""
    flat = (apexes[:, None, :-1] - others[None, :, :-1]) ** 2
    flat = flat.sum(-1)
    low = np.sqrt(flat + (apexes[:, None, -1] - others[None, :, -1]) ** 2)
    high = np.sqrt(flat + (apexes[:, None, -1] + others[None, :, -1]) ** 2)
    return low - slack[:, None], high + slack[:, None]


def nearest(
    vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex
) -> tuple[np.ndarray, np.ndarray, int]:
    """Place and exact squared distance of the nearest centroid, the first of equals, and how
    many whole vectors were compared."""
    others = simplex.apexes(centroids)
    lengths = [np.sqrt((x.astype(np.float64) ** 2).sum(1)) for x in (vectors, centroids)]
    low, high = bounds(apexes, others, simplex.slack(lengths[0] + lengths[1].max()))
    open_ = low <= high.min(1)[:, None]
    best = np.full(len(vectors), -1)
    distance = np.zeros(len(vectors), np.int64)
    compared = 0
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_[:, number])
        compared += len(rows)
        found = squares(vectors[rows], centroid)
        if found.dtype != distance.dtype:
            found, distance = found.astype(object), distance.astype(object)
        closer = (best[rows] < 0) | (found < distance[rows])
        best[rows[closer]], distance[rows[closer]] = number, found[closer]
    return best, distance, compared


def _blocks(batches: Iterator[pa.RecordBatch], width: int, pivots: int):
    for batch in batches:
        for start in range(0, batch.num_rows, 8_192):
            part = batch.slice(start, 8_192)
            yield part, matrix(part.column("v"), width), matrix(part.column("apex"), pivots)


def _as_longs(values) -> pa.Array:
    return pa.array([v if v < 1 << 63 else None for v in map(int, values)], pa.int64())


def assigned(vectors: DataFrame, centroids: np.ndarray, simplex: Simplex, width: int) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    kind = dict(vectors.dtypes)["vec_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, whole, apexes in _blocks(batches, width, len(simplex.pivots)):
            best, distance, _ = nearest(whole, apexes, centroids, simplex)
            columns = [part.column("vec_id"), pa.array(best, pa.int32()), _as_longs(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(work, f"vec_id {kind}, cluster int, distance bigint")


def moved(vectors: DataFrame, centroids: np.ndarray, simplex: Simplex, width: int) -> np.ndarray:
    """The centroids of the next round: whole parts of the means of their vectors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), width), object)
        for _, whole, apexes in _blocks(batches, width, len(simplex.pivots)):
            best, _, _ = nearest(whole, apexes, centroids, simplex)
            # 8,192 halves of longs fit a long: sums of high and low bits are exact.
            high, low = whole >> 32, whole & 0xFFFFFFFF
            for number in np.unique(best).tolist():
                own = best == number
                counts[number] += own.sum()
                sums[number] += high[own].sum(0).astype(object) * (1 << 32) + low[own].sum(0).astype(object)
        rows = [(c, i, int(counts[c]), str(sums[c, i])) for c in range(len(centroids)) for i in range(width) if counts[c]]
        columns = list(zip(*rows)) or [()] * 4
        types = [pa.int32(), pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["c", "i", "n", "total"])

    parts = vectors.mapInArrow(work, "c int, i int, n bigint, total string")
    added = parts.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    after = centroids.copy()
    # A row per centroid and component: bounded by what was asked for.
    for row in added.collect():
        after[row.c, row.i] = int(row.total) // row.n
    return after


def clusters(
    table: DataFrame,
    k: int = 8,
    rounds: int = 10,
    seed: int = 3,
    width: int = 64,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every vector that takes part, and the final centroids.

    The first centroids are the ``k`` vectors of least sha256 of ``seed:vec_id``.
    """
    kept = kept_vectors(table, width, scale, id_col, vector_col)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    start = kept.orderBy(hashed, "v").limit(k).select("v").toArrow()
    sample = kept.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").toArrow()
    centroids = matrix(start.column("v").combine_chunks(), width)
    simplex = Simplex(matrix(sample.column("v").combine_chunks(), width))
    kind = dict(kept.dtypes)["vec_id"]
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apexes = simplex.apexes(matrix(batch.column("v"), width))
            ends = np.arange(len(apexes) + 1, dtype=np.int32) * len(simplex.pivots)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(apexes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], ["vec_id", "v", "apex"])

    vectors = kept.mapInArrow(work, f"vec_id {kind}, v array<bigint>, apex array<double>")
    vectors = stored(vectors, "apexes")
    for _ in range(rounds):
        after = moved(vectors, centroids, simplex, width)
        # Without a change no later round has one.
        if (after == centroids).all():
            break
        centroids = after
    return stored(assigned(vectors, centroids, simplex, width), "clusters"), centroids


def digest(centroid: np.ndarray) -> str:
    """sha256 of the components as decimal numbers."""
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` to the rows of :func:`clusters`."""
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    # A sum with a distance that does not fit does not either.
    total = F.when(F.count("*") == F.count("distance"), total)
    # One row per centroid: a bounded number.
    rows = found.groupBy("cluster").agg(total.alias("own")).collect()
    longs = lambda value: None if value is None or value >= 1 << 63 else int(value)
    inertia = longs(None if any(r.own is None for r in rows) else sum(int(r.own) for r in rows))
    known = [(r.cluster, longs(r.own), inertia, digest(centroids[r.cluster])) for r in rows]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    known = found.sparkSession.createDataFrame(known, schema)
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
