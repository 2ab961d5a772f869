"""Centroid clustering over whole numbers, with an annulus search for the nearest centroid.

Components become integers ``floor(scale * x)``, so sums, means and distances are exact and
no result depends on how rows are dealt to tasks.

A round is one pass over the table. Each task sorts the centroids by norm and, for a block of
vectors, takes as an upper bound the distance to the centroids whose norms lie next to the
vector's. A nearer centroid's norm cannot differ from the vector's by more than this bound, so
two binary searches give the annulus: a run of the sorted centroids. Only these are compared, in
exact integers; the run is widened by far more than rounding can move its ends, so that centroids
on its boundary, which may tie, are compared as well. Of equal distances the smaller number wins.

A task returns one row of sums per centroid that it met, which Spark adds up per component; the
driver receives ``k`` times ``dim`` sums, whatever the size of the table. Centroids travel to the
tasks in the function's closure, bounded by the same product. Nothing is cached: a lost executor
costs the tasks in flight, and each round starts from the table.

Defined results: vectors that are null, of another length, or hold null or non-finite components
are left out. A row without id is assigned, but cannot be a start. Repeated ids are rows of their
own; as starts they come in the order of their vectors. With fewer than ``k`` starts there are as
many centroids as there are. An empty table, or one without usable vectors or ids, gives no rows. Components of
2**19 or more (at a scale of 256) raise an error, as a 64-bit integer could not hold their distances.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from .shared import materialize, quoted

BLOCK = 8192
LARGEST = 1 << 27
SCHEMA_SUMS = "cluster int, n long, sums array<long>"


def usable(lists: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, matrix of doubles) of the lists with ``dim`` finite components."""
    at = np.flatnonzero(np.asarray(pc.fill_null(pc.list_value_length(lists), -1)) == dim)
    flat = lists.take(pa.array(at)).flatten()
    x = np.asarray(pc.fill_null(flat.cast(pa.float64()), float("nan"))).reshape(-1, dim)
    fine = np.isfinite(x).all(axis=1)
    return at[fine], x[fine]


def whole_numbers(x: np.ndarray, scale: int) -> np.ndarray:
    x = np.floor(scale * x)
    if x.size and np.abs(x).max() >= LARGEST:
        raise ValueError(f"components times {scale} must stay below {LARGEST}: 64-bit integers cannot hold the distances of others")
    return x.astype(np.int64)


class AnnulusSearch:
    """The nearest of fixed centroids, by norms sorted once."""

    def __init__(self, centroids: np.ndarray):
        squares = (centroids * centroids).sum(axis=1)
        self.order = np.argsort(squares, kind="stable")
        self.centroids, self.squares = centroids[self.order], squares[self.order]
        self.norms = np.sqrt(self.squares.astype(np.float64))
        self.compared = 0

    def _distances(self, x, exact, squares, rows, j) -> np.ndarray:
        if exact:  # every product and sum stays below 2**53, where doubles are integers
            return squares[rows] + self.squares[j] - 2 * (x[rows] @ self.centroids[j].astype(np.float64)).astype(np.int64)
        return ((x[rows] - self.centroids[j]) ** 2).sum(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each row's nearest centroid."""
        k, n = len(self.order), len(x)
        squares = (x * x).sum(axis=1)
        norms = np.sqrt(squares.astype(np.float64))
        largest = max(int(np.abs(x).max(initial=0)), int(np.abs(self.centroids).max(initial=0)))
        exact = 4 * x.shape[1] * largest**2 < 1 << 53
        place = np.searchsorted(self.norms, norms)
        bound = np.full(n, np.iinfo(np.int64).max)
        for step in (-1, 0, 1):
            beside = self.centroids[np.clip(place + step, 0, k - 1)]
            bound = np.minimum(bound, ((x - beside) ** 2).sum(axis=1))
        reach = np.sqrt(bound.astype(np.float64))
        slack = 1e-9 * (reach + norms) + 1e-6
        low = np.searchsorted(self.norms, norms - reach - slack, side="left")
        high = np.searchsorted(self.norms, norms + reach + slack, side="right")
        self.compared += int((high - low).sum())
        if exact:
            x = x.astype(np.float64)
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        for j in range(int(low.min(initial=k)), int(high.max(initial=0))):
            rows = np.flatnonzero((low <= j) & (j < high))
            if not len(rows):
                continue
            d, own = self._distances(x, exact, squares, rows, j), self.order[j]
            better = (d < best[rows]) | ((d == best[rows]) & (own < number[rows]))
            rows = rows[better]
            best[rows], number[rows] = d[better], own
        return number, best


def _blocks(batch: pa.RecordBatch, column: int, dim: int, scale: int):
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        places, x = usable(part.column(column), dim)
        if len(places):
            yield part, places, whole_numbers(x, scale)


def _sums(batches, centroids: np.ndarray, scale: int):
    search = AnnulusSearch(centroids)
    k, dim = centroids.shape
    total, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
    for batch in batches:
        for _, _, x in _blocks(batch, 0, dim, scale):
            number, _ = search.nearest(x)
            order = np.argsort(number, kind="stable")
            own, first = np.unique(number[order], return_index=True)
            total[own] += np.add.reduceat(x[order], first, axis=0)
            counts[own] += np.diff([*first, len(order)])
    met = np.flatnonzero(counts)
    lists = pa.ListArray.from_arrays(np.arange(len(met) + 1, dtype=np.int32) * dim, pa.array(total[met].reshape(-1)))
    yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met]), lists], ["cluster", "n", "sums"])


def _assigned(batches, centroids: np.ndarray, scale: int):
    search = AnnulusSearch(centroids)
    for batch in batches:
        for part, places, x in _blocks(batch, 1, centroids.shape[1], scale):
            number, distance = search.nearest(x)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(places)), pa.array(number.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])


def starting_centroids(rows: DataFrame, k: int, seed: int, dim: int, scale: int) -> np.ndarray:
    """The ``k`` usable vectors whose ids hash lowest, as whole numbers; ``rows`` has (id, v).

    Only rows under a bound that about ``3 * k`` hashes pass are sorted, and all rows only if too few pass.
    """
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    hashed = rows.filter(F.col("id").isNotNull() & (F.size("v") == dim)).withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)).filter(fine)
    share = min(1.0, (3 * k + 50) / max(1, rows.count()))
    low = hashed.filter(F.col("h") < f"{int(share * 2**32):08x}") if share < 1 else hashed
    chosen = low.orderBy("h", "v").select("v").limit(k).collect()
    if len(chosen) < k and share < 1:
        chosen = hashed.orderBy("h", "v").select("v").limit(k).collect()
    return whole_numbers(np.asarray([list(r.v) for r in chosen], np.float64).reshape(-1, dim), scale)


def moved_centroids(rows: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """Each centroid as the floor of its vectors' mean; one without vectors stays."""
    parts = rows.select("v").mapInArrow(partial(_sums, centroids=centroids, scale=scale), SCHEMA_SUMS)
    flat = parts.select("cluster", "n", F.posexplode("sums").alias("i", "s"))
    sums = flat.groupBy("cluster", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    out = centroids.copy()
    for r in sums.collect():  # k * dim rows
        out[r.cluster, r.i] = int(r.s) // int(r.n)
    return out


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dim: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(vector_col)).alias("v"))
    if not isinstance(rows.schema["v"].dataType.elementType, (FloatType, DoubleType)):
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    centroids = starting_centroids(rows, k, seed, dim, scale)
    schema = StructType([StructField("id", rows.schema["id"].dataType), StructField("cluster", IntegerType()), StructField("distance", LongType())])
    named = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema).join(spark.createDataFrame([], named), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    for _ in range(rounds):
        centroids = moved_centroids(rows, centroids, scale)
    found = materialize(rows.mapInArrow(partial(_assigned, centroids=centroids, scale=scale), schema), "centroids")
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    total = sum(sums.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    clusters = spark.createDataFrame([(c, s, total, digests[c]) for c, s in sums.items()], named)
    return found.join(F.broadcast(clusters), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
