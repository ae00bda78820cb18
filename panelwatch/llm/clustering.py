"""Centroid clustering on exact integers, with a table of distances to fixed pivots.

Vectors become integers.  Their distances to a few pivots are stored once; in each round the
difference of a vector's and a centroid's distance to a pivot is a lower bound of their
distance (triangle inequality), for all centroids.  Centroids come in the order of their
bounds and get an exact integer distance as long as the bound is not above the best so far.
A round sends one partial sum per task, cluster and component to the shuffle, and sums of
clusters x components to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.steps import settle

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
PIVOTS = 8
#: Vectors, by smallest hash, among which pivots far from each other are looked for; they bear on speed alone.
PIVOT_CANDIDATES = 256
#: Components are at most this before they are scaled, so that squared distances fit in 64 bits.
LARGEST = 1 << 21
SEED = "1"


def integers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component as a double; one beyond ``LARGEST`` is an error."""
    far = F.raise_error(F.lit(f"a vector component is beyond {LARGEST}")).cast("int")
    return F.transform(vector, lambda x: F.when(F.abs(x) <= LARGEST, F.floor(F.lit(float(scale)) * x.cast("double")).cast("int")).otherwise(far))


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """Exactly ``dimensions`` components, none null, NaN or infinite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x.astype(np.int64) - y
    return np.einsum("ij,ij->i", d, d)


def to_each(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of all rows to all points, as doubles."""
    return np.stack([np.sqrt(squared(x, p).astype(np.float64)) for p in points], axis=1)


def far_apart(candidates: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` rows, each the one farthest from those before it."""
    chosen = [0]
    least = squared(candidates, candidates[0])
    while len(chosen) < min(n, len(candidates)) and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, squared(candidates, candidates[chosen[-1]]))
    return candidates[chosen]


def nearest(x: np.ndarray, stored: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid (ties: smaller number), and how many exact distances it took.

    ``stored`` are the rows' distances to the pivots.
    """
    rows, far = np.arange(len(x)), to_each(centroids, pivots)
    low = np.abs(stored[:, None, :] - far[None, :, :]).max(axis=2)
    order = np.argsort(low, axis=1, kind="stable")
    best = np.full(len(x), np.iinfo(np.int64).max)
    who = np.full(len(x), len(centroids), np.int64)
    spent = 0
    for k in range(len(centroids)):
        c = order[:, k]
        # bounds are rounded doubles of at most 2**31: a little room keeps ties and near ties
        may = np.flatnonzero(low[rows, c] <= np.sqrt(best.astype(np.float64)) * (1 + 1e-9) + 1e-5)
        if not len(may):
            break
        c, spent = c[may], spent + len(may)
        d = squared(x[may], centroids[c])
        better = (d < best[may]) | ((d == best[may]) & (c < who[may]))
        best[may[better]], who[may[better]] = d[better], c[better]
    return who, best, spent


def pivot_distances(pivots: np.ndarray):
    """Arrow function: (id, vector) with the distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                far = to_each(_matrix(b.column(1)), pivots)
                lists = pa.ListArray.from_arrays(np.arange(0, far.size + 1, far.shape[1], dtype=np.int32), far.ravel())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["id", "vector", "stored"])

    return run


def cluster_sums(centroids: np.ndarray, pivots: np.ndarray):
    """Arrow function: one row per cluster and component of a task: sum and number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1)).astype(np.int64)
                who = nearest(x, _matrix(b.column(2)), centroids, pivots)[0]
                for c in np.unique(who):
                    own = who == c
                    sums[c] += x[own].sum(axis=0)
                    counts[c] += own.sum()
        some = np.flatnonzero(counts)
        k = centroids.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, k).astype(np.int32)), pa.array(np.tile(np.arange(k, dtype=np.int32), len(some))),
             pa.array(sums[some].ravel()), pa.array(np.repeat(counts[some], k))],
            names=["cluster", "at", "total", "n"],
        )

    return run


def assign(centroids: np.ndarray, pivots: np.ndarray):
    """Arrow function: (id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                who, d, _ = nearest(_matrix(b.column(1)).astype(np.int64), _matrix(b.column(2)), centroids, pivots)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(who.astype(np.int32)), pa.array(d)], names=["id", "cluster", "distance"])

    return run


def moved(centroids: np.ndarray, table: DataFrame, pivots: np.ndarray) -> np.ndarray:
    """Centroids after one round: floors of the means of their vectors, empty ones as they were."""
    parts = table.mapInArrow(cluster_sums(centroids, pivots), "cluster int, at int, total long, n long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    out = centroids.copy()
    for r in parts.groupBy("cluster", "at").agg(whole("total"), whole("n")).collect():  # clusters x components rows
        out[r["cluster"], r["at"]] = int(r["total"]) // int(r["n"])
    return out


def clustered(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
              dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every usable vector.

    Vectors that are null, have another number of components or one that is null or not
    finite are left out.  The first centroids are the vectors whose ``sha256`` of seed and id
    is smallest; a null id hashes as empty text, and rows of equal id come by components.
    With fewer vectors than ``clusters`` each vector starts a centroid.  Rows that repeat count
    each time.  A component beyond ``LARGEST`` ends the job with an error, as do sums that pass
    64 bits.  An empty table gives an empty table; other columns are not read.
    """
    spark = df.sparkSession
    vectors = df.filter(usable(F.col(vector_col), dimensions)).select(
        F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), scale).alias("vector")
    )
    rank = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(rank, "vector").limit(max(clusters, PIVOT_CANDIDATES)).collect()
    if not first:
        return spark.createDataFrame([], f"`{id_col}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<int>")
    first = np.array([r["vector"] for r in first], np.int64)
    centroids, pivots = first[:clusters], far_apart(first[:PIVOT_CANDIDATES], PIVOTS)
    table = settle(vectors.mapInArrow(pivot_distances(pivots), "id long, vector array<int>, stored array<double>"))
    for _ in range(rounds):
        centroids = moved(centroids, table, pivots)
    found = settle(table.mapInArrow(assign(centroids, pivots), "id long, cluster int, distance long"))
    per = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    names = [(c, per.get(c, 0), sum(per.values()), [int(v) for v in centroids[c]]) for c in range(len(centroids))]
    about = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid array<int>")
    out = found.withColumnRenamed("id", id_col).join(F.broadcast(about), "cluster")  # one row per cluster
    return out.select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid")
