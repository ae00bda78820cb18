"""Centroid clusters against plain integers."""

import hashlib

import numpy as np
import pytest
from pyspark.errors import PySparkException

from panelwatch.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, vector string, stored string"


def plain(rows, clusters, rounds, dimensions):
    """Assignments by trying every centroid; (id, cluster, distance, centroid)."""
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    rank = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=rank)[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(own[k]) for x in zip(*own[k])] if k in own else c for k, c in enumerate(centroids)]
    return [(i, near(v)[1], near(v)[0], tuple(centroids[near(v)[1]])) for i, v in kept]


def key(r):
    return tuple((x is None, x) for x in r)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "own", "own", "own", "own") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("clusters", [1, 4, 16])
def test_clusters_equal_plain_integers(spark, clusters):
    rng = np.random.default_rng(clusters)
    rows = [(int(k), [float(x) for x in rng.normal(size=8) * (3 if k % 2 else 0.2) + (k % 5)]) for k in range(300)]
    rows += [(7, rows[0][1]), (7, rows[0][1]), (None, rows[3][1]), (None, [0.0] * 8), (400, [-2.5] * 8), (401, [1.0] * 8), (402, [1.0] * 8)]
    rows += [(500, None), (501, []), (502, [1.0] * 7), (503, [1.0] * 9), (504, [None] + [1.0] * 7), (505, [float("nan")] * 8), (506, [float("-inf")] + [1.0] * 7)]
    out = clustering.clustered(frame(spark, rows), clusters=clusters, dimensions=8).collect()
    want = plain(rows, clusters, clustering.ROUNDS, 8)
    assert sorted(((r.vec_id, r.cluster, r.distance, tuple(r.centroid)) for r in out), key=key) == sorted(want, key=key)
    per = {}
    for _, c, d, _ in want:
        per[c] = per.get(c, 0) + d
    assert all(r.cluster_inertia == per[r.cluster] and r.inertia == sum(per.values()) for r in out)


def test_bounds_spare_distances_and_keep_ties():
    rng = np.random.default_rng(3)
    centroids = rng.integers(-1000, 1000, (16, 12))
    x = np.concatenate([c + rng.integers(-9, 10, (60, 12)) for c in centroids] + [(centroids[:1] + centroids[1:2]) // 2, centroids])
    centroids[9] = centroids[4]  # equal centroids: the smaller number
    pivots = clustering.far_apart(x[:200], 6)
    who, d, spent = clustering.nearest(x, clustering.to_each(x, pivots), centroids, pivots)
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (who == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()
    assert spent < 0.3 * every.size


def test_few_empty_and_far_vectors(spark):
    assert clustering.clustered(frame(spark, []), dimensions=2).collect() == []
    assert clustering.clustered(frame(spark, [(1, None)]), dimensions=2).collect() == []
    two = clustering.clustered(frame(spark, [(1, [0.0, 1.0]), (2, [5.0, 1.0])]), dimensions=2).collect()
    assert sorted(r.cluster for r in two) == [0, 1] and {r.distance for r in two} == {0}
    edge = clustering.clustered(frame(spark, [(1, [2.0**21, -(2.0**21)]), (2, [-(2.0**21), 2.0**21])]), clusters=1, rounds=0, dimensions=2).collect()
    assert sorted(r.distance for r in edge) == [0, 2 * (2**28) ** 2]
    with pytest.raises(PySparkException, match="beyond"):
        clustering.clustered(frame(spark, [(1, [3e38, 1.0])]), dimensions=2).collect()
