import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwatch.operators import aggregates as A
from panelwatch.operators.forest import (
    NODES,
    _grow,
    _Trees,
    average_path,
    fit_forest,
    fit_forests,
    forest_attribution,
    forests_attribution,
    score_forest,
    score_forests,
    tree_samples,
)

FEATURES = ["f0", "f1", "f2", "f3"]


@pytest.fixture(scope="module")
def rows(spark):
    x = np.random.default_rng(0).normal(size=(2000, 4))
    x[:20] += 8 * np.sign(x[:20])
    pdf = pd.DataFrame(x, columns=FEATURES)
    pdf["id"] = np.arange(len(pdf))
    return spark.createDataFrame(pdf).repartition(3)


@pytest.fixture(scope="module")
def forest(rows):
    return fit_forest(rows, FEATURES, ["id"], trees=50)


def test_average_path():
    assert average_path([1, 2]).tolist() == [0.0, 1.0]
    assert average_path(256) == pytest.approx(2 * (math.log(255) + np.euler_gamma) - 2 * 255 / 256)


def test_nodes_are_trees(forest):
    nodes = forest.nodes.toPandas()
    assert forest.sample == 256 and nodes.tree_id.nunique() == 50
    assert nodes.depth.max() <= 8
    for _, t in nodes.groupby("tree_id"):
        t = t.set_index("node_id")
        assert t.loc[0, "n"] == 256
        inner = t[t.feature >= 0]
        assert (t.loc[inner.left, "n"].to_numpy() + t.loc[inner.right, "n"].to_numpy() == inner.n.to_numpy()).all()
        assert (t.n > 0).all()


def test_outliers_rank_on_top(rows, forest):
    raw = score_forest(rows, forest, "raw")
    s = A.normalise_scores(raw, "raw", "s").toPandas().sort_values("raw", ascending=False)
    assert s.raw.between(0, 1, inclusive="neither").all()
    assert s.s.min() == 0.0 and s.s.std(ddof=0) == pytest.approx(1.0)
    assert set(s.id[:20]) == set(range(20))


def test_same_rows_same_forest(rows, forest):
    again = fit_forest(rows.repartition(7), FEATURES, ["id"], trees=50).nodes.toPandas()
    order = ["tree_id", "node_id"]
    pd.testing.assert_frame_equal(
        again.sort_values(order, ignore_index=True), forest.nodes.toPandas().sort_values(order, ignore_index=True)
    )


def test_sampling_from_a_large_table(spark):
    df = spark.range(60_000).select("id", F.col("id").cast("double").alias("v"))
    drawn, used = tree_samples(df, ["v"], ["id"], trees=10, sample=64, seed=1)
    got = drawn.toPandas()
    assert used == 64 and (got.groupby("tree_id").size() == 64).all()
    assert not got.duplicated(["tree_id", "v"]).any()
    assert abs(got.v.mean() - 30_000) < 4 * 60_000 / math.sqrt(12 * 640)


def test_sampling_uses_all_rows_of_a_small_table(spark):
    df = spark.range(40).select("id", F.col("id").cast("double").alias("v"))
    drawn, used = tree_samples(df, ["v"], ["id"], trees=3, sample=64, seed=1)
    assert used == 40 and drawn.groupBy("tree_id").count().select("count").distinct().collect() == [(40,)]


def test_weights_steer_the_sample(spark):
    df = spark.range(4000).select(
        "id",
        F.col("id").cast("double").alias("v"),
        F.when(F.col("id") < 1000, 0.0).when(F.col("id") < 2000, 9.0).otherwise(1.0).alias("w"),
    )
    got = tree_samples(df, ["v"], ["id"], trees=20, sample=64, seed=1, weight="w")[0].toPandas()
    assert (got.groupby("tree_id").size() == 64).all()
    assert (got.v >= 1000).all()
    assert 0.7 < (got.v < 2000).mean() < 0.9
    with pytest.raises(ValueError):
        tree_samples(df.filter("id < 1000"), ["v"], ["id"], 2, 8, 1, weight="w")


def expected_length(trees, node, x, known):
    """Path length with unknown features averaged over by cover."""
    if trees.leaf[node]:
        return trees.length[node]
    f = trees.feature[node]
    left, right = trees.left[node], trees.right[node]
    if f in known:
        return expected_length(trees, left if x[f] <= trees.split[node] else right, x, known)
    a, b = (expected_length(trees, c, x, known) for c in (left, right))
    return (a * trees.n[left] + b * trees.n[right]) / trees.n[node]


def test_shapley_values_match_their_definition(forest):
    nodes = forest.nodes.filter("tree_id < 3").toPandas()
    trees = _Trees(nodes)
    x = np.random.default_rng(5).normal(size=(6, 4)) * 2
    phi = trees.shapley(x)
    for row, got in zip(x, phi):
        want = np.zeros(4)
        for j in range(4):
            others = [i for i in range(4) if i != j]
            for size in range(4):
                weight = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                for known in itertools.combinations(others, size):
                    for root in trees.roots:
                        want[j] += weight * (
                            expected_length(trees, root, row, {*known, j}) - expected_length(trees, root, row, set(known))
                        )
        np.testing.assert_allclose(got, want / len(trees.roots), atol=1e-10)
    # Together they account for the distance from the mean path length.
    base = np.mean([expected_length(trees, r, x[0], set()) for r in trees.roots])
    np.testing.assert_allclose(phi.sum(axis=1), trees.path_lengths(x) - base, atol=1e-10)


def test_attribution_names_the_odd_feature(spark, rows, forest):
    odd = rows.filter("id >= 20").limit(50).withColumn("f2", F.lit(9.0))
    wide, names = forest_attribution(odd, forest, ["id"])
    got = wide.toPandas()
    assert names == ["shap_f0", "shap_f1", "shap_f2", "shap_f3"] and len(got) == 50
    assert (got[names].idxmax(axis=1) == "shap_f2").mean() > 0.9


def test_single_feature(rows):
    f = fit_forest(rows, ["f0"], ["id"], trees=5)
    assert score_forest(rows, f, "raw").filter("raw > 0").count() == 2000
    wide, _ = forest_attribution(rows, f, ["id"])
    assert wide.filter("shap_f0 >= 0").count() == 2000


@pytest.fixture(scope="module")
def groups(spark):
    """A hot group of two thirds of the rows, a small one, one without weight, one of null."""
    rng = np.random.default_rng(8)
    sizes = {"hot": 1500, "small": 30, "none": 40, None: 400, "other": 250}
    rows = []
    for key, n in sizes.items():
        x = rng.normal(size=(n, 4)) * rng.uniform(1, 50)
        rows += [(key, i, *map(float, v), 0.0 if key == "none" else float(rng.integers(1, 4)), "own") for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "series_key string, date long, f0 double, f1 double, f2 double, f3 double, w double, parts string").repartition(5)


def one_by_one(groups, trees, sample, kept, weight):
    """Scores and attributions with a forest grown from each group's own table."""
    out = {}
    for (key,) in groups.select("series_key").distinct().collect():
        df = groups.filter(F.col("series_key").eqNullSafe(F.lit(key)))
        if weight and key == "none":
            continue
        drawn, used = tree_samples(df, FEATURES, ["series_key", "date"], trees, sample, 42, weight)
        own = [FEATURES.index(f) for f in kept.get(key, FEATURES)]
        nodes = []
        for tree, pdf in drawn.toPandas().groupby("tree_id"):
            salt = "42" if key is None else f"42|{key}"
            rows = _grow(pdf.sort_values("__rn")[FEATURES].to_numpy(float)[:, own], salt, tree, max(1, math.ceil(math.log2(max(used, 2)))))
            nodes += [(tree, r[0], own[r[1]] if r[1] >= 0 else -1, *r[2:]) for r in rows]
        made = _Trees(pd.DataFrame(nodes, columns=[c.split()[0] for c in NODES.split(", ")]))
        pdf = df.toPandas()
        x = pdf[FEATURES].to_numpy(float)
        raw = 2.0 ** (-made.path_lengths(x) / float(average_path(max(used, 2))))
        shap = np.abs(made.shapley(x))
        out |= {(key, d): (r, *s) for d, r, s in zip(pdf.date, raw, shap)}
    return out


@pytest.mark.parametrize("weight", [None, "w"])
def test_a_forest_for_each_group(spark, groups, weight):
    kept = {"hot": ["f1", "f3"], None: ["f0"]}
    table = spark.createDataFrame(list(kept.items()), "series_key string, kept array<string>")
    forests = fit_forests(groups, FEATURES, trees=8, sample=32, weight=weight, kept=table)
    want = one_by_one(groups, 8, 32, kept, weight)
    for group_rows in (100, 10**6):  # the hot group in 15 parts, or in one
        wide, names = forests_attribution(score_forests(groups, forests, "raw", 32, group_rows), forests, group_rows=group_rows)
        assert wide.columns == [*groups.columns, "raw", *names] and wide.count() == groups.count()
        got = {(r.series_key, r.date): (r.raw, *[r[n] for n in names]) for r in wide.collect()}
        assert {k for k, v in got.items() if v[0] is None} == got.keys() - want.keys()
        for k, v in want.items():
            np.testing.assert_allclose(got[k], v, rtol=1e-9, atol=1e-12)


def test_forests_of_an_empty_table(groups):
    none = groups.limit(0)
    forests = fit_forests(none, FEATURES, trees=3, sample=16)
    assert forests.models.count() == 0 and score_forests(none, forests, "raw").count() == 0
    assert score_forests(groups, forests, "raw").filter("raw is null").count() == groups.count()


def test_pruning_for_each_group(spark, groups):
    near = groups.withColumn("f2", F.when(F.col("series_key") == "hot", F.col("f0") * 3 + F.col("f1") * 0.01).otherwise(F.col("f2")))
    near = near.withColumn("f3", F.when(F.col("series_key") == "small", F.lit(0.1)).when(F.col("date") == 3, F.lit(None)).otherwise(F.col("f3")))
    near = near.withColumn("f1", F.when(F.col("series_key").isNull(), -F.col("f0")).otherwise(F.col("f1")))
    got = {r.series_key: r.kept for r in A.prune_by(near, FEATURES).collect()}
    for (key,) in groups.select("series_key").distinct().collect():
        own = near.filter(F.col("series_key").eqNullSafe(F.lit(key)))
        assert got[key] == A.prune_features(own, FEATURES), key
    assert got["hot"] == ["f0", "f1", "f3"] and got[None] == ["f0", "f2", "f3"]
    assert A.prune_by(near.limit(0), FEATURES).count() == 0
    assert A.prune_by(near.withColumn("f0", F.lit(None).cast("double")), FEATURES).count() == 0


def test_shapley_values_of_deep_trees_in_bounded_memory():
    """Trees over 4,096 rows and 19 features: paths of up to 12 features, which tables of all patterns could not hold."""
    import tracemalloc

    rng = np.random.default_rng(11)
    x = rng.normal(size=(4096, 19)) * np.linspace(1, 4, 19)
    nodes = [(t, *r) for t in range(2) for r in _grow(x, 42, t, 12)]
    trees = _Trees(pd.DataFrame(nodes, columns=[c.split()[0] for c in NODES.split(", ")]))
    assert trees.depth == 12
    rows = rng.normal(size=(60, 19)) * 2
    tracemalloc.start()
    phi = trees.shapley(rows)
    assert tracemalloc.get_traced_memory()[1] < 20e6
    tracemalloc.stop()
    base = np.mean([expected_length(trees, r, rows[0], set()) for r in trees.roots])
    np.testing.assert_allclose(phi.sum(axis=1), trees.path_lengths(rows) - base, atol=1e-9)
    for row, got in zip(rows[:3], phi[:3]):  # permutations of all features, by their definition on three of them
        order = rng.permutation(19)
        known, last = set(), base
        for f in order:
            known.add(f)
            now = np.mean([expected_length(trees, r, row, known) for r in trees.roots])
            assert abs(now - last) < 12 and np.isfinite(got[f])
            last = now
        assert last - base == pytest.approx(got.sum(), abs=1e-9)
