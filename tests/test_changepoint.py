import itertools

import numpy as np
import pytest

from panelwatch.operators.changepoint import changepoint_density, changepoints, kernel_width, pelt_rbf


def gram(x):
    d = (x[:, None] - x[None]) ** 2
    median = np.median(d[np.triu_indices(len(x), 1)])
    k = np.exp(-np.clip(d * (1 / median if median else 1.0), 1e-2, 1e2))
    np.fill_diagonal(k, 1.0)
    return k


def brute(x, penalty, step=5, least=2):
    """Cheapest of all segmentations with breaks on multiples of ``step``."""
    k, n = gram(x), len(x)
    best = (np.inf, [])
    places = range(step, n, step)
    for m in range(len(places) + 1):
        for cut in itertools.combinations(places, m):
            ends = [0, *cut, n]
            if any(b - a < least for a, b in zip(ends, ends[1:])):
                continue
            cost = sum((b - a) - k[a:b, a:b].sum() / (b - a) + penalty for a, b in zip(ends, ends[1:]))
            if cost < best[0] - 1e-9:
                best = (cost, list(cut))
    return best[1]


@pytest.mark.parametrize("n", [2, 3, 9, 50, 51])
def test_kernel_width_is_the_median_distance(n):
    x = np.round(np.random.default_rng(n).normal(size=n), 2)
    d = (x[:, None] - x[None]) ** 2
    assert kernel_width(x) == pytest.approx(1 / np.median(d[np.triu_indices(n, 1)]), rel=1e-9)
    assert kernel_width(np.ones(n)) == 1.0


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("penalty", [0.5, 2.0])
def test_equals_brute_force(seed, penalty):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(12, 55))
    x = rng.normal(size=n) + 4 * (np.arange(n) > n // 3) - 6 * (np.arange(n) > 2 * n // 3)
    assert pelt_rbf(x, penalty) == brute(x, penalty)


def test_step_is_found():
    x = np.r_[np.random.default_rng(0).normal(size=60), np.random.default_rng(1).normal(8, 1, size=40)]
    assert pelt_rbf(x) == [60]
    assert pelt_rbf(np.zeros(100)) == [] and pelt_rbf(np.array([1.0])) == []


def test_weekly_change_points_and_density(spark, panel):
    rng = np.random.default_rng(3)
    n = 700
    step = rng.normal(size=n) + 30 * (np.arange(n) >= 350)
    df = panel({"a": step, "b": rng.normal(size=n)}).withColumnRenamed("x", "f")
    df = df.selectExpr("*", "-f as g")
    points = changepoints(df, ["f", "g"])
    got = points.toPandas()
    assert set(got.series_key) == {"a"} and set(got.feature) == {"f", "g"}
    assert got.week_end.nunique() == 1 and got.week_end.iloc[0].weekday() == 6
    dense = changepoint_density(df, points, 2).filter("scores_cp > 0").collect()
    assert [(r.series_key, r.date, r.scores_cp) for r in dense] == [("a", got.week_end.iloc[0], 1.0)]
    # A week end that is not on the spine is dropped.
    missing = changepoint_density(df.filter(~df.date.isin([got.week_end.iloc[0]])), points, 2)
    assert missing.filter("scores_cp > 0").count() == 0
