import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwatch.functions import rolling as R
from panelwatch.functions import scalar as C
from panelwatch.operators import series as X
from panelwatch.operators.series import Series


def column(df, name, key="a"):
    rows = df.filter(F.col("series_key") == key).orderBy("date").select(name).collect()
    return [r[0] for r in rows]


def close(got, want):
    got = np.array([np.nan if v is None else v for v in got], dtype=float)
    np.testing.assert_allclose(got, np.asarray(want, dtype=float), rtol=1e-9, atol=1e-9, equal_nan=True)


@pytest.mark.parametrize("rows", [59, 60, 61])
def test_z_needs_a_full_frame(panel, rows):
    x = np.random.default_rng(rows).normal(size=rows)
    s = Series.of(panel({"a": x}))
    got = column(s.with_columns(lambda w: {"z": R.rolling_z("x", 60, w)}).df, "z")
    r = pd.Series(x).rolling(60)
    close(got, (x - r.mean()) / r.std())
    assert sum(v is not None for v in got) == max(0, rows - 59)


def test_one_null_blanks_the_frames_that_hold_it(panel):
    x = list(np.random.default_rng(1).normal(size=150))
    x[70] = None
    got = column(Series.of(panel({"a": x})).with_columns(lambda w: {"z": R.rolling_z("x", 60, w)}).df, "z")
    assert [i for i, v in enumerate(got) if v is not None] == list(range(59, 70)) + list(range(130, 150))


@pytest.mark.parametrize("value", [5.0, 123456.7, 0.1])
def test_constant_series(panel, value):
    df = panel({"a": [value] * 80})
    s = Series.of(df)
    assert set(column(s.with_columns(lambda w: {"z": R.rolling_z("x", 60, w)}).df, "z")) == {None}
    narrow = column(X.rolling_zscores(s, ["x"], ["z"], floor=1e-6).df, "z")
    five = s._with(df.withColumns({f"x{i}": F.col("x") for i in range(5)}))
    wide = column(X.rolling_zscores(five, [f"x{i}" for i in range(5)], [f"z{i}" for i in range(5)], floor=1e-6).df, "z3")
    assert narrow == wide == [None] * 59 + [0.0] * 21


def test_wide_and_narrow_z_agree_after_an_outlier(panel):
    x = np.random.default_rng(2).normal(size=300)
    x[100] = 1e9
    df = panel({"a": x, "b": x[::-1]})
    names = [f"x{i}" for i in range(5)]
    s = Series.of(df.withColumns({n: F.col("x") for n in names}))
    wide = X.rolling_zscores(s, names, ["z" + n for n in names])
    both = wide.with_columns(lambda w: {"z": R.rolling_z("x", 60, w)}).df
    for key in "ab":
        close(column(both, "zx4", key), [np.nan if v is None else v for v in column(both, "z", key)])


def test_quantiles_need_half_the_window(panel):
    x = np.random.default_rng(3).normal(size=200)
    df = X.rolling_quantiles(Series.of(panel({"a": x})), "x", {"q": 63, "long": 252}).df
    got = column(df, "q")
    assert got[29] is None and got[30] is not None
    close(got, pd.Series(x).rolling(63, min_periods=31).quantile(0.95))
    close(column(df, "long"), pd.Series(x).rolling(252, min_periods=126).quantile(0.95))
    sql = Series.of(panel({"a": x})).with_columns(lambda w: {"q": R.rolling_quantile("x", 63, 0.95, w)}).df
    close(column(sql, "q"), got if None not in got else [np.nan if v is None else v for v in got])


def test_difference_counts_null_rows(panel):
    df = panel({"a": [1, None, 4, None, 9, 16]})
    s = Series.of(df).with_columns(lambda w: {"d": R.diff("x", 2, w)})
    assert column(s.df, "d") == [None, None, 3.0, None, 5.0, None]


def test_compact_change_then_fill(panel):
    monthly = [None] * 65
    for i in range(13):
        monthly[i * 5] = 100.0 + i
    df = panel({"a": monthly}).withColumn("c", R.pct_change("x", 12, X.non_null_window("x")))
    got = column(Series.of(df).with_columns(lambda w: {"c": R.ffill("c", w)}).df, "c")
    assert got[:60] == [None] * 60
    close(got[60:], [12.0] * 5)


def test_clipped_prices_give_huge_returns_not_nulls(panel):
    df = panel({"a": [20.0, -37.0, 0.0, 20.0]}).withColumn("p", C.clip_lower("x"))
    s = Series.of(df).with_columns(lambda w: {"r": R.log_return("p", 1, w)})
    close(column(s.df, "r"), [np.nan, np.log(1e-6 / 20), 0.0, np.log(20 / 1e-6)])


def events(spark, sizes, seed=0, burst=None):
    rng = np.random.default_rng(seed)
    rows, start = [], datetime.datetime(2024, 1, 1)
    for key, n in sizes.items():
        gaps = rng.integers(1, 10**9, size=n)
        if burst:
            gaps[n // 3 : n // 3 + burst] = 1  # microseconds apart
        at = np.cumsum(gaps)
        for i in range(n):
            v = float(rng.normal()) if rng.random() > 0.2 else None
            rows.append((key, start + datetime.timedelta(microseconds=int(at[i])), i, v))
    return spark.createDataFrame(rows, "series_key string, ts timestamp_ntz, id int, x double")


@pytest.mark.parametrize("rows_per_chunk", [130, 500, 10_000])
def test_split_gives_the_same_as_one_window_on_a_hot_key(spark, rows_per_chunk):
    df = events(spark, {"hot": 3000, "b": 700, "c": 40, "d": 1}, burst=900)
    build = lambda w: {
        "m": R.rolling_mean("x", 60, w, min_periods=5),
        "lagged": F.lag("x", 59).over(w),
    }
    whole = Series.of(df, order="ts").with_columns(build).body()
    s = Series.split(df, ["series_key"], "ts", 59, rows_per_chunk)
    cut = s.with_columns(build).body()
    assert cut.count() == df.count()
    a, b = (d.select("series_key", "id", F.round("m", 9).alias("m"), "lagged") for d in (whole, cut))
    assert a.exceptAll(b).count() == 0
    if s.is_split:
        biggest = s.df.groupBy(*s.part).count().agg(F.max("count")).first()[0]
        assert biggest <= 2 * max(rows_per_chunk, 118) + 59 + max(rows_per_chunk, 118)


@pytest.mark.parametrize("gap", [None, 5])
def test_split_fill_reaches_back_over_chunks(spark, gap):
    df = events(spark, {"hot": 2500, "b": 300})
    keep = F.col("id") % 700 == 3  # values far apart: most chunks hold none
    df = df.withColumn("x", F.when(keep, F.col("id").cast("double")))
    whole = X.forward_fill(Series.of(df, order="ts"), ["x"]).body()
    s = Series.split(df, ["series_key"], "ts", 20, 100)
    assert s.is_split
    cut = X.forward_fill(s, ["x"])
    assert whole.select("id", "series_key", "x").exceptAll(cut.body().select("id", "series_key", "x")).count() == 0
    # Halo rows are filled as well, so a window may follow.
    after = cut.with_columns(lambda w: {"m": R.rolling_mean("x", 10, w, min_periods=1)}).body()
    want = X.forward_fill(Series.of(df, order="ts"), ["x"]).with_columns(
        lambda w: {"m": R.rolling_mean("x", 10, w, min_periods=1)}
    ).body()
    cols = ["series_key", "id", F.round("m", 9).alias("m")]
    assert want.select(*cols).exceptAll(after.select(*cols)).count() == 0


def test_split_with_ties_keeps_rows_and_order(spark):
    ts = datetime.datetime(2024, 1, 1)
    rows = [("a", ts + datetime.timedelta(seconds=i // 50), i, float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "series_key string, ts timestamp_ntz, id int, x double")
    s = Series.split(df, ["series_key"], "ts", 9, 60, tie=["id"])
    assert s.is_split
    got = s.with_columns(lambda w: {"l": F.lag("x", 9).over(w)}).body().orderBy("id").collect()
    assert [r["l"] for r in got] == [None] * 9 + [float(i) for i in range(991)]


def test_split_of_nothing(spark):
    df = spark.createDataFrame([], "series_key string, ts timestamp_ntz, x double")
    assert Series.split(df, ["series_key"], "ts", 9).body().count() == 0


def test_last_and_latest_rows(panel):
    df = panel({"a": range(100), "b": range(5)})
    assert X.last_rows(df, 60).groupBy("series_key").count().orderBy("series_key").collect() == [("a", 60), ("b", 5)]
    assert {(r.series_key, r.x) for r in X.latest_row(df).collect()} == {("a", 99.0), ("b", 4.0)}


def test_ties_are_broken_by_the_given_columns(spark):
    df = spark.createDataFrame([("a", 1, i, float(i)) for i in range(50)], "series_key string, date int, id int, x double")
    assert sorted(r.id for r in X.last_rows(df, 3, tie=["id"]).collect()) == [47, 48, 49]
    assert X.latest_row(df, tie=["id"]).first().id == 49


def test_split_returns_rows_with_null_keys_and_null_order(spark):
    rows = [(None if i % 3 == 0 else "a", None if i % 5 == 0 else i // 4, i, float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "series_key string, date int, id int, x double")
    build = lambda w: {"l": F.lag("x", 7).over(w)}
    s = Series.split(df, ["series_key"], "date", 7, 20, tie=["id"])
    assert s.is_split
    cut = s.with_columns(build).body()
    whole = Series.of(df, tie=["id"]).with_columns(build).body()
    assert cut.count() == 400
    assert whole.select("id", "l").exceptAll(cut.select("id", "l")).count() == 0
    biggest = s.df.groupBy(*s.part).count().agg(F.max("count")).first()[0]
    assert biggest <= 20 + 7


def test_split_fill_with_null_keys(spark):
    rows = [(None, i, i, float(i) if i % 90 == 1 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "series_key string, date int, id int, x double")
    cut = X.forward_fill(Series.split(df, ["series_key"], "date", 5, 20), ["x"]).body()
    whole = X.forward_fill(Series.of(df), ["x"]).body()
    assert whole.select("id", "x").exceptAll(cut.select("id", "x")).count() == 0
