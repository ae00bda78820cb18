import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.operators import quality as Q
from panelwatch.operators import spine as J
from panelwatch.plans import features as X
from panelwatch.sources import scores as K

D = datetime.date.fromisoformat


def market(spark, days, n=400, seed=0, keys=("k",)):
    """Prices on weekdays, macro daily (monthly cpi), geo on a spine of its own."""
    rng = np.random.default_rng(seed)
    prices, macro, geo = [], [], []
    for key in keys:
        walk = np.exp(rng.normal(0, 0.02, size=(n, 7)).cumsum(axis=0)) * 50
        for i, d in enumerate(days(n, "2009-01-01")):
            if d.weekday() < 5:
                row = [float(v) for v in walk[i]]
                row[0] = None if i % 11 == 0 else row[0]
                prices.append((key, d, *row))
            m = [float(v) for v in rng.normal(3, 1, size=6)]
            macro.append(
                (key, d, m[0], m[1] if i % 3 else None, m[2] if i % 2 else None, m[3], m[4] + 100 if d.day == 1 else None, m[5] * 20)
            )
            if i % 4 and i < n - 20:
                geo.append((key, d, *[float(v) for v in rng.normal(100, 20, size=2)], 7, False))
    q = ", ".join
    p = spark.createDataFrame(prices, f"series_key string, date date, {q(f'`{t}` double' for t in S.TICKERS)}")
    m = spark.createDataFrame(macro, f"series_key string, date date, {q(f'{c} double' for c in S.MACRO_SERIES)}")
    g = spark.createDataFrame(
        geo, "series_key string, date date, GPR_AI double, GPR_OIL double, gpr_days_stale int, gpr_is_stale boolean"
    )
    return p, m, g


def test_one_shuffle_build_equals_the_sets_one_by_one(spark, days):
    p, m, g = market(spark, days, keys=("k", "other"))
    fused = X.build_features(p, m, g, "2009-02-01")
    price = X.price_features(p, m)
    sets = [price, X.macro_features(m), X.geo_features(g, price)]
    apart = J.align(sets, S.FEATURES, "2009-02-01")
    cols = ["series_key", "date", *[F.round(f, 9).alias(f) for f in S.FEATURES]]
    assert fused.count() == apart.count() > 0
    assert fused.select(*cols).exceptAll(apart.select(*cols)).count() == 0
    for f in S.FEATURES:
        assert fused.filter(F.col(f).isNotNull()).count() > 0, f


def small(spark, prices, macro):
    p = spark.createDataFrame(
        [(r[0], D(r[1]), r[2], *[50.0] * 6) for r in prices],
        "series_key string, date date, " + ", ".join(f"`{t}` double" for t in S.TICKERS),
    )
    m = spark.createDataFrame(
        [("k", D(d), None, None, None, None, None, b) for d, b in macro],
        "series_key string, date date, " + ", ".join(f"{c} double" for c in S.MACRO_SERIES),
    )
    return p, m


def test_macro_value_on_a_date_without_prices_is_lost(spark):
    p, m = small(
        spark,
        [("k", "2010-01-01", None), ("k", "2010-01-04", None), ("k", "2010-01-05", None)],
        [("2010-01-01", 60.0), ("2010-01-03", 99.0), ("2010-01-05", 70.0)],
    )
    got = X.price_features(p, m).orderBy("date").select("brent_wti_spread").collect()
    assert [r[0] for r in got] == [10.0, 10.0, 20.0]


def test_non_positive_future_falls_back_to_macro(spark):
    p, m = small(
        spark,
        [("k", "2010-01-01", 55.0), ("k", "2010-01-04", -37.0), ("k", "2010-01-05", 0.0)],
        [("2010-01-01", 60.0), ("2010-01-04", -5.0), ("2010-01-05", 70.0)],
    )
    got = [r[0] for r in X.price_features(p, m).orderBy("date").select("brent_wti_spread").collect()]
    assert got[0] == 5.0 and got[1] == pytest.approx(1e-6 - 50) and got[2] == 20.0


@pytest.mark.parametrize("stale, weight", [(0, 1.0), (10, 0.95**10), (11, 0.95**11)])
def test_staleness_weight(spark, stale, weight):
    g = spark.createDataFrame(
        [("k", D("2010-01-01"), 150.0, 1.0, stale, stale > 10), ("k", D("2010-01-02"), 150.0, 1.0, stale, stale > 10)],
        "series_key string, date date, GPR_AI double, GPR_OIL double, gpr_days_stale int, gpr_is_stale boolean",
    )
    ovx = spark.createDataFrame([("k", D("2010-01-01"), 2.0)], "series_key string, date date, ovx_zscore double")
    got = [r[0] for r in X.geo_features(g, ovx).orderBy("date").select("geo_signal").collect()]
    assert got[0] == pytest.approx(weight * 150 + (1 - weight) * 100 + (1 - weight) * 2 * 30)
    assert got[1] is None  # no volatility z-score on that date, even at weight 1


def test_floor_comes_after_the_fill(panel):
    a = panel({"k": [7.0, None, None]}, start="2006-12-30").withColumnRenamed("x", "a")
    b = panel({"k": [1.0, 2.0, 3.0]}, start="2006-12-31").withColumnRenamed("x", "b")
    rows = J.align([a, b], ["a", "b"], "2007-01-01").orderBy("date").collect()
    assert [(str(r.date), r.a, r.b) for r in rows] == [("2007-01-01", 7.0, 2.0), ("2007-01-02", 7.0, 3.0)]


def test_existing_dates_are_never_overwritten(panel):
    old, new = panel({"k": [1.0, 2.0]}), panel({"k": [9.0, 9.0, 3.0]})
    assert sorted(r.x for r in J.append_new(old, new).collect()) == [1.0, 2.0, 3.0]
    assert J.new_keys(new, old).count() == 1


def test_sessions(spark, panel):
    cal = spark.createDataFrame([(D("2010-01-01"),), (D("2010-01-04"),)], "date date")
    assert J.is_session(cal, "2010-01-04") and not J.is_session(cal, "2010-01-03")
    assert J.previous_session(cal, "2010-01-04") == D("2010-01-01")
    assert J.previous_session(cal, "2010-01-01") is None
    df = panel({"k": range(6)})
    got = J.mark_sessions(df, cal).orderBy("date").collect()
    assert [r.is_session for r in got] == [True, False, False, True, False, False]


def test_score_date_fallback(panel):
    df = panel({"has": range(5), "later": range(5)}).filter("NOT (series_key = 'later' AND x = 2)")
    due = {r.series_key: str(r.date) for r in J.score_date(df, "2010-01-03").collect()}
    assert due == {"has": "2010-01-03", "later": "2010-01-05"}
    due = {r.series_key: str(r.date) for r in J.score_date(df, "2010-01-03", fallback="previous").collect()}
    assert due == {"has": "2010-01-03", "later": "2010-01-02"}
    with pytest.raises(ValueError):
        J.score_date(df, "2010-01-03", fallback="none")


def calendars_of(spark):
    sessions = [("x", "2010-01-01"), ("x", "2010-01-04"), ("x", "2010-01-04"), ("y", "2010-01-03"), (None, "2010-01-02"), ("x", None)]
    held = spark.createDataFrame([(c, d and D(d)) for c, d in sessions], "calendar string, date date")
    keys = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "empty"), ("d", None), (None, "x")], "series_key string, calendar string")
    return held, keys


def test_last_session_before_each_row_in_its_own_calendar(spark):
    held, _ = calendars_of(spark)
    rows = [("x", "2010-01-01"), ("x", "2010-01-04"), ("x", "2010-01-05"), ("x", None), ("y", "2010-01-05"), (None, "2010-01-09"), ("empty", "2010-01-09"), ("x", "2010-01-05")]
    df = spark.createDataFrame([(c, d and D(d), i) for i, (c, d) in enumerate(rows)], "calendar string, date date, __n int")
    got = J.session_before(df, held, ["calendar"])
    assert got.columns == ["calendar", "date", "__n", "previous_session"]
    assert [str(r.previous_session) for r in got.orderBy("__n").collect()] == [
        "None", "2010-01-01", "2010-01-04", "None", "2010-01-03", "2010-01-02", "None", "2010-01-04",
    ]
    assert {r.previous_session for r in J.session_before(df, held.limit(0), ["calendar"]).collect()} == {None}
    assert J.session_before(df.limit(0), held, ["calendar"]).isEmpty()
    one = J.session_before(df.filter("__n = 2"), held.filter("calendar = 'y'"))  # a single calendar
    assert [str(r.previous_session) for r in one.collect()] == ["2010-01-03"]


def test_each_key_is_due_by_its_own_calendar(spark, panel):
    held, keys = calendars_of(spark)
    state = J.session_state(held, "2010-01-04", keys)
    got = {r.series_key: (r.previous_session and str(r.previous_session), r.session_day) for r in state.collect()}
    assert got == {"a": ("2010-01-01", True), "b": ("2010-01-03", False), "c": (None, False), "d": ("2010-01-02", False), None: ("2010-01-01", True)}
    df = panel({k: range(6) for k in ("a", "b", "c", "unlisted")})
    due = {r.series_key: str(r.date) for r in K.rows_to_write(df, state, False).collect()}
    assert due == {"a": "2010-01-01", "b": "2010-01-03"}
    assert {(r.series_key, r["count"]) for r in K.rows_to_write(df, state, True).groupBy("series_key").count().collect()} == {("a", 1), ("b", 3)}
    twice = J.session_state(held, "2010-01-04", keys.unionByName(keys))
    assert twice.count() == keys.count()


def test_the_gate_knows_each_keys_calendar(spark, panel):
    held, keys = calendars_of(spark)
    df = panel({"a": [1.0], "b": [1.0], "c": [1.0]}, start="2009-12-01")
    state = J.session_state(held, "2010-01-04", keys)
    found = Q.findings(df, state, expected=["series_key", "date", "x"])
    assert [(r.series_key, r.check, r.message) for r in found.collect()] == [("a", "GAP", "GAP: last date is 2009-12-01, expected 2010-01-01")]
    assert {r.series_key: r.is_trading_day for r in Q.stamps(df, found, state).collect()} == {"a": True, "b": False, "c": False}
