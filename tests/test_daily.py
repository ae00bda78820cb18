"""The daily job end to end on a synthetic single series."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.operators import quality as Q
from panelwatch.plans import daily, lookback
from panelwatch.plans import reports as R
from panelwatch.session import scratch_path, settle
from panelwatch.sources import landing as L
from panelwatch.sources import scores as K

N = 700
START = datetime.date(2015, 1, 1)
SMALL = {"trees": 20, "sample": 64}


def day(i):
    return START + datetime.timedelta(days=i)


def land(spark, t, upto, run):
    """Land everything known on day ``upto``."""
    rng = np.random.default_rng(0)
    walk = np.exp(rng.normal(0, 0.02, size=(N, len(S.TICKERS))).cumsum(axis=0)) * 50
    walk[600:605] *= 1.6
    macro = rng.normal(3, 1, size=(N, len(S.MACRO_SERIES)))
    geo = rng.normal(100, 20, size=(N, 2))
    bars = [("k", day(i), n, float(walk[i, j])) for i in range(upto) for j, n in enumerate(S.TICKERS)]
    series = [
        ("k", day(i), n, float(macro[i, j] + (100 if n == "cpi" else 0)))
        for i in range(upto)
        for j, n in enumerate(S.MACRO_SERIES)
        if n != "cpi" or day(i).day == 1
    ]
    index = [("k", day(i), float(geo[i, 0]), float(geo[i, 1])) for i in range(upto)]
    L.write_snapshot(spark.createDataFrame(bars, S.PRICES_RAW), t.landed, "prices", run)
    L.write_snapshot(spark.createDataFrame(series, S.MACRO_RAW), t.landed, "macro", run)
    L.write_snapshot(spark.createDataFrame(index, S.T.StructType(S.GEO_RAW.fields[:4])), t.landed, "geo", run)


@pytest.fixture(scope="module")
def sessions(spark):
    return spark.createDataFrame([(day(i),) for i in range(N + 10)], "date date")


@pytest.fixture(scope="module")
def full(spark, sessions):
    t = daily.Tables(scratch_path(spark, "job"))
    as_of = str(day(N))
    land(spark, t, N, as_of)
    daily.update_features(spark, t, as_of)
    found = daily.gate_features(spark, t, sessions, as_of)
    assert found.filter("severity = 'CRITICAL'").isEmpty()
    daily.train_and_score(spark, t, sessions, as_of, backfill=True, run_id="r1", **SMALL)
    return t


def test_score_table(spark, full):
    scores = K.read_scores(spark, full.scores)
    rows = scores.orderBy("date").collect()
    complete = daily.training_rows(L.read_features(spark, full.features)).count()
    assert len(rows) == complete == len({r.date for r in rows})
    assert all(len(r.top_drivers) == 5 and r.model_version == "r1" for r in rows)
    assert min(r.scores_if for r in rows) == 0.0
    # The jump stands out.
    top = sorted(rows, key=lambda r: -r.risk_score)[:10]
    assert {r.date for r in top} & {day(i) for i in range(600, 611)}
    for r in rows:
        want = 0.4 * r.scores_if + 0.35 * (r.scores_z or 0) + 0.25 * r.scores_cp
        assert r.risk_score == pytest.approx(want, abs=1e-5)


def test_run_log_and_reports(spark, full):
    run = L.read_parquet(spark, full.runs, K.RUN_LOG).collect()
    assert len(run) == 1 and run[0].run_id == "r1" and 0 <= run[0].anomaly_rate_1y <= 1
    scores = K.read_scores(spark, full.scores)
    assert R.severities(scores).count() == 4
    shares = R.driver_shares(scores).collect()
    assert len(shares) == 5 and sum(r.importance for r in shares) == pytest.approx(100)
    assert R.anomaly_log(scores).count() == scores.filter("anomaly_static").count()


@pytest.mark.parametrize("since", [None, str(day(N - 5))])
def test_incremental_equals_full(spark, sessions, full, since):
    t = daily.Tables(scratch_path(spark, "job"))
    land(spark, t, N - 5, str(day(N - 5)))
    daily.update_features(spark, t, str(day(N - 5)))
    land(spark, t, N, str(day(N)))
    daily.update_features(spark, t, str(day(N)), since=since, halo_days=450)
    # Old days keep the weight of the run that stored them.
    signal = F.when(F.col("date") >= str(day(N - 5)), F.round("geo_signal", 9)).alias("geo_signal")
    cols = ["date", signal, *[F.round(c, 9).alias(c) for c in S.FEATURES if c != "geo_signal"]]
    a, b = (L.read_features(spark, x.features).select(*cols) for x in (full, t))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_incremental_equals_full_with_a_sparse_source(spark, tmp_path):
    """An index with a value every 30 days: 60 of its rows lie far beyond the first guess of the halo."""
    rng = np.random.default_rng(1)
    n, cut = 2600, 2530
    walk = np.exp(rng.normal(0, 0.02, size=(n, len(S.TICKERS))).cumsum(axis=0)) * 50
    bars = [("k", day(i), c, float(walk[i, j])) for i in range(n) for j, c in enumerate(S.TICKERS)]
    macro = [("k", day(i), c, float(rng.normal(100, 1))) for i in range(0, n, 7) for c in S.MACRO_SERIES]
    index = [("k", day(i), float(rng.normal(100, 20)), float(rng.normal(100, 20))) for i in range(0, n, 30)]
    sources = {
        "prices": spark.createDataFrame(bars, S.PRICES_RAW),
        "macro": spark.createDataFrame(macro, S.MACRO_RAW),
        "geo": spark.createDataFrame(index, S.T.StructType(S.GEO_RAW.fields[:4])),
    }
    built = {}
    for name, runs in {"full": [(n, None)], "steps": [(cut, None), (n, str(day(cut)))]}.items():
        t = daily.Tables(str(tmp_path / name))
        for upto, since in runs:
            for source, rows in sources.items():
                L.write_snapshot(rows.filter(F.col("date") < str(day(upto))), t.landed, source, str(day(upto)))
            daily.update_features(spark, t, str(day(upto)), since=since, halo_days=200)
        new = L.read_features(spark, t.features).filter(F.col("date") >= str(day(cut)))
        built[name] = new.select("date", *[F.round(c, 9).alias(c) for c in S.FEATURES])
    assert built["full"].count() == n - cut
    assert built["full"].exceptAll(built["steps"]).count() == 0


def _silent_and_null(cut, n):
    """Daily sources; OVX and XLE are silent long before ``cut``, GPR_OIL is null in a row 30 days before it."""
    rng = np.random.default_rng(2)
    walk = np.exp(rng.normal(0, 0.02, size=(n, len(S.TICKERS))).cumsum(axis=0)) * 50
    silent = {"^OVX": 300, "XLE": 330}
    bars = [("k", day(i), c, float(walk[i, j])) for i in range(n) for j, c in enumerate(S.TICKERS) if i < silent.get(c, n)]
    macro = [("k", day(i), c, float(rng.normal(100, 1))) for i in range(n) for c in S.MACRO_SERIES]
    oil = [None if cut - 90 <= i < cut - 62 or i == cut - 30 else float(rng.normal(100, 20)) for i in range(n)]
    index = [("k", day(i), float(rng.normal(100, 20)), oil[i]) for i in range(n)]
    return bars, macro, index


@pytest.mark.parametrize("null_closes", [False, True])
def test_incremental_equals_full_with_a_silent_ticker_and_null_rows(spark, tmp_path, null_closes):
    n, cut = 760, 752
    bars, macro, index = _silent_and_null(cut, n)
    if null_closes:  # days on which no ticker has a price
        bars = [(k, d, c, None if d in (day(cut - 10), day(cut - 20)) else v) for k, d, c, v in bars]
    geo = S.T.StructType(S.GEO_RAW.fields[:4])
    sources = {"prices": (bars, S.PRICES_RAW), "macro": (macro, S.MACRO_RAW), "geo": (index, geo)}
    built = {}
    for name, runs in {"full": [(n, None)], "steps": [(cut, None), (n, str(day(cut)))]}.items():
        t = daily.Tables(str(tmp_path / name))
        for upto, since in runs:
            for source, (rows, schema) in sources.items():
                L.write_snapshot(spark.createDataFrame([r for r in rows if r[1] < day(upto)], schema), t.landed, source, str(day(upto)))
            daily.update_features(spark, t, str(day(upto)), since=since, halo_days=200)
        new = L.read_features(spark, t.features).filter(F.col("date") >= str(day(cut)))
        built[name] = {r.date: r for r in new.select("date", *[F.round(c, 9).alias(c) for c in S.FEATURES]).collect()}
    assert len(built["full"]) == n - cut
    assert built["full"] == built["steps"]
    assert all(r.ovx_zscore is not None and r.xle_brent_ratio is not None for r in built["full"].values())


def _spoil(spark, t, run):
    """Make the snapshots of a run unreadable."""
    import pathlib

    for f in pathlib.Path(t.landed).glob(f"*/ingest_date={run}/*"):
        f.write_bytes(b"not parquet") if f.suffix == ".parquet" else f.unlink()


def _market(n, seed=4):
    """Two keys: daily prices, one ticker silent from day 300 on, a monthly cpi, an index with gaps."""
    rng = np.random.default_rng(seed)
    bars, macro, index = [], [], []
    for key in ("k", "other"):
        walk = np.exp(rng.normal(0, 0.02, size=(n, len(S.TICKERS))).cumsum(axis=0)) * 50
        bars += [(key, day(i), c, float(walk[i, j])) for i in range(n) for j, c in enumerate(S.TICKERS) if c != "^OVX" or i < 300]
        macro += [(key, day(i), c, float(rng.normal(100, 1))) for i in range(n) for c in S.MACRO_SERIES if c != "cpi" or day(i).day == 1]
        index += [(key, day(i), float(rng.normal(100, 20)), None if i % 9 == 0 else float(rng.normal(100, 20))) for i in range(n) if i % 5 < 3]
    return {"prices": (bars, S.PRICES_RAW), "macro": (macro, S.MACRO_RAW), "geo": (index, S.T.StructType(S.GEO_RAW.fields[:4]))}


def _build(spark, root, market, runs, spoil=False, revised=None):
    """Features of all days, ``runs`` being (days known, days before that are landed again or None, since)."""
    t = daily.Tables(str(root))
    done = []
    for upto, again, since in runs:
        for source, (rows, schema) in market.items():
            rows = [r for r in rows if r[1] < day(upto) and (again is None or r[1] >= day(again))]
            if revised and upto == revised[0]:
                rows = [(*r[:3], r[3] * 1.01) if source == "prices" and r[1] == day(revised[1]) and r[2] == "CL=F" else r for r in rows]
                if source == "prices" and again > revised[1]:
                    old = [r for r in market[source][0] if r[1] == day(revised[1]) and r[2] == "CL=F"]
                    rows += [(*r[:3], r[3] * 1.01) for r in old]
            L.write_snapshot(spark.createDataFrame(rows, schema), t.landed, source, str(day(upto)))
        if spoil:
            for run in done:
                _spoil(spark, t, str(day(run)))
        daily.update_features(spark, t, str(day(upto)), since=since and str(day(since)))
        done.append(upto)
    rows = L.read_features(spark, t.features).select("series_key", "date", *[F.round(c, 9).alias(c) for c in S.FEATURES]).collect()
    return {(r.series_key, r.date): r for r in rows}


def test_daily_runs_open_only_the_state_and_new_snapshots(spark, tmp_path):
    """Three daily runs, all snapshots of earlier runs unreadable: the days equal those of a backfill."""
    n, market = 700, _market(700)
    steps = [(n - 3, None, None), (n - 2, n - 8, n - 3), (n - 1, n - 7, n - 2), (n, n - 6, n - 1)]
    whole = _build(spark, tmp_path / "whole", market, [(n, None, None)])
    built = _build(spark, tmp_path / "steps", market, steps, spoil=True)
    assert built.keys() == whole.keys() and ("other", day(n - 1)) in whole
    last = [k for k in whole if k[1] == day(n - 1)]
    assert all(built[k] == whole[k] for k in last)
    for k in whole:  # a day keeps the staleness weight of its own run
        assert built[k].asDict() | {"geo_signal": 0} == whole[k].asDict() | {"geo_signal": 0}
    assert all(whole[k].cpi_yoy is not None and whole[k].ovx_zscore is not None for k in last)


@pytest.mark.parametrize("back", [4, 60])
def test_revised_days_count_however_old(spark, tmp_path, back):
    """A close of 4 days ago lies in the state's zone; one of 60 days ago needs the whole history."""
    n, market = 500, _market(500, 6)
    runs = [(n - 1, None, None), (n, n - 6, n - 1)]
    built = _build(spark, tmp_path / "steps", market, runs, revised=(n, n - back))
    whole = _build(spark, tmp_path / "whole", market, [(n - 1, None, None), (n, n - 6, None)], revised=(n, n - back))
    assert built[("k", day(n - 1))] == whole[("k", day(n - 1))]


def test_gate_writes_one_row_and_leaves_the_features(spark, sessions, full):
    stamps = spark.read.parquet(full.stamps)
    assert stamps.count() == 1
    seen = daily.stamped_features(spark, full).select("data_quality_score", "is_trading_day").distinct().collect()
    assert len(seen) == 1 and seen[0].data_quality_score == stamps.first().data_quality_score


def test_daily_write_is_one_row(spark, sessions, full):
    t = daily.Tables(scratch_path(spark, "job"))
    t.features, t.landed = full.features, full.landed
    for _ in range(2):
        daily.train_and_score(spark, t, sessions, str(day(N)), run_id="r2", **SMALL)
    assert [str(r.date) for r in K.read_scores(spark, t.scores).collect()] == [str(day(N - 1))]


def test_critical_finding_halts_before_the_table_changes(spark, sessions, full):
    before = L.read_features(spark, full.features).collect()
    with pytest.raises(Q.GateFailed, match="GAP"):
        daily.gate_features(spark, full, sessions, str(day(N + 5)))
    assert L.read_features(spark, full.features).collect() == before


def test_empty_macro(spark, full):
    t = daily.Tables(scratch_path(spark, "job"))
    with pytest.raises(Q.GateFailed):
        daily.update_features(spark, t, str(day(N)))
    t.features = full.features
    before = L.read_features(spark, t.features).count()
    daily.update_features(spark, t, str(day(N)))
    assert L.read_features(spark, t.features).count() == before


def test_scratch_tables_can_be_cleared(spark, tmp_path, monkeypatch):
    from panelwatch import session

    monkeypatch.setattr(session, "_SCRATCH", {})
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0
    assert L.read_parquet(spark, path, spark.range(0).schema).count() == 0


def test_an_empty_calendar_is_an_error(spark, sessions, full):
    with pytest.raises(ValueError, match="no session before"):
        daily.train_and_score(spark, full, sessions.limit(0), str(day(N)), run_id="r3", **SMALL)


def test_a_model_for_each_series_set(spark, sessions, full):
    """Two keys of the same values under a model of their own each score alike; a third key changes neither."""
    one = L.read_features(spark, full.features)
    other = one.withColumns({f: F.col(f) * 3 for f in S.FEATURES}).withColumn("series_key", F.lit("z"))
    t = daily.Tables(scratch_path(spark, "job"))
    t.stamps = full.stamps
    L.write_features(one.unionByName(other), t.features)
    daily.train_and_score(spark, t, sessions, str(day(N)), backfill=True, run_id="r4", by=["series_key"], **SMALL)
    alone = daily.Tables(scratch_path(spark, "job"))
    alone.stamps, alone.features = full.stamps, full.features
    daily.train_and_score(spark, alone, sessions, str(day(N)), backfill=True, run_id="r4", by=["series_key"], **SMALL)
    cols = ["date", "risk_score", "scores_if", "top_drivers"]
    both = K.read_scores(spark, t.scores).filter("series_key = 'k'").orderBy("date").select(cols).collect()
    assert both == K.read_scores(spark, alone.scores).orderBy("date").select(cols).collect() and len(both) > 100
    assert K.read_scores(spark, t.scores).filter("series_key = 'z'").count() == len(both)
    assert L.read_parquet(spark, t.runs, K.RUN_LOG).first().features_if


def test_merged_sources_give_the_history_of_all_landed_runs(spark):
    t = daily.Tables(scratch_path(spark, "job"))
    for upto in (60, 90):
        land(spark, t, upto, str(day(upto)))
    values = lambda: sorted(map(str, lookback.whole_history(spark, t.landed, str(day(90))).drop("run").collect()))
    before = values()
    daily.merge_sources(spark, t, str(day(60)))
    assert values() == before
    daily.merge_sources(spark, t, str(day(90)))
    assert values() == before
    files = lookback.whole_history(spark, t.landed, str(day(90))).inputFiles()
    assert files and all("_current/" in f for f in files)


def test_two_keys_with_calendars_of_their_own(spark):
    t = daily.Tables(scratch_path(spark, "job"))
    as_of = str(day(N))
    land(spark, t, N, as_of)
    for source in ("prices", "macro", "geo"):
        rows = spark.read.parquet(f"{t.landed}/{source}").drop("ingest_date")
        both = rows.unionByName(rows.withColumn("series_key", F.lit("z")))
        L.write_snapshot(settle(both), t.landed, source, as_of)
    daily.update_features(spark, t, as_of)
    held = [("even", day(i)) for i in range(0, N + 10, 2)] + [("odd", day(i)) for i in range(1, N + 10, 2)]
    sessions = spark.createDataFrame(held, "calendar string, date date")
    calendars = spark.createDataFrame([("k", "even"), ("z", "odd")], "series_key string, calendar string")
    daily.gate_features(spark, t, sessions, as_of, calendars)
    stamped = daily.stamped_features(spark, t).groupBy("series_key").agg(F.min("is_trading_day").alias("a"), F.max("is_trading_day").alias("b"))
    assert {r.series_key: (r.a, r.b) for r in stamped.collect()} == {"k": (True, True), "z": (False, False)}
    daily.train_and_score(spark, t, sessions, as_of, calendars=calendars, **SMALL)
    assert {r.series_key: r.date for r in K.read_scores(spark, t.scores).collect()} == {"k": day(N - 2), "z": day(N - 1)}
    with pytest.raises(ValueError, match="no session"):
        daily.train_and_score(spark, t, sessions.limit(0), as_of, calendars=calendars, **SMALL)
