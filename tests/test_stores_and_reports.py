import datetime

import pytest
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.functions import scalar as C
from panelwatch.operators import aggregates as A
from panelwatch.operators import signals as G
from panelwatch.plans import reports as R
from panelwatch.session import scratch_path
from panelwatch.sources import commits
from panelwatch.sources import landing as L
from panelwatch.sources import scores as K

D = datetime.date.fromisoformat


@pytest.fixture
def scores(spark, days):
    def make(values, start="2020-01-01", key="k", **cols):
        rows = [(key, d, float(v)) for d, v in zip(days(len(values), start), values)]
        df = spark.createDataFrame(rows, "series_key string, date date, risk_score double")
        return K.narrow(df.withColumns({c: F.lit(v) for c, v in cols.items()}))

    return make


def test_upsert_twice_and_evolution(spark, scores):
    path = scratch_path(spark, "t")
    old = S.T.StructType([f for f in S.SCORE_TABLE.fields if not f.name.startswith("threshold_")])
    K.upsert_scores(spark, path, scores(range(60)), old)
    for _ in range(2):
        K.upsert_scores(spark, path, scores([100] * 5, "2020-02-15", threshold_1y=2.0))
    got = K.read_scores(spark, path)
    assert got.count() == 60 and got.columns == S.SCORE_TABLE.names
    assert got.filter("risk_score = 100 AND threshold_1y = 2").count() == 5
    assert got.filter("risk_score < 100 AND threshold_1y IS NULL").count() == 55


def test_upsert_leaves_other_months_alone(spark, scores):
    path = scratch_path(spark, "t")
    K.upsert_scores(spark, path, scores(range(90)))
    files = lambda m: sorted(r.f for r in spark.read.parquet(path).filter(f"month = '{m}'").select(F.input_file_name().alias("f")).distinct().collect())
    january, march = files("2020-01"), files("2020-03")
    K.upsert_scores(spark, path, scores([7], "2020-03-05"))
    assert files("2020-01") == january and files("2020-03") != march
    assert K.read_scores(spark, path).count() == 90


def test_rows_to_write(scores):
    df = scores(range(10))
    assert K.rows_to_write(df, "2020-01-04", True).count() == 4
    assert [str(r.date) for r in K.rows_to_write(df, "2020-01-04", False).collect()] == ["2020-01-04"]
    assert [str(r.date) for r in K.rows_to_write(df, "2021-01-04", False).collect()] == ["2020-01-10"]


def test_snapshots(spark, panel):
    root = scratch_path(spark, "landed")
    df = panel({"a": [1, 2, 3]})
    schema = df.schema
    assert L.write_snapshot(df, root, "s", "2020-01-01")
    assert L.write_snapshot(df.withColumn("x", F.col("x") + 10), root, "s", "2020-01-02")
    assert L.write_snapshot(df.limit(1), root, "s", "2020-01-02")
    assert not L.write_snapshot(df.limit(0), root, "s", "2020-01-01")
    assert L.read_snapshot(spark, root, "s", schema, "2020-01-01").count() == 3
    assert L.read_snapshot(spark, root, "s", schema, "2020-01-02").count() == 1
    assert L.read_snapshot(spark, root, "s", schema, "2020-01-03").isEmpty()
    assert L.read_snapshot(spark, root, "nothing", schema, "2020-01-01").isEmpty()
    assert L.read_history(spark, root, "s", schema, ["series_key", "date"]).count() == 3


def test_geo_csv(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("2020-01-01", 100.5, 3.0), ("2020-01-03", None, 4.0)], "Date string, GPR_AI double, GPR_OIL double").write.option(
        "header", True
    ).csv(path)
    rows = L.read_geo_csv(spark, path, "2020-01-14").orderBy("date").collect()
    assert [(r.date, r.GPR_AI, r.gpr_days_stale, r.gpr_is_stale) for r in rows] == [
        (D("2020-01-01"), 100.5, 11, True),
        (D("2020-01-03"), None, 11, True),
    ]


def test_wide_sources(spark):
    bars = spark.createDataFrame(
        [("k", D("2020-01-01"), "XLE", 1.0), ("k", D("2020-01-02"), "BZ=F", 2.0)], S.PRICES_RAW
    )
    rows = L.wide_prices(bars).orderBy("date").collect()
    assert [(r["XLE"], r["BZ=F"], r["^VIX"]) for r in rows] == [(1.0, None, None), (None, 2.0, None)]


def test_dates_drop_their_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2020-03-01 23:59:00' AS a, '2020-03-01T22:00:00' AS b")
    assert df.select(L.as_date("a"), L.as_date("b")).first()[:] == (D("2020-03-01"), D("2020-03-01"))


@pytest.mark.parametrize("zone, first", [("America/Chicago", "2020-03-01"), ("Asia/Tokyo", "2020-03-02")])
def test_instants_take_the_day_of_their_zone(spark, zone, first):
    df = spark.sql("SELECT timestamp_ltz'2020-03-02 03:00:00 UTC' AS a, '2020-03-01T22:00:00-05:00' AS b")
    assert df.select(L.as_date("a", zone), L.as_date("b")).first()[:] == (D(first), D("2020-03-01"))


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Note,GPR_OIL,Date,GPR_AI\nx,1.5,2020-01-01,2\ny,NaN,2020-01-02, 3.25\n")
    rows = L.read_geo_csv(spark, str(tmp_path / "a.csv"), "2020-01-03").orderBy("date").collect()
    assert [(r.GPR_AI, r.GPR_OIL) for r in rows] == [(2.0, 1.5), (3.25, None)]
    (tmp_path / "b.csv").write_text("Date,GPR_AI,GPR_OIL\n2020-01-01,abc,1\n")
    with pytest.raises(Exception, match="abc"):
        L.read_geo_csv(spark, str(tmp_path / "b.csv"), "2020-01-03").collect()
    (tmp_path / "c.csv").write_text("Date,GPR_AI\n2020-01-01,1\n")
    with pytest.raises(ValueError, match="GPR_OIL"):
        L.read_geo_csv(spark, str(tmp_path / "c.csv"), "2020-01-03")


def test_nan_is_missing_in_every_source(spark, tmp_path):
    nan = float("nan")
    bars = spark.createDataFrame([("k", D("2020-01-01"), "CL=F", nan), ("k", D("2020-01-02"), "CL=F", 5.0)], S.PRICES_RAW)
    L.write_snapshot(bars, str(tmp_path), "prices", "2020-01-03")
    got = L.read_history(spark, str(tmp_path), "prices", S.PRICES_RAW, ["series_key", "date", "ticker"])
    assert {r.close for r in got.collect()} == {None, 5.0}
    assert {r["CL=F"] for r in L.wide_prices(bars).collect()} == {None, 5.0}


def test_a_batch_stores_one_row_per_key_and_date(spark, tmp_path):
    rows = spark.createDataFrame([("k", D("2020-01-01"), 1.0), ("k", D("2020-01-01"), 2.0)], "series_key string, date date, risk_score double")
    K.upsert_scores(spark, str(tmp_path), rows)
    assert [r.risk_score for r in K.read_scores(spark, str(tmp_path)).collect()] == [2.0]


def test_look_back(panel):
    df = panel({"a": range(10)})
    assert [r.x for r in L.look_back(df, "2010-01-08", False).orderBy("x").collect()] == [3, 4, 5, 6, 7]
    assert L.look_back(df, "2010-01-08", True).count() == 10
    assert L.look_back(df, "2010-01-08", True, start="2010-01-05").count() == 6


def test_nan_becomes_null(spark):
    df = spark.sql("SELECT double('NaN') AS x UNION ALL SELECT 1.0D")
    assert sorted(df.select(C.nan_to_null("x").alias("x")).toPandas().x.isna()) == [False, True]
    assert df.select(C.nan_to_null("x").alias("x")).filter("x IS NULL").count() == 1


def test_thresholds_and_flags(panel):
    s = G.Series.of(panel({"a": [1.0] * 40 + [2.0]}).withColumnRenamed("x", "risk_score"))
    rows = G.anomaly_flags(s).df.orderBy("date").collect()
    assert [r.anomaly_static for r in rows] == [False] * 40 + [True]
    assert rows[29].threshold_qtr is None and rows[29].anomaly_qtr is False
    assert rows[30].threshold_qtr == 1.0 and rows[40].anomaly_qtr is True
    assert rows[40].threshold_1y is None and rows[40].anomaly_1y is False


def test_pruning_is_not_greedy(spark):
    df = spark.range(2000).select(
        F.sin("id").alias("a"),
        (F.sin("id") + 0.45 * F.cos("id")).alias("b"),
        (F.sin("id") + 0.9 * F.cos("id")).alias("c"),
        F.lit(5.0).alias("flat"),
    )
    corr = {(r.a, r.b): r["corr"] for r in A.correlations(df, ["a", "b", "c", "flat"]).collect()}
    assert corr["a", "b"] > 0.85 > corr["a", "c"] and corr["b", "c"] > 0.85 and corr["a", "flat"] is None
    assert A.prune_features(df, ["a", "b", "c", "flat"]) == ["a", "flat"]


def test_weekly_last_value(panel):
    df = panel({"a": [1, 2, 3, None, None, 6, 7, None, None, None]}, start="2020-01-06")  # a Monday
    rows = A.weekly_last(df, ["x"]).orderBy("week_end").collect()
    assert [(str(r.week_end), r.x) for r in rows] == [("2020-01-12", 7.0)]


def test_attribution_budget_and_ties(spark):
    df = spark.createDataFrame([(3.0, -1.0, 1.0, 2.0, 6.0, 0.0), (None, None, None, 1.0, 1.0, 2.0)], "z_a double, z_b double, z_c double, s_a double, s_b double, s_c double")
    rows = G.attribute(df, ["a", "b", "c"], ["s_a", "s_b", "s_c"], k=2, keep_all=True).collect()
    assert sum(w.weight for w in rows[0].attribution) == pytest.approx(0.75)
    assert sum(w.weight for w in rows[1].attribution) == pytest.approx(0.40)
    assert [(d.feature, round(d.weight, 6)) for d in rows[0].top_drivers] == [("b", 0.37), ("a", 0.31)]
    assert [d.feature for d in rows[1].top_drivers] == ["c", "a"]  # a and b tie


def test_months_before_clamps(spark):
    got = spark.sql("SELECT date'2020-05-31' AS d, date'2019-05-31' AS e").select(C.months_before("d", 3), C.months_before("e", 3)).first()
    assert [str(v) for v in got] == ["2020-02-29", "2019-02-28"]


def test_percentile_ranks_are_strict(scores):
    df = scores([1, 2, 2, 3, 2], threshold_qtr=3.0, threshold_static=0.5)
    got = {r.window: (r.pct, r.threshold_pct) for r in R.percentiles(df).collect()}
    assert got["Quarter"] == (20.0, 80.0) and got["Historical"] == (20.0, 0.0) and got["1-year"] == (20.0, 0.0)


@pytest.mark.parametrize(
    "pct, thr, flag, gauge, tab",
    [(95, 95, False, "red", "orange"), (90, 95, False, "orange", "orange"), (70, 95, True, "yellow", "red"), (50, 95, False, "green", "green")],
)
def test_severity(spark, pct, thr, flag, gauge, tab):
    df = spark.createDataFrame([(float(pct), float(thr), flag)], "p double, t double, f boolean")
    assert df.select(C.severity("p", "t"), C.severity("p", "t", "f")).first()[:] == (gauge, tab)


def test_breached_windows_in_report_order(scores):
    df = scores([1, 2], threshold_qtr=1.0, anomaly_qtr=True, anomaly_static=True, anomaly_1y=False, anomaly_5y=False)
    assert {r.breached for r in R.severities(df).collect()} == {"Quarter, Historical"}


def drivers(*pairs):
    return F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(float(w)).alias("weight")) for f, w in pairs])


def test_driver_shares_add_up(scores):
    top = drivers(("brent_ret_1d", 0.3), ("unknown", 0.2), ("cpi_yoy", 0.1), ("fed_rate", 0.05), ("dxy_zscore", 0.05))
    df = scores([1, 2]).withColumn("top_drivers", top)
    got = {r.feature: r.importance for r in R.driver_shares(df).collect()}
    assert got == {"Brent crude daily move": 42.9, "unknown": 28.6, "Inflation pressure": 14.3, "Elevated interest rates": 7.1, "Others": 7.1}
    assert sum(got.values()) == pytest.approx(100)


def test_history_and_log(scores):
    df = scores(range(400)).withColumn("anomaly_static", F.col("risk_score") >= 398)
    df = df.withColumn("top_drivers", F.when(F.col("risk_score") == 399, drivers(("cpi_yoy", 3), ("x", 1))))
    assert R.history(df, "3m").count() == 91 and R.history(df, "All").count() == 400
    assert R.history(df, "3m", "2020-03-31").count() == 91
    assert R.anomaly_points(R.history(df, "1y")).count() == 2
    log = R.anomaly_log(df).collect()
    assert [(r.date, r.stress_score, r.top_drivers) for r in log] == [
        ("2021-02-03", "399.0", "Inflation pressure (75%) · x (25%)"),
        ("2021-02-02", "398.0", ""),
    ]


def test_driver_texts_that_cannot_be_read_give_no_drivers(spark):
    rows = [('["a","b"]', "[0.5, 0.25]"), (None, "[1.0]"), ("not json", "[1.0]"), ('["a"]', None)]
    df = spark.createDataFrame(rows, "n string, w string").select(K.drivers_from_text(F.col("n"), F.col("w")).alias("d"))
    got = [[tuple(x) for x in r.d] for r in df.collect()]
    assert got == [[("a", 0.5), ("b", 0.25)], [], [], [("a", None)]]


def test_new_days_are_added_and_stored_files_stay(spark, tmp_path):
    path = str(tmp_path / "scores")

    def day(d, score):
        rows = [(k, datetime.date(2020, 1, d), score) for k in "ab"]
        return spark.createDataFrame(rows, "series_key string, date date, risk_score double")

    files = lambda: {f for f in tmp_path.rglob("*.parquet")}
    K.upsert_scores(spark, path, day(1, 1.0))
    first = files()
    K.upsert_scores(spark, path, day(2, 2.0))
    assert first < files()
    K.upsert_scores(spark, path, day(2, 3.0).unionByName(day(3, 4.0)))  # a revised day beside a new one
    got = sorted((r.series_key, r.date.day, r.risk_score) for r in K.read_scores(spark, path).collect())
    assert got == [(k, d, s) for k in "ab" for d, s in ((1, 1.0), (2, 3.0), (3, 4.0))]


def test_null_keys_and_dates_are_neither_lost_nor_doubled(spark):
    path = scratch_path(spark, "t")
    rows = lambda *r: K.narrow(spark.createDataFrame([(k, d and D(d), v) for k, d, v in r], "series_key string, date date, risk_score double"))
    stored = lambda: sorted((r.series_key or "", str(r.date), r.risk_score) for r in K.read_scores(spark, path).collect())
    K.upsert_scores(spark, path, rows(("a", "2020-01-01", 1.0)))
    batch = rows(("a", "2020-01-01", 2.0), ("z", None, 3.0), (None, "2020-02-01", 4.0), (None, None, 5.0))
    for _ in range(3):  # the first run replaces a month, and has rows of no month
        K.upsert_scores(spark, path, batch)
        assert stored() == [("", "2020-02-01", 4.0), ("", "None", 5.0), ("a", "2020-01-01", 2.0), ("z", "None", 3.0)]
    K.upsert_scores(spark, path, rows(("z", None, 6.0)))
    assert ("z", "None", 6.0) in stored() and ("", "None", 5.0) in stored() and len(stored()) == 4


def test_a_batch_is_seen_whole_or_not_at_all(spark, scores, monkeypatch):
    path = scratch_path(spark, "t")
    stored = lambda n=None: sorted((str(r.date), r.risk_score) for r in K.read_scores(spark, path, number=n).collect())
    K.upsert_scores(spark, path, scores(range(3)))
    before = stored()
    batch = scores([9.0], "2020-01-02").unionByName(scores([8.0], "2020-02-01"))  # replaces in one month, adds in another

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", stop)
        with pytest.raises(RuntimeError, match="lost"):
            K.upsert_scores(spark, path, batch)
    assert stored() == before
    K.upsert_scores(spark, path, batch)
    after = [("2020-01-01", 0.0), ("2020-01-02", 9.0), ("2020-01-03", 2.0), ("2020-02-01", 8.0)]
    assert stored() == after and stored(0) == before
    assert commits.clean(spark, path, keep=1) == 3 and stored() == after  # the stopped run's two folders, the first month's old one
    with pytest.raises(ValueError, match="version 0"):
        stored(0)


def test_a_stopped_first_batch_leaves_no_table(spark, scores, monkeypatch):
    path = scratch_path(spark, "t")
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            K.upsert_scores(spark, path, scores(range(3)))
    assert K.read_scores(spark, path).isEmpty()
    K.upsert_scores(spark, path, scores([5.0]))
    assert [r.risk_score for r in K.read_scores(spark, path).collect()] == [5.0]


def test_of_two_batches_on_one_version_the_second_is_refused(spark, scores):
    path = scratch_path(spark, "t")
    K.upsert_scores(spark, path, scores(range(3)))
    base = commits.version(spark, path)
    rows = scores([7.0], "2020-03-01").withColumn("month", F.lit("2020-03"))
    commits.write(rows, path, base)
    with pytest.raises(commits.Conflict):
        commits.write(rows, path, base)
    assert K.read_scores(spark, path).count() == 4


def test_a_table_of_plain_month_folders_joins_the_first_batch(spark, scores):
    path = scratch_path(spark, "t")
    scores(range(40)).withColumn("month", L.month_of()).write.partitionBy("month").parquet(path)
    assert K.read_scores(spark, path).count() == 40
    K.upsert_scores(spark, path, scores([99.0], "2020-02-03").unionByName(scores([98.0], "2020-03-01")))
    got = {str(r.date): r.risk_score for r in K.read_scores(spark, path).collect()}
    assert len(got) == 41 and got["2020-01-01"] == 0 and got["2020-02-03"] == 99 and got["2020-02-04"] == 34
    K.upsert_scores(spark, path, scores([], "2020-02-03"))
    assert commits.versions(spark, path) == [0]


def test_the_current_table_equals_the_history_of_all_runs(spark, panel):
    ids, root, plain = ["series_key", "date"], scratch_path(spark, "landed"), scratch_path(spark, "landed")
    whole = panel({"a": range(100), "b": [None, 1.0] + [2.0] * 80})
    schema = whole.schema
    odd = spark.createDataFrame([(None, D("2010-02-01"), 1.0), ("a", None, 2.0), ("b", D("2010-01-02"), None)], schema)
    runs = {
        "2020-01-01": whole,
        "2020-01-02": odd,
        "2020-01-03": whole.filter("date > '2010-03-25'").withColumn("x", F.col("x") + 10),
        "2020-01-04": panel({"b": [float("nan"), 7.0]}),
    }
    stored = lambda at, until=None: sorted((str(r.series_key), str(r.date), str(r.x)) for r in L.read_history(spark, at, "s", schema, ids, until).collect())
    for run, df in runs.items():
        for at in (root, plain):
            L.write_snapshot(df, at, "s", run)
        assert stored(root) == stored(plain)  # a run not merged yet counts too
        assert L.merge_landed(spark, root, "s", schema, ids) == [run] and L.merge_landed(spark, root, "s", schema, ids) == []
        assert stored(root) == stored(plain)
    assert stored(root, "2020-01-02") == stored(plain, "2020-01-02") != stored(root)
    opened = L.read_history(spark, root, "s", schema, ids).inputFiles()
    assert opened and all("/s_current/" in f for f in opened)
    for at in (root, plain):  # a run that was counted lands again, with fewer rows
        L.write_snapshot(odd.limit(1), at, "s", "2020-01-02")
    assert stored(root) == stored(plain)
    assert L.merge_landed(spark, root, "s", schema, ids) == list(runs) and stored(root) == stored(plain)


def test_a_merge_opens_new_runs_and_their_months_only(spark, panel):
    ids, root = ["series_key", "date"], scratch_path(spark, "landed")
    schema = panel({"a": [1]}).schema
    L.write_snapshot(panel({"a": range(200)}), root, "s", "2020-01-01")
    L.merge_landed(spark, root, "s", schema, ids)
    path = L.current_path(root, "s")
    before = set(commits.version(spark, path).folders)
    L.write_snapshot(panel({"a": [5, 6]}, "2010-07-19"), root, "s", "2020-01-02")
    L.merge_landed(spark, root, "s", schema, ids)
    after = set(commits.version(spark, path).folders)
    assert {f.split("/")[0] for f in before ^ after} == {"month=2010-07"}
    assert L.read_history(spark, root, "s", schema, ids).count() == 201  # one day revised, one new
    L.write_snapshot(panel({"a": [1]}, "2010-07-30"), root, "s", "2020-01-09")
    assert L.merge_landed(spark, root, "s", schema, ids, until="2020-01-08") == []
    with pytest.raises(ValueError, match="date"):
        L.merge_landed(spark, root, "s", schema, ["series_key"])


def test_rows_that_cannot_be_read_are_kept_aside(spark, tmp_path):
    path, aside = str(tmp_path / "a.csv"), str(tmp_path / "rejects")
    lines = ["Note,GPR_OIL,Date,GPR_AI,reasons", "x,1.5,2020-01-01,2,q", "y,NaN, 2020-01-02 ,", "z,1e,never,3", "w,1,,4", "v,,2020-01-03,1x", "u,,2020-01-04,"]
    (tmp_path / "a.csv").write_text("\n".join(line for line in lines))
    with pytest.raises(L.TooManyRejects, match="3 of 6"):
        L.read_geo_csv(spark, path, "2020-01-05", rejects=aside, limit=0.4)
    for _ in range(2):  # a rerun replaces the day's rejects
        rows = L.read_geo_csv(spark, path, "2020-01-05", rejects=aside, limit=0.5).orderBy("date").collect()
        assert [(str(r.date), r.GPR_AI, r.GPR_OIL, r.gpr_days_stale) for r in rows] == [
            ("2020-01-01", 2.0, 1.5, 1), ("2020-01-02", None, None, 1), ("2020-01-04", None, None, 1),
        ]
    kept = {r.Note: (r.Date, r.GPR_AI, r.GPR_OIL, list(r["__faults"])) for r in L.read_rejects(spark, aside).collect()}
    assert kept == {"z": ("never", "3", "1e", ["Date", "GPR_OIL"]), "w": (None, "4", "1", ["Date"]), "v": ("2020-01-03", "1x", None, ["GPR_AI"])}
    (tmp_path / "c.csv").write_text("Date,GPR_AI,GPR_OIL\n")
    assert L.read_geo_csv(spark, str(tmp_path / "c.csv"), "2020-01-05", rejects=aside).isEmpty()
