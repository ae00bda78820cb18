import datetime

import pytest
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.operators import quality as Q

D = datetime.date.fromisoformat


@pytest.fixture
def table(spark, days):
    """A clean feature table; ``change`` maps a column to {row from the end: value}."""

    def make(n=100, change=None, keys=("k",), **fixed):
        change = change or {}
        rows = []
        for key in keys:
            for i, d in enumerate(days(n)):
                row = {f: 0.01 for f in S.FEATURES}
                row.update(is_trading_day=True, data_quality_score=1.0, data_quality_flags="", gpr_is_stale=False, gpr_days_stale=0)
                row.update(fixed)
                for c, at in change.items():
                    if n - 1 - i in at:
                        row[c] = at[n - 1 - i]
                rows.append((key, d, *[row[c] for c in S.FEATURE_TABLE.names[2:]]))
        return spark.createDataFrame(rows, S.FEATURE_TABLE)

    return make


def texts(found):
    return [r.message for r in found.orderBy("position").collect()]


LAST = D("2010-04-10")  # the last of 100 days from 2010-01-01


def test_clean(table):
    df = table()
    found = Q.findings(df, LAST)
    assert texts(found) == []
    Q.enforce(found)
    row = Q.stamp(df, found, False).first()
    assert (row.data_quality_score, row.data_quality_flags, row.is_trading_day) == (1.0, "", False)
    assert Q.stamp(df, found, True).columns == df.columns


def test_missing_column(table):
    found = Q.findings(table().drop("cpi_yoy", "gpr_is_stale"), LAST)
    assert texts(found) == ["SCHEMA: missing columns ['cpi_yoy', 'gpr_is_stale']"]
    with pytest.raises(Q.GateFailed, match="SCHEMA"):
        Q.enforce(found)


def test_no_rows(table):
    found = Q.findings(table().limit(0), LAST)
    assert texts(found) == ["COMPLETENESS: zero rows"]
    with pytest.raises(Q.GateFailed):
        Q.enforce(found)


@pytest.mark.parametrize("session, day, hit", [("2010-04-12", True, True), ("2010-04-12", False, False), ("2010-04-11", True, False)])
def test_gap(table, session, day, hit):
    want = ["GAP: last date is 2010-04-10, expected 2010-04-12"] if hit else []
    assert texts(Q.findings(table(), D(session), day)) == want


@pytest.mark.parametrize("ovx, day, hit", [(0.5, True, True), (1.5, True, False), (None, True, False), (0.5, False, False)])
def test_large_move_with_calm_volatility(table, ovx, day, hit):
    df = table(change={"brent_ret_1d": {0: -0.1163}, "ovx_zscore": {0: ovx}})
    got = [t for t in texts(Q.findings(df, LAST, day)) if t.startswith("CROSS")]
    assert got == (["CROSS_SOURCE: Brent moved 11.6% but vol indices flat"] if hit else [])


def test_absent_volatility_column_counts_as_calm(table):
    df = table(change={"brent_ret_1d": {0: 0.2}}).drop("vix_zscore")
    assert "CROSS_SOURCE: Brent moved 20.0% but vol indices flat" in texts(Q.findings(df, LAST))


@pytest.mark.parametrize("stale, hit", [(10, False), (11, True)])
def test_stale(table, stale, hit):
    want = ["GPR_STALE: 11 days stale — OVX fallback active"] if hit else []
    assert texts(Q.findings(table(gpr_days_stale=stale), LAST)) == want


@pytest.mark.parametrize("nulls, hit", [(3, False), (4, True)])
def test_null_share(table, nulls, hit):
    df = table(change={"fed_rate": {i: None for i in range(1, nulls + 1)}, "hy_spread": {i: None for i in range(60, 90)}})
    assert texts(Q.findings(df, LAST)) == (["NULLS: fed_rate is 7% null in last 60 rows"] if hit else [])


def test_source_missing(table):
    df = table(change={c: {0: None} for c in Q.PRICE_PROBES})
    assert texts(Q.findings(df, LAST)) == ["SOURCE_MISSING: all price features null today"]
    assert texts(Q.findings(table(change={"ng_ret_1d": {0: None}}), LAST)) == []


def test_score_and_flags_go_to_their_own_key(table):
    bad = table(change={"fed_rate": {i: None for i in range(30)}}, gpr_days_stale=12, keys=("bad",))
    df = bad.unionByName(table(keys=("good",)))
    out = Q.stamp(df, Q.findings(df, LAST), True)
    rows = {r.series_key: r for r in out.select("series_key", "data_quality_score", "data_quality_flags").distinct().collect()}
    assert rows["good"][1:] == (1.0, "")
    assert rows["bad"].data_quality_score == pytest.approx(0.8)
    assert rows["bad"].data_quality_flags == (
        "GPR_STALE: 12 days stale — OVX fallback active|NULLS: fed_rate is 50% null in last 60 rows"
    )
    assert out.count() == 200


def test_score_never_negative(table):
    df = table(change={f: {i: None for i in range(10)} for f in S.FEATURES[:12]})
    assert Q.stamp(df, Q.findings(df, LAST), True).select(F.min("data_quality_score")).first()[0] == 0.0


def test_empty_source(table):
    full, empty = table(), table().limit(0)
    assert Q.on_empty_source(full, empty) is None
    assert Q.on_empty_source(empty, full) is full
    for policy, existing in (("keep_existing", empty), ("fail", full)):
        with pytest.raises(Q.GateFailed):
            Q.on_empty_source(empty, existing, policy)


def test_no_finding_is_lost(spark, tmp_path):
    rows = [(f"k{i:03d}", "CRITICAL", "GAP", f"GAP: {i}", 0) for i in range(60)]
    found = spark.createDataFrame(rows, "series_key string, severity string, check string, message string, position int")
    path = str(tmp_path / "findings")
    with pytest.raises(Q.GateFailed, match="60 critical findings"):
        Q.enforce(found, path)
    assert spark.read.parquet(path).select("message").distinct().count() == 60
