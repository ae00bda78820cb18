"""Every query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect
from panelwatch.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    result, _ = compare(spark, con, name, SF)
    assert result.startswith(("ok", "rows only")), result


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_most_queries_have_sql():
    """The small forest's attribution has SQL; the daily forest's has too many leaves for it."""
    assert set(QUERIES) - set(ORACLES) == {"iforest_attribution"}


@pytest.mark.parametrize(
    "name, groups",
    [
        ("report_severity_bands", "SELECT DISTINCT gauge FROM q WHERE gauge IN ('red', 'orange', 'yellow')"),
        ("report_severity_bands", "SELECT DISTINCT gauge = tab FROM q"),
        ("quality_findings_moves", """SELECT DISTINCT "check" FROM q WHERE "check" IN ('CROSS_SOURCE', 'NULLS', 'GAP')"""),
        ("rolling_z_floor_flat", "SELECT DISTINCT abs(z) BETWEEN 1e-6 AND 0.2 AS floored, z = 0 AS flat FROM q WHERE z = 0 OR abs(z) < 0.2"),
        ("risk_scores", "SELECT DISTINCT scores_cp > 0 FROM q"),
    ],
)
def test_branches_fire(con, name, groups):
    """The rows of these queries do reach the rules they stand for; each statement lists the branches met."""
    want = groups.count("'") // 2 or 2
    assert len(con.sql(f"WITH q AS ({ORACLES[name]}) {groups}").fetchall()) == want


def test_incomplete_rows_go(con):
    n = lambda name: con.sql(f"SELECT count(*) FROM ({ORACLES[name]})").fetchall()[0][0]
    assert 0 < n("complete_cases_gaps") < n("complete_cases")


def test_entry_lists_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert not entry._present("no_such_module")
