"""Queries by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def staged(name: str):
    """Keep a table that many queries start from, as the daily job does.

    It is written to the shared folder once per session and input folder; later
    queries read that table.  ``forget_staged`` makes the next query start over.
    """

    def wrap(build):
        def get(spark: SparkSession, sf: str) -> DataFrame:
            at = (spark.sparkContext.applicationId, sf, name)
            if at not in _STAGED:
                _STAGED[at] = settle(build(spark, sf))
            return _STAGED[at]

        return get

    return wrap


def forget_staged() -> None:
    _STAGED.clear()


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


def recursive(*ctes: str) -> str:
    return with_(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)


def r6(c: Column | str, name: str | None = None) -> Column:
    """Rounded for comparison across engines, without a negative zero."""
    out = F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)
    return out.alias(name or c) if name or isinstance(c, str) else out


def r6_sql(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {name}"


def text(c: str = "date") -> Column:
    return F.col(c).cast("string").alias(c)
