"""Registered queries over the test feed, each with SQL for an independent engine where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import testfeed

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a feed under its name; ``sql`` builds on the feed's common table expressions."""

    def add(f: Callable[[testfeed.TestFeed], DataFrame]):
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(testfeed.TestFeed(spark, sf_dir))
        if sql:
            _SQL[f.__name__] = f"{testfeed.SQL.rstrip()}{sql}" if sql.startswith(",") else testfeed.SQL + sql
        return f

    return add


def _load() -> None:
    from . import audits, entities, rules, tables, timetable  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["q06_direct_legs"](spark, sf_dir)
