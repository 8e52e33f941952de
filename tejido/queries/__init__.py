"""Registered queries by group: each applies an operator of the engine to whole tables, with SQL that gives the same rows where there is such SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.fixtures import Tables

_RUN: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(key: str, run: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if key in _RUN:
        raise ValueError(f"{key} twice")
    _RUN[key] = run
    if sql:
        _SQL[key] = sql


def query(key: str, sql: str | None = None):
    def put(run):
        register(key, run, sql)
        return run

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import expressions, flows, frontier, pages, relational, sinks, sources  # noqa: F401

    return {key: (lambda spark, sf_dir, run=run: run(Tables(spark, sf_dir))) for key, run in _RUN.items()}


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
