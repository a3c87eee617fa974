"""Registered queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame,
paired with its independent DuckDB oracle SQL (when the operator is SQL-expressible)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .export import export
from .lake import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return export(fn(Lake(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run
    return deco
