"""Named queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from queuecraft.session import shipped, tuned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf: fn(shipped(tuned(spark)), sf)
        if sql is not None:
            TWINS[name] = sql
        return fn
    return add
