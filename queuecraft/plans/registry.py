"""Named queries over a folder of tables, each with its SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuecraft.session import shipped, tuned

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, sf: fn(shipped(tuned(spark)), sf)
        if sql is not None:
            TWINS[name] = sql
        return fn
    return add


def rounded(df: DataFrame, digits: int = 6, *, only: dict[str, int] | None = None) -> DataFrame:
    """Round the fractional columns: two engines add doubles in different orders."""
    digits_of = only or {}
    return df.select(*[F.round(F.col(c), digits_of.get(c, digits)).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def r(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)
