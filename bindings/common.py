"""Helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Collects queries and their SQL under one name each."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def keep(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn

        return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison between engines; never a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def cents(c: str) -> Column:
    """Exact sum of an amount with two decimals."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
