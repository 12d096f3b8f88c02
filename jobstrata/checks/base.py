from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobstrata.session import prepare

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


class Tables:
    """Attribute access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of :class:`Tables` under its own name, with the SQL it must agree with."""

    def register(fn: Callable[[Tables], DataFrame]):
        REGISTRY[fn.__name__] = (lambda spark, folder: fn(Tables(spark, folder)), sql)
        return fn

    return register
