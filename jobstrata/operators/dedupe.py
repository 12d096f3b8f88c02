"""First-seen rows and the set that still needs a label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def has_id(column: str | Column) -> Column:
    """False for identifiers that stand for "no identifier": NULL, empty and zero."""
    value = F.col(column) if isinstance(column, str) else column
    return value.isNotNull() & ~value.cast("string").isin("", "0")


def first_seen(df: DataFrame, keys: list[str], order: list, *, id_column: str | None = None) -> DataFrame:
    """Earliest row of every key in the given total order.

    Spark prunes each task to one row per key before the shuffle (window group limit), so a key
    that holds a large part of the table does not end up in one task.
    """
    if id_column:
        df = df.filter(has_id(id_column))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_first_rank", rank).filter(F.col("_first_rank") == 1).drop("_first_rank")


def not_in(df: DataFrame, known: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is absent from ``known``."""
    return df.join(known.select(on).distinct(), on, "left_anti")


def only_in(df: DataFrame, known: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is present in ``known``."""
    return df.join(known.select(on).distinct(), on, "left_semi")


def needs_label(df: DataFrame, loaded: DataFrame, *, job_id: str = "job_id", label: str = "label") -> DataFrame:
    """Unlabelled rows that are not in the loaded facts yet."""
    return not_in(df.filter(F.col(label).isNull() | (F.col(label) == "")), loaded, job_id)
