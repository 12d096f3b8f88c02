"""Counts taken while rows pass, and null counts before repairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and an observation holding its row count once an action has run; no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def observed(df: DataFrame, name: str, nulls: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its rows and, under the given names, of the NULLs in columns, taken by the action that
    first runs it."""
    seen = Observation(name)
    counts = [F.count_if(F.col(column).isNull()).alias(alias) for alias, column in nulls.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in all and NULLs per column, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of each value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
