"""Keyword relevance filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata import config
from jobstrata.functions import text


def keep_relevant(df: DataFrame, title: str = "job_title", *,
                  must_have: Iterable[str] = config.MUST_HAVE_WORDS,
                  positive: Iterable[str] = config.POSITIVE_WORDS,
                  negative: Iterable[str] = config.NEGATIVE_WORDS) -> DataFrame:
    """Rows whose title passes the three keyword lists; rows without a title are dropped."""
    return df.filter((F.length(title) > 0) & text.is_relevant(F.col(title), must_have, positive, negative))


def only_platform(df: DataFrame, *names: str, column: str = "platform") -> DataFrame:
    """Rows of the named sites."""
    return df.filter(F.col(column).isin(*names))


def except_platform(df: DataFrame, *names: str, column: str = "platform") -> DataFrame:
    """Rows of all other sites."""
    return df.filter(~F.col(column).isin(*names))
