"""Bringing tables of different sites into one layout."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata import config

log = logging.getLogger(__name__)


def align(df: DataFrame, columns: Sequence[str], layout: Sequence[str]) -> DataFrame:
    """Pick ``columns`` and give them the names of ``layout``, position by position, as text."""
    return df.select(*[F.col(c).cast("string").alias(name) for c, name in zip(columns, layout, strict=True)])


def union_sites(frames: Sequence[tuple[str, DataFrame]], *,
                columns: Mapping[str, Sequence[str]] = config.SITE_COLUMNS, fallback: str = "other",
                on_missing: str = "raise") -> DataFrame:
    """All rows of all sites in the shared layout, with the site name in ``platform``.

    Sites not listed in ``columns`` use the fallback columns. A frame that lacks a needed column raises, or on demand
    (``on_missing="skip"``) is left out with a warning that names it; ``left_out`` counts such rows.
    """
    layout = columns[fallback]
    parts = []
    for site, df in frames:
        wanted = columns.get(site, columns[fallback])
        missing = [c for c in wanted if c not in df.columns]
        if missing:
            if on_missing != "skip":
                raise ValueError(f"{site} lacks {missing}")
            log.warning("site %s left out, it lacks %s", site, missing)
            continue
        parts.append(align(df, wanted, layout).withColumn("platform", F.lit(site)))
    if not parts:
        raise ValueError("no site could be aligned")
    return reduce(DataFrame.unionByName, parts)


def left_out(frames: Sequence[tuple[str, DataFrame]], *, columns: Mapping[str, Sequence[str]] = config.SITE_COLUMNS,
             fallback: str = "other") -> dict[str, int]:
    """Number of rows of every site that lacks a needed column."""
    return {site: df.count() for site, df in frames if set(columns.get(site, columns[fallback])) - set(df.columns)}


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, frames)


def explode_pages(df: DataFrame, pages: str, keep: Sequence[str], name: str = "entry") -> DataFrame:
    """One row per entry of result pages that lie as lists in a list; empty pages give none."""
    return df.select(*keep, F.explode(F.flatten(pages)).alias(name))


def distinct_values(df: DataFrame, columns: Sequence[str], name: str | None = None) -> DataFrame:
    """Distinct non-null values of one column, or of several columns put under one name."""
    name = name or columns[0]
    parts = [df.select(F.col(c).alias(name)) for c in columns]
    return union_all(parts).dropna().distinct()


def explode_skills(df: DataFrame, skills: str = "skills", name: str = "skill_raw",
                   keep: Sequence[str] = ("job_id",)) -> DataFrame:
    """One row per posting and skill; postings without skills and null skills give none.

    The outer form with a filter behind it keeps Spark from evaluating the skill expression a
    second time just to test it for emptiness.
    """
    return df.select(*keep, F.explode_outer(skills).alias(name)).filter(F.col(name).isNotNull())


def first_detail(details: DataFrame, keys: Sequence[str] = ("platform", "job_id"), order: str = "fetched_at") -> DataFrame:
    """One detail row per posting: the earliest fetch where ``order`` is known, and of equal ones the smallest."""
    rest = [c for c in details.columns if c not in (*keys, order)]
    first = [F.col(order).isNull().alias("_late"), F.col(order)] if order in details.columns else []
    best = F.min(F.struct(*first, F.struct(*rest).alias("_d")))
    return details.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b._d.*")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Raise when a key occurs twice; otherwise return ``df``."""
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{what}: key {twice[0].asDict()} occurs more than once")
    return df
