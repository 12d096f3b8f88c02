"""Keyed loads for plain tables: what a MERGE statement would do, as joins.

Each function takes the current table and a batch and returns the new state (or, for the
insert-only ones, the rows to append), so running the same batch twice changes nothing.
The big table is only the streamed side: a small batch is broadcast by Spark from its measured
size, a large one is joined on the shuffled key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.operators.numbering import number_rows
from jobstrata.operators.unify import assert_unique


def _check(batch: DataFrame, columns: Sequence[str]) -> None:
    if not columns or batch.isEmpty():
        raise ValueError("an upsert needs a non-empty batch and at least one column")


def new_members(dim: DataFrame, batch: DataFrame, *, key: str, surrogate: str) -> DataFrame:
    """Dimension rows to insert: unseen keys with the next free surrogate ids."""
    unseen = batch.select(key).dropna().distinct().join(dim.select(key), key, "left_anti")
    top = dim.agg(F.max(surrogate)).first()[0]
    numbered = number_rows(unseen, [key], surrogate, start=(top or 0) + 1)
    filled = [F.col(f.name) if f.name in (key, surrogate) else F.lit(None).cast(f.dataType).alias(f.name)
              for f in dim.schema]
    return numbered.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(filled, dim.schema, strict=True)])


def upsert_dim(dim: DataFrame, batch: DataFrame, *, key: str, surrogate: str,
               columns: Sequence[str]) -> DataFrame:
    """Whole dimension after an upsert.

    When the key is the only column nothing can change in known rows, so only new keys are added;
    otherwise the listed columns of known rows take the values of the batch.
    """
    _check(batch, columns)
    extra = [c for c in columns if c != key]
    if not extra:
        return dim.unionByName(new_members(dim, batch, key=key, surrogate=surrogate))
    assert_unique(batch, [key], "dimension batch")
    renamed = batch.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in extra])
    known = dim.join(renamed, key, "left").select(*[
        (F.when(F.col("_hit"), F.col(f"_new_{f.name}")).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
         if f.name in extra else F.col(f.name)) for f in dim.schema])
    added = new_members(dim, batch, key=key, surrogate=surrogate)
    added = added.drop(*extra).join(batch.select(key, *extra), key, "left").select(*dim.columns)
    return known.unionByName(added)


def merge_facts(facts: DataFrame, batch: DataFrame, *, key: str = "job_id",
                refreshed: Sequence[str] = ("is_expired", "last_seen_id")) -> DataFrame:
    """Fact table after a merge: known rows refresh only ``refreshed``, unknown rows are added."""
    if batch.isEmpty():
        return facts
    assert_unique(batch, [key], "fact batch")
    fresh = batch.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in refreshed])
    kept = facts.join(fresh, key, "left").select(*[
        (F.when(F.col("_hit"), F.col(f"_new_{f.name}")).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
         if f.name in refreshed else F.col(f.name)) for f in facts.schema])
    added = batch.join(facts.select(key), key, "left_anti").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in facts.schema])
    return kept.unionByName(added)


def changes(facts: DataFrame, batch: DataFrame, *, key: str = "job_id",
            refreshed: Sequence[str] = ("is_expired", "last_seen_id")) -> DataFrame:
    """Rows of a batch that a merge would add or that would refresh something."""
    old = facts.select(F.col(key).alias("_key"), F.struct(*refreshed).alias("_now"))
    same = F.struct(*[F.col(c).cast(facts.schema[c].dataType).alias(c) for c in refreshed]).eqNullSafe(F.col("_now"))
    return batch.join(old, F.col(key) == F.col("_key"), "left").filter(~same).select(*batch.columns)


def new_bridge_rows(bridge: DataFrame, batch: DataFrame, keys: Sequence[str] = ("skill_id", "job_id")) -> DataFrame:
    """Distinct rows of the batch that the bridge does not hold yet."""
    keys = list(keys)
    return batch.select(*keys).distinct().join(bridge.select(*keys), keys, "left_anti")


def mark_expired(facts: DataFrame, date_dim: DataFrame, run_date: str) -> DataFrame:
    """Set ``is_expired`` where the posting was last seen before the run date."""
    seen = date_dim.select(F.col("date_id").alias("last_seen_id"), F.col("actual_date").alias("_seen"))
    stale = F.col("_seen") < F.lit(run_date).cast("date")
    return (facts.join(seen, "last_seen_id", "left")
            .withColumn("is_expired", F.coalesce(stale, F.col("is_expired")))
            .select(*facts.columns))
