"""Consecutive numbers over a whole table without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobstrata.session import materialise

_SLOT_BITS = 33  # monotonically_increasing_id keeps the row position in the lower 33 bits


def number_rows(df: DataFrame, order: list, name: str = "row_no", start: int = 1) -> DataFrame:
    """Add ``name`` = start, start+1, ... in the given total order.

    Range partitions are sorted side by side, each counts its rows, and the running total of
    those counts (one row per partition, so safe to broadcast) shifts the local positions.
    """
    tagged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_slot", F.monotonically_increasing_id()))
    stored = materialise(tagged, "numbered").withColumn("_part", F.shiftright("_slot", _SLOT_BITS))
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    bases = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_base"))
    local = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return (stored.join(F.broadcast(bases), "_part")
            .withColumn(name, F.col("_base") + local + start)
            .drop("_part", "_slot", "_base"))
