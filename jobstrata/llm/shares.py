"""Joins whose work per key is bounded although a few keys hold a large part of the rows, and joins that leave rows in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 1000
BITS = 1 << 26  # 8 MB, whatever the size of the input


def attach(rows: DataFrame, value: Column, per_key: DataFrame, key: str, n: str, take: Sequence[str]) -> DataFrame:
    """Rows with the columns ``take`` of the one row that ``per_key`` holds for their ``value``; others are left out.

    ``n`` tells how many rows have the key. Fewer than ``PARTS`` keys can hold more than one part in ``PARTS`` of all rows:
    they are broadcast and their rows stay where they are. No key of the shuffled rest is larger than that part. NULL is a
    key like any other. ``per_key`` is read twice and should be a stored table. A column of ``rows`` that is named like a
    taken one is replaced.
    """
    total = per_key.agg(F.sum(n)).first()[0] or 0
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in take]
    packed = rows.select(F.struct(*rest).alias("row"), value.alias("of"))
    side = per_key.select(F.col(key).alias("key"), F.col(n).alias("n"), F.struct(*take).alias("taken"))
    heavy, light = F.broadcast(side.where(F.col("n") * PARTS > total)), side.where(F.col("n") * PARTS <= total)
    same = F.col("of").eqNullSafe(F.col("key"))
    hot = packed.join(heavy, same)
    cold = packed.join(heavy.select("key"), same, "left_anti").join(light, same)
    return hot.unionByName(cold).select("row.*", "taken.*")


def may_hold(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` occurs among that of ``ids``, and a few others; rows without a key are left out.

    For rows too wide to be shuffled when an exact join of something narrower follows. The ids set bits of a bitmap of fixed
    size, which is broadcast, and rows stay where they are. The more ids there are, the more other rows come along; none is
    ever missed. Ids of another type than the key are not comparable by hash: then all rows with a key come along.
    """
    named = rows.where(F.col(key).isNotNull())
    if rows.schema[key].dataType != ids.schema[key].dataType:
        return named
    place = F.pmod(F.xxhash64(key), F.lit(BITS))
    part, at = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bitmap = ids.where(F.col(key).isNotNull()).select(part.alias("_part"), at.alias("_at")).groupBy("_part").agg(
        F.bitmap_construct_agg("_at").alias("_bits"))  # a row of 4 KB per 32,768 bits
    byte = F.conv(F.hex(F.substring("_bits", F.expr("cast(_at div 8 as int) + 1"), F.lit(1))), 16, 10).cast("int")
    marked = named.select(*[F.col(f"`{c}`") for c in rows.columns], part.alias("_part"), at.alias("_at"))
    return (marked.join(F.broadcast(bitmap), "_part").where(F.getbit(byte, F.expr("cast(_at % 8 as int)")) == 1)
            .select(*[F.col(f"`{c}`") for c in rows.columns]))
