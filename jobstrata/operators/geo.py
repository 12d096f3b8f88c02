"""Nearest place of a gazetteer without comparing every point with every place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobstrata.functions.dates import first_slash_date
from jobstrata.operators.unify import first_detail
from jobstrata.session import materialise, scratch

LEAF = 16        # places of a cell that are compared one by one
DEEPEST = 20     # halvings of the cube around the unit sphere: cells of about 12 m
_SLACK = 1e-12   # of squared chords, for rounding


def _xyz(lat: Column, lon: Column) -> list[Column]:
    phi, lam = F.radians(lat), F.radians(lon)
    return [F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)]


def _cell(level: int) -> Column:
    """Number of the cell of ``gx, gy, gz`` after so many halvings of each axis."""
    key = F.lit(0).cast("long")
    for axis in "xyz":
        step = F.least(F.floor((F.col(f"g{axis}") + 1) / 2 * (1 << level)), F.lit((1 << level) - 1))
        key = F.shiftleft(key, 21) + F.greatest(step, F.lit(0))
    return key


def _parent(key: Column) -> Column:
    """The cell around a cell, one level up."""
    part = lambda shift: F.shiftright(key, shift).bitwiseAND(F.lit((1 << 21) - 1))
    return sum((F.shiftleft(F.shiftright(part(s), 1), s) for s in (42, 21, 0)), F.lit(0).cast("long"))


def _chord2(*gaps: Column) -> Column:
    return sum((F.pow(g, 2.0) for g in gaps), F.lit(0.0))


def near_candidates(spots: DataFrame, places: DataFrame) -> DataFrame:
    """``spot`` with the columns of a few places, the nearest one always among them.

    Cells of an octree are gone through from the whole sphere down. A cell knows the box around its places, so it bounds
    the distance of a spot to the nearest of them from both sides; a spot follows only cells whose lower bound is not
    above its least upper bound. Where a cell holds few places, they become candidates. ``spots`` has ``spot, x, y, z``,
    ``places`` ``gx, gy, gz`` and what is to be told; both should be stored tables, places without repeated coordinates.
    """
    far = F.lit(float("inf"))
    total = places.count()
    going = spots.select("*", F.lit(0).cast("long").alias("cell"), far.alias("upper"), F.lit(total).alias("n"))
    found = []
    for level in range(DEEPEST + 1):
        here = going.filter((F.col("n") <= LEAF) | (F.lit(level) == DEEPEST))
        found.append(here.join(places.withColumn("_cell", _cell(level)), F.col("cell") == F.col("_cell")).select(
            "spot", "x", "y", "z", *places.columns))
        if level == DEEPEST or total <= LEAF:
            break
        boxes = places.groupBy(_cell(level + 1).alias("below")).agg(
            F.count(F.lit(1)).alias("m"), *[f(f"g{a}").alias(f"{n}_{a}") for a in "xyz" for n, f in (("lo", F.min), ("hi", F.max))])
        boxes = materialise(boxes.withColumn("around", _parent(F.col("below"))), "boxes")
        near = _chord2(*[F.greatest(F.col(f"lo_{a}") - F.col(a), F.col(a) - F.col(f"hi_{a}"), F.lit(0.0)) for a in "xyz"])
        away = _chord2(*[F.greatest(F.col(f"hi_{a}") - F.col(a), F.col(a) - F.col(f"lo_{a}")) for a in "xyz"])
        tried = (going.filter(F.col("n") > LEAF).join(boxes, F.col("cell") == F.col("around"))
                 .withColumn("lower", near).withColumn("upper", F.least("upper", F.min(away).over(W.partitionBy("spot")))))
        going = materialise(tried.filter(F.col("lower") <= F.col("upper") + _SLACK).select(
            *spots.columns, F.col("below").alias("cell"), "upper", F.col("m").alias("n")), "cells")
        if going.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def nearest_place(points: DataFrame, gazetteer: DataFrame, *, lat: str = "lat", lon: str = "lon",
                  tie_break: str = "city") -> DataFrame:
    """Add ``city`` and ``admin1`` of the nearest gazetteer row to every point.

    Points are reduced to distinct coordinates, stored once; ``near_candidates`` finds the places to compare each with.
    Of equally near places the smallest ``tie_break`` wins. Rows without coordinates get NULLs.
    """
    with scratch(points.sparkSession) as scope:
        x, y, z = _xyz(F.col("_lat"), F.col("_lon"))
        spots = (points.select(F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon")).dropna().distinct()
                 .select(F.struct("_lat", "_lon").alias("spot"), x.alias("x"), y.alias("y"), z.alias("z")))
        gx, gy, gz = _xyz(F.col("lat"), F.col("lon"))
        told = F.min(F.struct(F.col(tie_break).alias("_tie"), "city", "admin1")).alias("told")
        places = gazetteer.dropna(subset=["lat", "lon"]).groupBy("lat", "lon").agg(told).select(
            "told", gx.alias("gx"), gy.alias("gy"), gz.alias("gz"))
        pairs = near_candidates(materialise(spots, "spots"), materialise(places, "places"))
        gap = _chord2(*[F.col(a) - F.col(f"g{a}") for a in "xyz"])
        best = pairs.groupBy("spot").agg(F.min(F.struct(gap.alias("gap"), "told")).alias("best"))
        solved = scope.result(best.select("spot._lat", "spot._lon", "best.told.city", "best.told.admin1"), "nearest")
    keyed = points.withColumns({"_lat": F.col(lat).cast("double"), "_lon": F.col(lon).cast("double")})
    return keyed.join(solved, ["_lat", "_lon"], "left").drop("_lat", "_lon")


def enrich_from_detail(postings: DataFrame, details: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Date and province of postings from their detail pages.

    ``details`` holds ``platform``, ``job_id``, ``date_texts`` and ``coordinates`` (two texts); of several for one
    posting the first counts. What a page does not give stays as it was.
    """
    keys = [k for k in ("platform", "job_id") if k in details.columns and k in postings.columns]
    located = nearest_place(
        first_detail(details, keys).select(*keys, first_slash_date(F.col("date_texts")).alias("_day"),
                       F.get("coordinates", F.lit(0)).try_cast("double").alias("_la"),
                       F.get("coordinates", F.lit(1)).try_cast("double").alias("_lo")),
        gazetteer, lat="_la", lon="_lo")
    found = located.select(*keys, "_day", F.when(F.col("admin1").isNotNull(), F.array("admin1")).alias("_place"))
    return (postings.join(found, keys, "left")
            .withColumn("created_on", F.coalesce("_day", "created_on"))
            .withColumn("location_raw", F.coalesce("_place", "location_raw"))
            .drop("_day", "_place"))
