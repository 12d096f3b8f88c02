import os

import pytest
from pyspark.sql import functions as F

from jobstrata.session import materialise, prepare, scratch


def _path(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_scope_removes_its_tables_and_keeps_its_result(spark):
    with scratch(spark) as outer:
        with scratch(spark) as inner:
            inside = _path(materialise(spark.range(5), "inside"))
            kept = inner.result(spark.range(7), "kept")
        assert not os.path.exists(inside) and kept.count() == 7
        final = outer.result(kept.where("id > 2"), "final")
        middle = _path(kept)
    assert not os.path.exists(middle) and final.count() == 4


def test_scope_ends_with_an_error(spark):
    seen = []
    with pytest.raises(RuntimeError), scratch(spark):
        seen.append(_path(materialise(spark.range(5), "inside")))
        raise RuntimeError
    assert not os.path.exists(seen[0])
    assert os.path.exists(_path(materialise(spark.range(2), "outside")))


def test_merged_partitions_stay_small(spark):
    """40 MB of a shuffle make several tasks, however few cores there are, so that a task holds little while it sorts."""
    other = prepare(spark.newSession())
    other.conf.set("spark.sql.shuffle.partitions", "64")
    other.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    rows = other.range(2_500_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b")).distinct()
    assert 3 <= rows.select(F.spark_partition_id().alias("p")).distinct().count()
