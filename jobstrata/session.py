"""Session settings and durable intermediate results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # what a task holds while it sorts or counts grows with its share of a shuffle, to some thirty times as much for rows of
    # two numbers; merged partitions stay this small, so more input makes more tasks, not larger ones
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # whole pages and long vectors pass through Python; bound what one Arrow batch may hold
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # the shuffle files of a query go when it ends, not when the driver happens to collect garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(app_name: str = "jobstrata", master: str | None = None, **conf: str) -> SparkSession:
    """Start a session with UTC timestamps and adaptive execution."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this package relies on to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A session that names none uses a folder in its warehouse, which executors share as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts lineage like a checkpoint does, survives executor loss, and unlike a checkpoint keeps a
    columnar layout with exact file sizes, so later joins choose their strategy from real sizes.
    Inside a ``scratch`` scope the folder lives as long as the scope.
    """
    path = new_path(df.sparkSession, name)
    scope = _SCOPE.get()
    if scope is not None:
        scope.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder through Hadoop's file system, wherever it lies; False if it was not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """The intermediate tables of one scope, and the scope around it."""

    def __init__(self, outer: Scratch | None):
        self.outer, self.paths = outer, []

    def result(self, df: DataFrame, name: str = "result") -> DataFrame:
        """Store what leaves the scope; it belongs to the scope around this one, if there is one."""
        token = _SCOPE.set(self.outer)
        try:
            return materialise(df, name)
        finally:
            _SCOPE.reset(token)


_SCOPE: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A scope whose stored intermediate tables are deleted when it ends, also by an error.

    Frames made inside read those tables, so only what ``result`` stored may be used afterwards.
    """
    scope = Scratch(_SCOPE.get())
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        for path in scope.paths:
            remove(spark, path)
