"""Parquet tables that can be re-loaded safely.

A table is a folder of generations ``g=N``, each a set of segments ``s=M``. Replacing a table
writes a new generation, adding rows a new segment. Only folders with Spark's ``_SUCCESS`` marker
count, so a run that dies half-way leaves the last good state in place and can be repeated.

Large tables that are merged into are *parted* instead: a column ``part``, made by a hash, partitions
the folder, and Spark's dynamic partition overwrite replaces the parts that a batch meets. The new parts are
written aside first; a run that dies while they are put in place is finished by the next access.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata import schemas
from jobstrata.session import remove


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _path(spark, path)
    return fs.exists(hadoop)


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    fs, hadoop = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory()]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def batches(spark: SparkSession, path: str) -> list[str]:
    """Completely written folders ``batch=n`` below a folder, in order."""
    found = [f"{path}/batch={n}" for n in _numbered(spark, path, "batch=")]
    return [p for p in found if exists(spark, f"{p}/_SUCCESS")]


class TableStore:
    """Named tables below one folder."""

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, T.StructType] = schemas.TABLES,
                 parted: Mapping[str, tuple[str, int]] = schemas.PARTED):
        self.spark, self.root, self.tables, self.parted = spark, root.rstrip("/"), dict(tables), dict(parted)

    def _segments(self, name: str) -> tuple[int, list[str]]:
        """Latest good generation and its good segments."""
        for g in reversed(_numbered(self.spark, f"{self.root}/{name}", "g=")):
            base = f"{self.root}/{name}/g={g}"
            good = [f"{base}/s={s}" for s in _numbered(self.spark, base, "s=")
                    if exists(self.spark, f"{base}/s={s}/_SUCCESS")]
            if good:
                return g, good
        return -1, []

    def read(self, name: str) -> DataFrame:
        """Current rows; an empty table when nothing was loaded yet."""
        schema = self.tables[name]
        if name in self.parted:
            return self._parts(name).drop("part")
        _, paths = self._segments(name)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # -- parted tables

    def part_of(self, name: str) -> Column:
        column, n = self.parted[name]
        return F.pmod(F.xxhash64(F.col(column)), F.lit(n)).cast("int")

    def _parts(self, name: str) -> DataFrame:
        self._put_in_place(name)
        schema = T.StructType([*self.tables[name].fields, T.StructField("part", T.IntegerType())])
        if not exists(self.spark, f"{self.root}/{name}/rows"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/rows")

    def read_met(self, name: str, batch: DataFrame) -> DataFrame:
        """Rows of the parts that the keys of a batch fall into; the other parts are not read. The list of parts is at most as
        long as their fixed number."""
        met = [r[0] for r in batch.select(self.part_of(name)).distinct().collect()]
        return self._parts(name).filter(F.col("part").isin(met)).drop("part")

    def replace_parts(self, name: str, df: DataFrame) -> None:
        """Replace the parts that occur in ``df`` by its rows."""
        aside = f"{self.root}/{name}/aside"
        rows = df.select(*self.tables[name].names).withColumn("part", self.part_of(name))
        # whole parts together, large ones split to the advised size
        rows.hint("rebalance", "part").write.mode("overwrite").parquet(aside)
        self._put_in_place(name)

    def _put_in_place(self, name: str) -> None:
        aside = f"{self.root}/{name}/aside"
        if exists(self.spark, f"{aside}/_SUCCESS"):
            schema = T.StructType([*self.tables[name].fields, T.StructField("part", T.IntegerType())])
            (self.spark.read.schema(schema).parquet(aside).hint("rebalance", "part").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.root}/{name}/rows"))
            remove(self.spark, aside)

    # -- tables of generations

    def clean(self, name: str) -> None:
        """Remove generations older than the last good one, and unfinished ones. Nobody may be reading them."""
        last, _ = self._segments(name)
        for g in _numbered(self.spark, f"{self.root}/{name}", "g="):
            if last >= 0 and g != last:
                remove(self.spark, f"{self.root}/{name}/g={g}")

    def replace(self, name: str, df: DataFrame) -> None:
        if name in self.parted:
            gone = {r.part for r in self._parts(name).select("part").distinct().collect()} - {
                r[0] for r in df.select(self.part_of(name)).distinct().collect()}
            self.replace_parts(name, df)
            for part in gone:
                remove(self.spark, f"{self.root}/{name}/rows/part={part}")
            return
        used = _numbered(self.spark, f"{self.root}/{name}", "g=")
        df.select(*self.tables[name].names).write.mode("overwrite").parquet(
            f"{self.root}/{name}/g={(used[-1] + 1) if used else 0}/s=0")

    def append(self, name: str, df: DataFrame) -> None:
        if name in self.parted:
            return self.replace_parts(name, self.read_met(name, df).unionByName(df.select(*self.tables[name].names)))
        g, _ = self._segments(name)
        if g < 0:
            return self.replace(name, df)
        used = _numbered(self.spark, f"{self.root}/{name}/g={g}", "s=")
        df.select(*self.tables[name].names).write.mode("overwrite").parquet(
            f"{self.root}/{name}/g={g}/s={used[-1] + 1}")

    def compact(self, name: str) -> None:
        """Rewrite a table of many small segments as one."""
        self.replace(name, self.read(name))

    def known_ids(self, name: str = "fact_job_postings", column: str = "job_id") -> DataFrame:
        """Distinct identifiers already loaded; empty when the table does not exist."""
        return self.read(name).select(column).distinct()
