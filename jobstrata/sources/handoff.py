"""The two tables handed from the collecting to the loading stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from jobstrata import schemas
from jobstrata.sources.tables import exists


def write(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Typed parquet by default; ``csv`` with a header for spreadsheets."""
    writer = df.write.mode("overwrite")
    (writer.option("header", True).option("escape", '"').csv(path) if fmt == "csv" else writer.parquet(path))


def read(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return (spark.read.schema(schema).option("header", True).option("multiLine", True)
                .option("escape", '"').csv(path))
    return spark.read.schema(schema).parquet(path)


def read_pair(spark: SparkSession, master_path: str, skills_path: str, *,
              master_schema: T.StructType = schemas.MASTER, skills_schema: T.StructType = schemas.JOB_SKILL,
              fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Both tables; without skills an empty skill table, without postings two empty tables."""
    empty_skills = spark.createDataFrame([], skills_schema)
    if not exists(spark, master_path):
        return spark.createDataFrame([], master_schema), empty_skills
    master = read(spark, master_path, master_schema, fmt)
    if not exists(spark, skills_path):
        return master, empty_skills
    return master, read(spark, skills_path, skills_schema, fmt)
