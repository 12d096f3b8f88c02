"""Questions asked of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobstrata import config


def top_skills(job_skills: DataFrame, k: int, *, role: str = "label_name", skill: str = "skill_raw",
               job: str = "job_id") -> DataFrame:
    """The ``k`` skills asked for by most postings of each role; ties in name order."""
    demand = job_skills.groupBy(role, skill).agg(F.countDistinct(job).alias("n_jobs"))
    rank = F.row_number().over(W.partitionBy(role).orderBy(F.desc("n_jobs"), skill))
    return demand.withColumn("rank", rank).filter(F.col("rank") <= k)


def skill_demand(tables: dict[str, DataFrame], k: int = 10) -> DataFrame:
    """Most wanted skills per role."""
    jobs = tables["fact_job_postings"].select("job_id", "label_id").join(tables["label_dim"], "label_id")
    pairs = (tables["fact_skill"].join(jobs, "job_id")
             .join(tables["skill_dim"].select("skill_id", F.coalesce("skill_cleaned", "skill_raw").alias("skill")),
                   "skill_id"))
    return top_skills(pairs, k, skill="skill")


def monthly_volume(df: DataFrame, day: str) -> DataFrame:
    """Rows per month and the change against the month before.

    The window runs over one row per month, whatever the size of the table.
    """
    months = df.groupBy(F.trunc(F.col(day).cast("date"), "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("n").over(W.orderBy("month"))
    return months.withColumn("previous", before).withColumn("change", F.col("n") - F.col("previous"))


def volume_trend(tables: dict[str, DataFrame]) -> DataFrame:
    """Postings per month of publication."""
    days = tables["date_dim"].select(F.col("date_id").alias("created_on_id"), "actual_date")
    return monthly_volume(tables["fact_job_postings"].select("created_on_id").join(days, "created_on_id"),
                          "actual_date")


def most_active(df: DataFrame, who: str, k: int) -> DataFrame:
    """The ``k`` values of ``who`` with most rows; ties in value order."""
    return df.groupBy(who).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), who).limit(k)


def active_employers(tables: dict[str, DataFrame], k: int = 10) -> DataFrame:
    """Employers with most postings; counted on the id before names are looked up."""
    busiest = most_active(tables["fact_job_postings"].dropna(subset=["emp_id"]), "emp_id", k)
    names = tables["emp_dim"].select("emp_id", F.coalesce("emp_cleaned", "emp_raw").alias("employer"))
    return busiest.join(names, "emp_id").select("emp_id", "employer", "n")


def is_miss(label: str = "label_name"):
    """A posting the keyword filter let through although it turned out to be no data job."""
    return F.coalesce(F.col(label) == config.NO_LABEL, F.lit(False))


def filter_accuracy(labelled: DataFrame, label: str = "label_name") -> DataFrame:
    """How many postings that passed the keyword filter are data jobs, and their share."""
    hits = F.count_if(~is_miss(label))
    return labelled.agg(F.count(F.lit(1)).alias("n_passed"), hits.alias("n_relevant"),
                        F.round(hits / F.count(F.lit(1)), 6).alias("accuracy"))


def filter_misses(labelled: DataFrame, label: str = "label_name") -> DataFrame:
    """Postings to learn from when the keyword lists are refined."""
    return labelled.filter(is_miss(label))


def uncleaned_skills(tables: dict[str, DataFrame]) -> DataFrame:
    """Skills in use that have no cleaned name yet."""
    used = tables["fact_skill"].select("skill_id").distinct()
    return tables["skill_dim"].filter("skill_cleaned is null").join(used, "skill_id", "left_semi")
