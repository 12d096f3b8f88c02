"""Surrogate keys for postings and skills.

No join here carries a broadcast hint: Spark broadcasts a dimension when its measured size is
under the session threshold and otherwise shuffles, splitting skewed keys (adaptive skew join).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata import config


def attach_key(df: DataFrame, dim: DataFrame, *, value: str, dim_value: str, surrogate: str,
               name: str | None = None, how: str = "left") -> DataFrame:
    """Add the surrogate id of ``value``; a NULL value matches nothing, a repeated one in the dimension raises.

    One aggregate over the dimension both checks that values are unique and feeds the join, so it is read once.
    """
    name = name or surrogate
    twice = F.raise_error(F.concat(F.lit(f"dimension of {value}: key "), F.col(dim_value).cast("string"), F.lit(" occurs more than once")))
    side = (dim.filter(F.col(dim_value).isNotNull()).groupBy(dim_value).agg(F.min(surrogate).alias("_id"), F.count(F.lit(1)).alias("_n"))
            .select(F.col(dim_value).alias("_value"), F.when(F.col("_n") > 1, twice).otherwise(F.col("_id")).alias(name)))
    return df.join(side, F.col(value) == F.col("_value"), how).drop("_value")


def keyed_postings(postings: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Postings with the ids of their dates, employer, place and label, NULL where a dimension has none.

    A posting whose last-seen date is missing from the date dimension is left out.
    """
    out = attach_key(postings, dims["date_dim"], value="date_view", dim_value="actual_date",
                     surrogate="date_id", name="created_on_id")
    out = attach_key(out, dims["emp_dim"], value="emp_raw", dim_value="emp_raw", surrogate="emp_id")
    out = attach_key(out, dims["location_dim"], value="location_name", dim_value="location_name",
                     surrogate="location_id")
    out = attach_key(out, dims["label_dim"], value="label_name", dim_value="label_name", surrogate="label_id")
    return attach_key(out, dims["date_dim"], value="last_seen", dim_value="actual_date",
                      surrogate="date_id", name="last_seen_id", how="inner")


def fact_rows(keyed: DataFrame, default_label: int = config.DEFAULT_LABEL_KEY) -> DataFrame:
    """Fact rows of postings with their ids; one without a known label gets ``default_label``."""
    return keyed.select("job_id", "job_title", "is_expired", "job_link", "last_seen_id", "location_id",
                        default_key("label_id", default_label).alias("label_id"), "emp_id", "created_on_id")


def posting_keys(postings: DataFrame, dims: Mapping[str, DataFrame],
                 default_label: int = config.DEFAULT_LABEL_KEY) -> DataFrame:
    """Fact rows: dates, employer, place and label replaced by their ids."""
    return fact_rows(keyed_postings(postings, dims), default_label)


def default_key(column: str, default: int):
    """The id as a whole number, ``default`` when it is missing."""
    return F.coalesce(F.col(column), F.lit(default)).cast("bigint")


def skill_keys(skills: DataFrame, skill_dim: DataFrame) -> DataFrame:
    """``(skill_id, job_id)``; ids that could not be found stay NULL."""
    return attach_key(skills, skill_dim, value="skill_raw", dim_value="skill_raw",
                      surrogate="skill_id").select("skill_id", "job_id")
