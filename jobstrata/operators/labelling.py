"""Role labels: batches, a pluggable labeller, reply checks and the final fill."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata import config
from jobstrata.functions import text
from jobstrata.operators.numbering import number_rows
from jobstrata.session import materialise

Labeller = Callable[[DataFrame], DataFrame]  # (batch_id, job_id, job_title) -> (job_id, job_label)


def chunk(df: DataFrame, order: list, size: int = config.LABEL_BATCH_SIZE, name: str = "batch_id",
          position: str = "batch_pos") -> DataFrame:
    """Cut the rows, in order, into batches of ``size``; only the last batch may be shorter."""
    at = F.col("_no")
    return (number_rows(df, order, "_no", start=0)
            .withColumn(name, F.floor(at / size).cast("bigint"))
            .withColumn(position, F.pmod(at, F.lit(size)).cast("int"))
            .drop("_no"))


def encode_batches(df: DataFrame, fields: Sequence[str] = ("job_id", "job_title"), batch: str = "batch_id",
                   position: str = "batch_pos") -> DataFrame:
    """One JSON array per batch, entries in batch order. Groups are bounded by the batch size."""
    entries = F.array_sort(F.collect_list(F.struct(position, F.struct(*fields).alias("entry"))))
    return df.groupBy(batch).agg(F.to_json(F.transform(entries, lambda x: x["entry"])).alias("request"))


def decode_reply(reply: Column, labels: Sequence[str] = config.ROLE_LABELS) -> Column:
    """``{"jobs": [{"job_id", "job_label"}]}`` as an array; NULL when broken or a label is unknown.

    Identifiers may be numbers or text; both become text.
    """
    jobs = F.from_json(reply, "jobs array<struct<job_id: string, job_label: string>>")["jobs"]
    known = F.forall(jobs, lambda x: F.coalesce(x["job_label"].isin(list(labels)) & x["job_id"].isNotNull(),
                                                F.lit(False)))
    return F.when(known, jobs)


def complete_batches(requests: DataFrame, replies: DataFrame, batch: str = "batch_id", key: str = "job_id") -> DataFrame:
    """One reply per posting of the batches in which exactly the postings asked for came back.

    A posting answered twice counts once and keeps its smallest answer; a reply without id is ignored.
    """
    rest = [c for c in replies.columns if c not in (batch, key)]
    known = replies.filter(F.col(batch).isNotNull() & F.col(key).isNotNull())
    once = (known.groupBy(batch, key).agg(F.min(F.struct(*rest)).alias("_r")).select(batch, key, "_r.*") if rest
            else known.select(batch, key).distinct())
    asked = requests.select(batch, key).distinct().withColumn("_asked", F.lit(1))
    state = asked.join(once.select(batch, key, F.lit(1).alias("_got")), [batch, key], "full").groupBy(batch).agg(
        F.count("_asked").alias("_n"), F.count("_got").alias("_m"), F.count(F.expr("_asked + _got")).alias("_both"))
    good = state.filter("_n = _both and _m = _both and _n > 0").select(batch)
    return once.join(good, batch, "left_semi")


def rule_labeller(requests: DataFrame, title: str = "job_title") -> DataFrame:
    """Default labeller: fixed rules on the title, no external service."""
    return requests.select("batch_id", "job_id", text.role_by_title(F.col(title)).alias("job_label"))


def label_with_fallbacks(requests: DataFrame, labellers: Sequence[Labeller], failed: str = config.FAILED_LABEL,
                         labels: Sequence[str] | None = None) -> DataFrame:
    """Label by the first labeller whose batch is complete; ``failed`` when none is.

    ``requests`` holds ``batch_id`` and ``job_id``; a labeller keeps both. Each labeller is sent only the batches still
    open, and its reply is stored once, so what is judged is what is used. With ``labels`` a reply with another label
    does not count.
    """
    open_rows, done = requests, []
    for labeller in labellers:
        replies = labeller(open_rows).select("batch_id", "job_id", "job_label").filter(F.col("job_label").isNotNull())
        if labels is not None:
            replies = replies.filter(F.col("job_label").isin(list(labels)))
        good = materialise(complete_batches(open_rows, materialise(replies, "reply")), "labels")
        done.append(good)
        open_rows = open_rows.join(good.select("batch_id").distinct(), "batch_id", "left_anti")
    rest = open_rows.select("batch_id", "job_id").distinct().withColumn("job_label", F.lit(failed))
    return reduce(DataFrame.unionByName, [*done, rest])


def fill_label(df: DataFrame, labels: DataFrame, *, job_id: str = "job_id", label: str = "label",
               none: str = config.NO_LABEL) -> DataFrame:
    """Label from the map if the posting is in it, else the rule label, else ``none``."""
    given = labels.groupBy(F.col("job_id").cast("string").alias("_id")).agg(F.min("job_label").alias("_given"))
    joined = df.join(given, F.col(job_id).cast("string") == F.col("_id"), "left")
    rule = F.when(F.col(label) != "", F.col(label))
    return joined.withColumn(label, F.coalesce("_given", rule, F.lit(none))).drop("_id", "_given")
