"""URL filters by a temporal list join.

A list changes over time: ``pattern, changed_on, listed, category`` says that a pattern is put on the list or taken off
it. A pattern is a host (which also covers its subdomains) or a host with the first path segment, such as
``example.com/en``. The changes of a pattern become validity intervals ``[since, until)``; every capture offers the few
patterns that could cover it and meets, as of its fetch day, the interval in force. Intervals are spread over the months
they touch, so a pattern with a long history is met only by the intervals of the capture's month.

Both sides are joined on pattern and month; a hot host is split by adaptive execution, and the list is broadcast only
where its measured size allows it.

Defined results: of several changes of a pattern on one day putting it on the list wins; NULL patterns or days of a
change are ignored; a capture without host or day is never blocked; of several entries in force the longest pattern is
reported, then the first; equal captures get equal verdicts; an empty list blocks nothing; further columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)"
FOREVER = "9999-12-31"


def host(url: Column) -> Column:
    """Lower-case host without user, port and final dot; NULL if there is none."""
    return F.nullif(F.rtrim(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(".")), F.lit(""))


def patterns(url: Column) -> Column:
    """Every pattern that covers the URL: the host and its parent domains, each alone and with the first segment."""
    labels = F.split(host(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(
        F.slice(labels, k, F.size(labels)), "."))
    segment = F.regexp_extract(url, _SEGMENT, 1)
    return F.when(segment == "", domains).otherwise(
        F.concat(domains, F.transform(domains, lambda d: F.concat(d, F.lit("/"), segment))))


def intervals(changes: DataFrame) -> DataFrame:
    """``pattern, category, since, until`` of the times a pattern is on the list."""
    known = changes.where(F.col("pattern").isNotNull() & F.col("changed_on").isNotNull() & F.col("listed").isNotNull())
    daily = known.groupBy("pattern", "changed_on").agg(
        F.max("listed").alias("listed"), F.min(F.when(F.col("listed"), F.col("category"))).alias("category"))
    ends = F.lead("changed_on").over(W.partitionBy("pattern").orderBy("changed_on"))
    return daily.withColumn("until", F.coalesce(ends, F.lit(FOREVER).cast("date"))).where("listed").select(
        "pattern", "category", F.col("changed_on").alias("since"), "until")


def in_force(captures: DataFrame, changes: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """``url, day, pattern, category`` of every entry in force for a distinct URL and day."""
    asked = captures.select(F.col(url).alias("url"), F.col(day).cast("date").alias("day")).where(
        "url is not null and day is not null").distinct()
    span = asked.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    offered = asked.select("url", "day", F.explode(patterns(F.col("url"))).alias("pattern"),
                           F.trunc("day", "month").alias("month"))
    valid = intervals(changes)
    if span["lo"] is not None:  # months outside the captures' need no rows
        first = F.trunc(F.greatest("since", F.lit(span["lo"])), "month")
        last = F.least(F.date_sub("until", 1), F.lit(span["hi"]))
        valid = valid.where((F.col("since") <= F.lit(span["hi"])) & (F.col("until") > F.lit(span["lo"])))
        valid = valid.withColumn("month", F.explode(F.sequence(first, F.trunc(last, "month"), F.expr("interval 1 month"))))
    else:
        valid = valid.withColumn("month", F.col("since"))
    return offered.join(valid, ["pattern", "month"]).where("since <= day and day < until").select(
        "url", "day", "pattern", "category")


def judge(captures: DataFrame, changes: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """Add ``blocked, n_entries, pattern, category``."""
    own = [c for c in captures.columns if c not in ("blocked", "n_entries", "pattern", "category")]
    best = F.min(F.struct((-F.length("pattern")).alias("k"), F.col("pattern").alias("p"), F.col("category").alias("c")))
    found = in_force(captures, changes, url, day).groupBy("url", "day").agg(
        F.count(F.lit(1)).alias("n"), best.alias("best")).select(
        F.col("url").alias("_url"), F.col("day").alias("_day"), "n", "best")
    return captures.join(found, (F.col(f"`{url}`") == F.col("_url")) & (F.col(f"`{day}`").cast("date") == F.col("_day")),
                         "left").select(
        *[F.col(f"`{c}`") for c in own], F.col("n").isNotNull().alias("blocked"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_entries"), F.col("best.p").alias("pattern"),
        F.col("best.c").alias("category"))


def keep(captures: DataFrame, changes: DataFrame, url: str = "url", day: str = "fetched_on") -> DataFrame:
    """The captures no entry blocks."""
    found = in_force(captures, changes, url, day).select(F.col("url").alias("_url"), F.col("day").alias("_day")).distinct()
    return captures.join(found, (F.col(f"`{url}`") == F.col("_url")) & (F.col(f"`{day}`").cast("date") == F.col("_day")),
                         "left_anti")
