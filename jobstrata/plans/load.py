"""Loading stage: postings master and skills -> star schema."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata import config
from jobstrata.functions import dates, links, text
from jobstrata.operators import dedupe, lookups, metrics, neardup, unify, upserts
from jobstrata.schemas import DIMENSIONS
from jobstrata.session import materialise, scratch
from jobstrata.sources.tables import TableStore

DIM_SOURCES = {"location_dim": ["location_name"], "date_dim": ["date_view", "last_seen"],
               "label_dim": ["label_name"], "emp_dim": ["emp_raw"]}


class Prepared(NamedTuple):
    postings: DataFrame
    skills: DataFrame


def prepare(master: DataFrame, skills: DataFrame, *, run_ts: str,
            threshold: float = config.NEAR_DUP_THRESHOLD, places: Sequence[str] = config.PROVINCES) -> Prepared:
    """Near-duplicates out, dates and places normalised, skills of the survivors kept.

    ``master`` has a unique ``seq`` giving the order. Texts that stand for a missing value become
    NULL, as they would in a file hand-off. The clock is ``run_ts`` (UTC).
    """
    now = F.lit(run_ts).cast("timestamp")
    texts = ["job_title", "date_view", "emp_raw", "location_name", "label_name", "job_link"]
    clean = master.withColumns({c: text.missing_to_null(F.col(c)) for c in texts})
    clean = materialise(
        clean.withColumn("_compare", text.compare_key(F.col("job_title"), F.col("emp_raw"))), "master")
    unique = neardup.drop_near_duplicates(clean, row="seq", text="_compare", threshold=threshold).drop("_compare")
    postings = (unique
                .withColumn("date_view", dates.local_date(dates.posting_timestamp_or_default(
                    F.col("date_view"), F.col("job_link"), now)))
                .withColumn("location_name", text.normalise_location(F.col("location_name"), places))
                .withColumn("job_link", links.rewrite_locale(F.col("job_link")))
                .dropna(subset=["job_link"]))
    postings = materialise(dedupe.first_seen(seen_now(postings, run_ts), ["job_id"], ["seq"]), "unique")
    trimmed = skills.select("job_id", text.strip(F.col("skill_raw")).alias("skill_raw"))
    return Prepared(postings, dedupe.only_in(trimmed, postings, "job_id"))


def seen_now(postings: DataFrame, run_ts: str) -> DataFrame:
    """The constant columns of a run: last seen today, not expired."""
    return postings.withColumns({"last_seen": F.lit(run_ts).cast("timestamp").cast("date"), "is_expired": F.lit(False)})


def seed_labels(store: TableStore, default_label: int = config.DEFAULT_LABEL_KEY) -> None:
    """Put the label for "no data job" at its fixed id, so that later ids start above it."""
    labels = store.read("label_dim")
    if labels.filter(F.col("label_id") == default_label).isEmpty():
        store.append("label_dim", labels.sparkSession.createDataFrame(
            [(default_label, config.NO_LABEL)], DIMENSIONS["label_dim"][2]))


def load_dimensions(store: TableStore, postings: DataFrame, skills: DataFrame) -> None:
    """Insert unseen dimension values."""
    sources = {name: unify.distinct_values(postings, columns, DIMENSIONS[name][1])
               for name, columns in DIM_SOURCES.items()}
    sources["skill_dim"] = unify.distinct_values(skills, ["skill_raw"])
    for name, values in sources.items():
        surrogate, key, _ = DIMENSIONS[name]
        added = upserts.new_members(store.read(name), values, key=key, surrogate=surrogate)
        if not added.isEmpty():
            store.append(name, added)


class Loaded(NamedTuple):
    """What a load met before it repaired or dropped anything; counted while the rows were written."""

    facts: int            # postings of the batch
    null_labels: int      # of these, without a known label: they get the default label
    null_employers: int
    null_places: int
    null_days: int
    skills: int           # skills of new postings
    null_skills: int      # of these, unknown to the dimension: dropped


def load(store: TableStore, prepared: Prepared, *, run_ts: str, max_age_days: int = config.MAX_AGE_DAYS,
         default_label: int = config.DEFAULT_LABEL_KEY) -> Loaded:
    """Dimensions first, then the skill bridge and the facts. Repeating a run changes nothing.

    Of the facts only the parts that the batch meets are read, and those in which it changes something rewritten. Whether a posting has expired is not stored
    for old rows; :func:`current_facts` derives it. Old generations and scratch tables are gone when a load has ended.
    """
    spark = prepared.postings.sparkSession
    run_date = F.lit(run_ts).cast("timestamp").cast("date")
    with scratch(spark):
        seed_labels(store, default_label)
        load_dimensions(store, prepared.postings, prepared.skills)
        dims = {name: store.read(name) for name in ("location_dim", "date_dim", "label_dim", "emp_dim", "skill_dim")}

        recent = prepared.postings.filter(dates.is_recent(F.col("date_view"), run_date, max_age_days))
        keyed, seen_facts = metrics.observed(lookups.keyed_postings(recent, dims), "facts", {
            "null_labels": "label_id", "null_employers": "emp_id", "null_places": "location_id", "null_days": "created_on_id"})
        batch = materialise(lookups.fact_rows(keyed, default_label), "facts")
        met = store.read_met("fact_job_postings", batch)
        fresh_skills = dedupe.not_in(dedupe.only_in(prepared.skills, recent, "job_id"), met, "job_id")
        keyed, seen_skills = metrics.observed(lookups.skill_keys(fresh_skills, dims["skill_dim"]), "skills", {"null_skills": "skill_id"})
        bridge_batch = materialise(keyed.dropna(subset=["skill_id"]), "bridge_batch")
        bridge = materialise(upserts.new_bridge_rows(store.read("fact_skill"), bridge_batch), "bridge")

        # the bridge goes first: if the run dies in between, the repeat still finds the jobs unloaded
        if not bridge.isEmpty():
            store.append("fact_skill", bridge)
        changed = materialise(upserts.changes(met, batch), "changes")
        if not changed.isEmpty():
            store.replace_parts("fact_job_postings", upserts.merge_facts(store.read_met("fact_job_postings", changed), changed))
        for name in (*DIMENSIONS, "fact_skill"):
            store.clean(name)
    facts, skills = seen_facts.get, seen_skills.get
    return Loaded(facts["rows"], *[facts[c] for c in Loaded._fields[1:5]], skills["rows"], skills["null_skills"])


def current_facts(store: TableStore, run_date: str) -> DataFrame:
    """All facts with ``is_expired`` as of a day: last seen before it."""
    return upserts.mark_expired(store.read("fact_job_postings"), store.read("date_dim"), run_date)
