"""Collecting stage: raw postings of all sites -> postings master and skill table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata import config
from jobstrata.functions import text
from jobstrata.operators import dedupe, geo, labelling, relevance, unify
from jobstrata.operators.numbering import number_rows
from jobstrata.session import materialise


class Collected(NamedTuple):
    master: DataFrame  # seq, job_id, job_title, date_view, emp_raw, location_name, label_name, job_link
    skills: DataFrame  # job_id, skill_raw


def platform_rank(platform: Column, order: Sequence[str] = config.PLATFORM_ORDER) -> Column:
    """Position of a site in the master table; unknown sites come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in order]), platform), F.lit(0)),
                      F.lit(len(order) + 1)).cast("int")


@dataclass(frozen=True)
class Dictionaries:
    """Word lists of a run."""

    must_have: Sequence[str] = tuple(config.MUST_HAVE_WORDS)
    positive: Sequence[str] = tuple(config.POSITIVE_WORDS)
    negative: Sequence[str] = tuple(config.NEGATIVE_WORDS)
    title_rules: Mapping[str, str] = field(default_factory=lambda: dict(config.TITLE_RULES))
    terms: Sequence[str] = tuple(config.SKILLS)


ARRIVAL = ["page_no", "pos", "source"]  # the order in which the postings of a site were seen


def candidates(raw: DataFrame, words: Dictionaries = Dictionaries()) -> DataFrame:
    """Relevant postings, first seen per site, with the rule label (NULL when no rule fits).

    Pages of several requests repeat their numbers. What page, position and source leave open is decided by a hash of the
    whole posting, so the result does not depend on how the rows lie in partitions.
    """
    relevant = relevance.keep_relevant(raw, must_have=words.must_have, positive=words.positive,
                                       negative=words.negative)
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns])
    kept = dedupe.first_seen(relevant.withColumn("_whole", whole), ["platform", "job_id"], [*ARRIVAL, "_whole"], id_column="job_id")
    return kept.drop("_whole").withColumn("label", text.rule_label(F.col("job_title"), words.title_rules))


def with_descriptions(postings: DataFrame, details: DataFrame, terms: Sequence[str] = config.SKILLS) -> DataFrame:
    """Skills from the description where the site itself lists none."""
    found = unify.first_detail(details).select(
        "platform", "job_id", text.extract_terms(F.col("job_desc"), terms).alias("_found"))
    return (postings.join(found, ["platform", "job_id"], "left")
            .withColumn("skills", F.coalesce("skills", "_found")).drop("_found"))


def collect(raw: DataFrame, loaded: DataFrame, *, details: DataFrame | None = None, gazetteer: DataFrame | None = None,
            words: Dictionaries = Dictionaries(),
            labellers: Sequence[labelling.Labeller] = (labelling.rule_labeller,)) -> Collected:
    """Run the stage. ``raw`` has the raw posting layout, ``loaded`` the known ``job_id`` s.

    ``details`` gives descriptions (for skills) and, where there is a ``gazetteer``, dates and provinces of postings whose
    listing says neither. Cheap steps come first (keywords, first-seen, rule label, known ids), so that only the rest
    goes to the labeller.
    """
    found = candidates(raw, words)
    if details is not None:
        found = with_descriptions(found, details, words.terms)
        if gazetteer is not None:
            found = geo.enrich_from_detail(found, details, gazetteer)
    found = materialise(found, "postings")
    skills = unify.explode_skills(found)

    ranked = found.withColumn("_rank", platform_rank(F.col("platform")))
    order = ["_rank", "platform", *ARRIVAL, "job_id"]  # total: a site has an id once
    open_rows = dedupe.first_seen(dedupe.needs_label(ranked, loaded), ["job_id"], order)
    requests = labelling.chunk(open_rows.select(*dict.fromkeys([*order, "job_title"])), order)
    labels = labelling.label_with_fallbacks(requests.select("batch_id", "job_id", "job_title"), labellers)

    named = labelling.fill_label(ranked, labels).select(
        *order, "job_title", F.col("created_on").alias("date_view"), F.col("emp_name").alias("emp_raw"),
        text.join_places(F.col("location_raw")).alias("location_name"), F.col("label").alias("label_name"), "job_link")
    master = number_rows(named, order, "seq", start=0).select(
        "seq", "job_id", "job_title", "date_view", "emp_raw", "location_name", "label_name", "job_link")
    return Collected(master, skills)
