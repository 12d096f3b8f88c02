"""Scheduled runs: process what has landed since the last one, then stop.

A run is a finite batch repeated by a scheduler. Structured Streaming with the
available-now trigger keeps the list of files already taken. Four kinds of landed files feed one run: API responses as JSON
lines, whole response bodies in files of their own, listing pages and detail pages. Micro-batches only put aside what they
read; then one collect and one load run over what all kinds and sites brought, so that copies of a posting on two sites meet
and a posting finds its detail page. Loading is keyed, so a batch repeated after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata import schemas
from jobstrata.plans import collect, load
from jobstrata.session import scratch
from jobstrata.sources import pages, payloads
from jobstrata.sources.tables import TableStore, batches


@dataclass(frozen=True)
class Landed:
    """Folders of what was fetched. Pages and detail fetches are JSON lines (``schemas.LISTING_PAGE``, ``DETAIL_FETCH``)."""

    lines: Mapping[str, str] = field(default_factory=dict)   # site -> responses, one JSON object per line
    bodies: Mapping[str, str] = field(default_factory=dict)  # site -> responses, one file each, in any formatting
    listings: str | None = None
    details: str | None = None


class Ran(NamedTuple):
    batches: int                # micro-batches that were loaded
    loaded: load.Loaded | None  # None if they brought no posting


def _responses(spark: SparkSession, folder: str, whole: bool) -> DataFrame:
    return (spark.readStream.format("text").option("wholetext", whole).load(folder)
            .select(F.get_json_object("value", "$.page_no").try_cast("bigint").alias("page_no"),
                    F.col("_metadata.file_path").alias("source"), F.col("value").alias("body")))


def _steps(spark: SparkSession, landed: Landed, run_ts: str, on_broken: str,
           on_unknown: str) -> Iterator[tuple[str, DataFrame, Callable[[DataFrame], DataFrame]]]:
    """Name, stream and what is put aside of every folder."""
    now = F.lit(run_ts).cast("timestamp")
    for kind, folders in (("lines", landed.lines), ("bodies", landed.bodies)):
        for site, folder in folders.items():
            yield (f"{kind}/{site}", _responses(spark, folder, kind == "bodies"), lambda batch, site=site: payloads.flatten(
                payloads.parse_responses(batch, site, on_broken=on_broken), site, now))
    read = spark.readStream.option("mode", "FAILFAST" if on_broken == "raise" else "DROPMALFORMED")
    if landed.listings:
        listings = read.schema(schemas.LISTING_PAGE).json(landed.listings)
        yield ("listings", listings.withColumn("source", F.coalesce("source", F.col("_metadata.file_path"))),
               lambda batch: pages.cards_to_postings(pages.find_cards(batch, on_unknown=on_unknown)))
    if landed.details:
        yield ("details", read.schema(schemas.DETAIL_FETCH).json(landed.details),
               lambda batch: pages.fetched_details(batch, on_unknown=on_unknown))


def run_landed(spark: SparkSession, landed: Landed, store: TableStore, progress: str, *, run_ts: str,
               gazetteer: DataFrame | None = None, details: DataFrame | None = None, on_broken: str = "raise",
               on_unknown: str = "raise", words: collect.Dictionaries = collect.Dictionaries()) -> Ran:
    """Load everything new in one go; a run that broke off is made up for by the next.

    Batches count as loaded only when the load has ended. Details that landed in earlier runs are kept and found again, so a
    page may land before the posting it belongs to. ``details`` adds a table of details made elsewhere.
    """
    base = progress.rstrip("/")
    names = []
    for name, stream, read in _steps(spark, landed, run_ts, on_broken, on_unknown):
        names.append(name)

        def put_aside(batch: DataFrame, batch_id: int, name: str = name, read: Callable = read) -> None:
            read(batch).write.mode("overwrite").parquet(f"{base}/waiting/{name}/batch={batch_id}")

        query = (stream.writeStream.foreachBatch(put_aside).trigger(availableNow=True)
                 .option("checkpointLocation", f"{base}/taken/{name}").start())
        query.awaitTermination()
    marks = TableStore(spark, f"{base}/loaded", {"batches": T.StructType([T.StructField("path", T.StringType())])}, {})
    before = {r["path"] for r in marks.read("batches").collect()}  # a row per micro-batch
    found = {name: batches(spark, f"{base}/waiting/{name}") for name in names}
    new = [p for name, paths in found.items() for p in paths if p not in before and name != "details"]
    fetched = found.get("details", [])
    if not new:
        return Ran(0, None)
    with scratch(spark):
        if fetched:
            own = spark.read.schema(pages.DETAIL).parquet(*fetched)
            details = own if details is None else own.unionByName(details, allowMissingColumns=True)
        done = collect.collect(spark.read.schema(schemas.POSTING_RAW).parquet(*new), store.known_ids(), details=details,
                               gazetteer=gazetteer, words=words)
        counts = None
        if not done.master.isEmpty():
            counts = load.load(store, load.prepare(done.master, done.skills, run_ts=run_ts), run_ts=run_ts)
    marks.append("batches", spark.createDataFrame([(p,) for p in new], "path string"))
    return Ran(len(new), counts)


def load_new_payloads(spark: SparkSession, landed: dict[str, str], store: TableStore, progress: str, *, run_ts: str,
                      details: DataFrame | None = None, on_broken: str = "raise") -> Ran:
    """Load new response files (JSON lines) of the given sites (name -> folder of landed responses)."""
    return run_landed(spark, Landed(lines=landed), store, progress, run_ts=run_ts, details=details, on_broken=on_broken)
