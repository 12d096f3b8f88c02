"""Landed HTML pages -> cards, descriptions and detail fields.

Only finding elements runs in Python, batch by batch inside the tasks; links, identifiers and
dates are column expressions on top.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata import config, schemas
from jobstrata.functions import links
from jobstrata.sources import html

CARD = "platform string, source string, page_no bigint, pos int, job_title string, emp_name string, location_name string, " \
       "href string, created_on string, job_desc string"
DETAIL = "platform string, job_id string, job_desc string, date_texts array<string>, coordinates array<string>"


_CARD_FIELDS = ("job_title", "emp_name", "location_name", "job_link", "created_on", "job_desc")


def _text(card: Mapping, name: str) -> str | None:
    return card[name].text() if name in card else None


def unknown_sites(pages: DataFrame, sites: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Pages per site that has no settings."""
    known = F.coalesce(F.col("platform").isin(list(sites)), F.lit(False))
    return pages.filter(~known).groupBy("platform").agg(F.count(F.lit(1)).alias("n_pages"))


def _settings(sites: Mapping[str, Mapping[str, str]], platform: str, on_unknown: str):
    if platform not in sites and on_unknown == "raise":
        raise ValueError(f"no settings for the pages of {platform}")
    return sites.get(platform)


def find_cards(pages: DataFrame, sites: Mapping[str, Mapping[str, str]] = config.LISTING_SITES,
               on_unknown: str = "raise") -> DataFrame:
    """One row per card of the pages ``(platform, page_no, html)``, perhaps with their ``source``; absent fields are NULL.

    A page of a site without settings raises, or on demand (``on_unknown="skip"``) gives no card; ``unknown_sites`` counts
    them.
    """
    sites = {name: dict(site) for name, site in sites.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for platform, source, page_no, page in zip(*[batch[c] for c in ("platform", "source", "page_no", "html")]):
                site = _settings(sites, platform, on_unknown)
                if site is None:
                    continue
                fields = {name: site[name] for name in _CARD_FIELDS if site.get(name)}
                dated = site.get("created_on_attr")
                for pos, (card, has) in enumerate(html.parse(page).cards(site["container"], fields)):
                    link = has["job_link"].attrs.get("href") if "job_link" in has else None
                    rows.append((platform, source, page_no, pos, _text(has, "job_title"), _text(has, "emp_name"),
                                 _text(has, "location_name"), link, card.attrs.get(dated) if dated else _text(has, "created_on"),
                                 _text(has, "job_desc")))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CARD.split(", ")])

    source = F.col("source") if "source" in pages.columns else F.lit(None).cast("string")
    return pages.select("platform", source.alias("source"), F.col("page_no").cast("bigint"), "html").mapInPandas(run, CARD)


def site_domain(platform: Column, sites: Mapping[str, Mapping[str, str]] = config.LISTING_SITES) -> Column:
    pairs = [F.lit(x) for name, site in sites.items() for x in (name, site["domain"])]
    return F.try_element_at(F.create_map(*pairs), platform)


def cards_to_postings(cards: DataFrame, sites: Mapping[str, Mapping[str, str]] = config.LISTING_SITES) -> DataFrame:
    """Cards in the raw posting layout, with full links and identifiers made from them."""
    link = links.absolute_link(F.col("href"), site_domain(F.col("platform"), sites))
    linked = (cards.withColumn("job_link", link).withColumn("job_id", links.card_id(F.col("job_link")))
              .withColumn("location_raw", F.when(F.col("location_name").isNotNull(), F.array("location_name")))
              .withColumn("skills", F.lit(None)))
    return linked.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.POSTING_RAW])


def find_details(pages: DataFrame, sites: Mapping[str, Mapping[str, str]] = config.DETAIL_SITES,
                 on_unknown: str = "raise") -> DataFrame:
    """Description, date candidates and coordinates of detail pages ``(platform, job_id, html)``; sites without settings as
    in :func:`find_cards`."""
    sites = {name: dict(site) for name, site in sites.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for platform, job_id, page in zip(batch["platform"], batch["job_id"], batch["html"]):
                site = _settings(sites, platform, on_unknown)
                if site is None:
                    continue
                root = html.parse(page)
                desc = "".join(e.text() for e in root.find_all(site["job_desc"])).strip()
                days = [e.text() for e in root.find_all(site["created_on"])] if "created_on" in site else None
                spot = ([e.attrs.get("value") for e in root.find_all(site["coordinates"])]
                        if "coordinates" in site else None)
                rows.append((platform, job_id, desc, days, spot))
            yield pd.DataFrame(rows, columns=["platform", "job_id", "job_desc", "date_texts", "coordinates"])

    return pages.select("platform", "job_id", "html").mapInPandas(run, DETAIL)


def fetched_details(fetches: DataFrame, sites: Mapping[str, Mapping[str, str]] = config.DETAIL_SITES,
                    on_unknown: str = "raise") -> DataFrame:
    """Details from fetch results ``(platform, job_id, status, html)``.

    A missing page (404) or a failed fetch (no status) gives no row, another status an empty
    description.
    """
    got = find_details(fetches.filter("status = 200"), sites, on_unknown)
    refused = fetches.filter("status not in (200, 404)").select(
        "platform", "job_id", F.lit("").alias("job_desc"),
        F.lit(None).cast("array<string>").alias("date_texts"),
        F.lit(None).cast("array<string>").alias("coordinates"))
    return got.unionByName(refused.filter(F.col("platform").isin(list(sites))))
