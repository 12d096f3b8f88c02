"""List of requests a crawler would send: keyword x site x page."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.functions.links import fill_template


def request_list(keywords: DataFrame, templates: Mapping[str, tuple], keyword: str = "keyword") -> DataFrame:
    """One row per request: site, page number, address and query fields.

    ``templates`` maps a site to its address, its query fields with ``{keyword}`` and ``{page_num}``, and its pages.

    Sites and pages are short lists kept in the plan and exploded next to each keyword, so
    nothing is joined.
    """
    sites = F.array(*[F.struct(F.lit(site).alias("platform"), F.lit(pages).alias("pages"))
                      for site, (_, _, pages) in templates.items()])
    listed = (keywords.select(F.col(keyword).alias("keyword"), F.explode(sites).alias("s"))
              .select("keyword", "s.platform", F.explode(F.sequence(F.lit(1), F.col("s.pages"))).alias("page_num")))
    fields = {"keyword": F.col("keyword"), "page_num": F.col("page_num")}
    url, query = None, None
    for site, (address, payload, _) in templates.items():
        params = F.create_map(*[x for name, value in payload.items()
                                for x in (F.lit(name), fill_template(value, fields))])
        here = F.col("platform") == site
        url = F.when(here, F.lit(address)) if url is None else url.when(here, F.lit(address))
        query = F.when(here, params) if query is None else query.when(here, params)
    return listed.select("platform", "keyword", "page_num", url.alias("url"), query.alias("params"))
