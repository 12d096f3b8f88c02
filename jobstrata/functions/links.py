"""Links and the identifiers made from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstrata import config


def absolute_link(href: Column, domain: Column | str) -> Column:
    """``href`` itself when it starts with ``http``, else the domain put in front, no slash added."""
    domain = F.lit(domain) if isinstance(domain, str) else domain
    return F.when(href.startswith("http"), href).otherwise(F.concat(domain, href))


def card_id(link: Column) -> Column:
    """Identifier of a listing card. Cards without a link share the identifier of ``None``."""
    return F.md5(F.coalesce(link, F.lit("None")))


def url_id(url: Column) -> Column:
    """Identifier that ignores case and outer blanks of the address."""
    return F.md5(F.lower(F.trim(url)))


def rewrite_locale(link: Column, old: str = config.CAREERVIET_LOCALE[0],
                   new: str = config.CAREERVIET_LOCALE[1]) -> Column:
    """Point a link to another language version of the site; NULL stays NULL."""
    return F.replace(link, F.lit(old), F.lit(new))


def fill_template(template: str, fields: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` in a fixed text by column values."""
    out = F.lit(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out
