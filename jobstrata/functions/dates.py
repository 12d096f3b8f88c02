"""Dates in the many forms sites publish them. The clock is always an argument."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstrata import config

# text shape -> pattern, for texts without a zone; tried only when the shape fits, so that no
# row pays for failed parses
YEAR_FIRST = [
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{2}:\d{2}$", "yyyy-M-d HH:mm"),
    (r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{2}:\d{2}:\d{2}$", "yyyy-M-d HH:mm:ss"),
    (r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{2}:\d{2}:\d{2}\.\d{1,6}$", "yyyy-M-d HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{2}:\d{2}:\d{2}$", "yyyy/M/d HH:mm:ss"),
]
DAY_FIRST = [
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{2}:\d{2}$", "d/M/yyyy HH:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{2}:\d{2}:\d{2}$", "d/M/yyyy HH:mm:ss"),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{2}:\d{2}:\d{2}$", "d-M-yyyy HH:mm:ss"),
]
ZONED = [
    (r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})$", "yyyy-MM-dd HH:mm:ssXXX"),
    (r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}[+-]\d{4}$", "yyyy-MM-dd HH:mm:ssXX"),
    (r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}\.\d{3}(Z|[+-]\d{2}:\d{2})$", "yyyy-MM-dd HH:mm:ss.SSSXXX"),
    (r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}\.\d{3}[+-]\d{4}$", "yyyy-MM-dd HH:mm:ss.SSSXX"),
    (r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}\.\d{6}(Z|[+-]\d{2}:\d{2})$", "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"),
]
# English and Vietnamese unit words
UNITS = {
    "second": "second|giây", "minute": "minute|phút", "hour": "hour|giờ", "day": "day|ngày",
    "week": "week|tuần", "month": "month|tháng", "year": "year|năm",
}
# largest amount of each unit that is believed, about 200 years; more cannot be an age and would overflow
MOST = {"second": 2_000_000_000, "minute": 100_000_000, "hour": 1_750_000, "day": 73_000, "week": 10_400,
        "month": 2_400, "year": 200}


def _by_shape(text: Column, table: Iterable[tuple[str, str]]) -> Column:
    spaced = F.regexp_replace(text, r"(?<=\d)T(?=\d)", " ")
    out = None
    for shape, fmt in table:
        value = F.try_to_timestamp(spaced, F.lit(fmt))
        out = F.when(text.rlike(shape), value) if out is None else out.when(text.rlike(shape), value)
    return out


def epoch_timestamp(number: Column) -> Column:
    """Instant of an epoch value: milliseconds when it has 13 digits, seconds otherwise."""
    seconds = number.try_cast("double")
    is_milli = F.length(F.regexp_extract(number.cast("string"), r"^-?\d+", 0)) == 13
    return F.timestamp_micros(F.round(F.when(is_milli, seconds * 1e3).otherwise(seconds * 1e6)).try_cast("bigint"))


def relative_timestamp(text: Column, run_ts: Column, zone: str = config.LOCAL_ZONE) -> Column:
    """``3 days ago`` / ``3 ngày trước`` counted back from ``run_ts`` in local time; else NULL."""
    now = F.from_utc_timestamp(run_ts, zone)
    low = F.lower(text)
    said = F.regexp_extract(low, r"(\d+)", 1).try_cast("int")
    out = F.when(low.rlike(r"yesterday|hôm qua"), now - F.expr("interval 1 day"))
    out = out.when(low.rlike(r"just now|today|vừa xong|hôm nay"), now)
    for unit, words in UNITS.items():
        amount = F.when(said <= MOST[unit], said)
        if unit in ("second", "minute", "hour"):
            step = {"second": (0, 0, amount), "minute": (0, amount, 0), "hour": (amount, 0, 0)}[unit]
            back = now - F.make_dt_interval(F.lit(0), *[x if isinstance(x, Column) else F.lit(x) for x in step])
        elif unit in ("day", "week"):
            back = now - F.make_dt_interval(amount * (7 if unit == "week" else 1))
        else:
            back = now - F.make_ym_interval(F.lit(0), amount * (12 if unit == "year" else 1))
        out = out.when(low.rlike(rf"\d\s*(?:{words})"), back)
    return F.to_utc_timestamp(out, zone)


def posting_timestamp(value: Column, link: Column, run_ts: Column, *,
                      day_first_sites: Iterable[str] = config.DAY_FIRST_SITES,
                      zone: str = config.LOCAL_ZONE) -> Column:
    """UTC instant of a published date in any supported form; NULL when it cannot be read.

    Epoch numbers have 10 digits (seconds, perhaps with a fraction) or 13 (milliseconds), 8 digits are a date; other
    numbers, negative ones among them, are no date. Texts without a zone are local time. Links of
    day-first sites decide how a short numeric date is read.
    """
    text = F.trim(value)
    day_first = F.coalesce(reduce(or_, [F.lower(link).contains(site) for site in day_first_sites], F.lit(False)),
                           F.lit(False))
    year_first_local = _by_shape(text, YEAR_FIRST)
    day_first_local = _by_shape(text, DAY_FIRST)
    local = F.when(day_first, F.coalesce(day_first_local, year_first_local)).otherwise(
        F.coalesce(year_first_local, day_first_local))
    return (F.when(text.rlike(r"^\d{10}(\.\d+)?$|^\d{13}$"), epoch_timestamp(text))
            .when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r":\d{2}"), _by_shape(text, ZONED))
            .when(text.rlike(r"^[\d\-/.: T]+$"), F.to_utc_timestamp(local, zone))
            .otherwise(relative_timestamp(text, run_ts, zone)))


def posting_timestamp_or_default(value: Column, link: Column, run_ts: Column, **kwargs) -> Column:
    """:func:`posting_timestamp` with the fixed far-past instant in place of NULL."""
    return F.coalesce(posting_timestamp(value, link, run_ts, **kwargs),
                      F.lit(config.UNKNOWN_DATE).cast("timestamp"))


def local_date(ts: Column, zone: str = config.LOCAL_ZONE) -> Column:
    """Calendar date of a UTC instant in the local zone."""
    return F.from_utc_timestamp(ts, zone).cast("date")


def age_to_date(text: Column, run_ts: Column) -> Column:
    """Date of a card saying ``Posted 5 hours ago``; texts without a known unit give the run date."""
    low = F.lower(F.regexp_replace(text, "\n", " "))
    said = F.regexp_extract(low, r"(\d+)", 1).try_cast("int")
    hours, days, minutes = (F.when(said <= MOST[u], said) for u in ("hour", "day", "minute"))
    zero = F.lit(0)
    back = (F.when(low.contains("hour"), F.make_dt_interval(zero, hours))
            .when(low.contains("day"), F.make_dt_interval(days))
            .when(low.contains("minute"), F.make_dt_interval(zero, zero, minutes)))
    return F.coalesce(run_ts - back, run_ts).cast("date")


def first_slash_date(texts: Column) -> Column:
    """First text of the list that holds a slash and is exactly ten characters long."""
    return F.get(F.filter(texts, lambda x: x.contains("/") & (F.length(x) == 10)), F.lit(0))


def is_recent(day: Column, run_date: Column, max_age_days: int = config.MAX_AGE_DAYS) -> Column:
    """True for days less than ``max_age_days`` before the run date."""
    return day > F.date_sub(run_date, max_age_days)
