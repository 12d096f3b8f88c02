"""Text clean-up, keyword rules and skill extraction."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstrata import config
from jobstrata.functions import patterns


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes plain spaces only)."""
    return F.btrim(text, F.lit(patterns.SPACES))


def squash(text: Column) -> Column:
    """Lower case without plain spaces."""
    return F.replace(F.lower(text), F.lit(" "), F.lit(""))


def platform_key(platform: Column, known: Iterable[str] = config.KNOWN_PLATFORMS,
                 fallback: str = "other") -> Column:
    """Site name in lower case without spaces; names outside ``known`` become ``fallback``."""
    clean = squash(F.trim(platform))
    return F.when(clean.isin(list(known)), clean).otherwise(F.lit(fallback))


def split_camel_case(text: Column) -> Column:
    """``DataEngineer`` -> ``Data Engineer``."""
    return F.regexp_replace(text, "([a-z])([A-Z])", "$1 $2")


def is_relevant(title: Column, must_have: Iterable[str], positive: Iterable[str],
                negative: Iterable[str]) -> Column:
    """True when a must-have and a positive word occur and no negative one does.

    Camel case counts as split (``split_camel_case``); the patterns know its edges, so the text is not rewritten.
    """
    keep = (title.rlike(patterns.whole_word(must_have, camel=True))
            & title.rlike(patterns.whole_word(positive, camel=True))
            & ~title.rlike(patterns.whole_word(negative, camel=True)))
    return F.coalesce(keep, F.lit(False))


def rule_label(title: Column, rules: Mapping[str, str] = config.TITLE_RULES) -> Column:
    """Role of the leftmost rule found in the space-free title; NULL when none is found."""
    hit = F.regexp_extract(squash(title), patterns.alternation(rules), 0)
    pairs = [F.lit(x) for pair in rules.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), hit)


def role_by_title(title: Column) -> Column:
    """Default role rules for titles the keyword map leaves open."""
    def has(*words: str) -> Column:
        return title.rlike(patterns.standalone_word(words))

    lead = has("manager", "head", "director", "trưởng phòng", "giám đốc")
    data = has("data", "dữ liệu", "database", "ai", "analytics", "bi", "phân tích dữ liệu")
    science = has("ai", "ml", "machine learning", "deep learning", "computer vision", "nlp", "llm",
                  "thị giác máy tính", "data scientist", "data science", "khoa học dữ liệu")
    engineering = (has("dba", "etl", "sql developer", "sql dev", "database administrator")
                   | (has("data", "database", "dữ liệu")
                      & has("engineer", "engineering", "architect", "developer", "administrator",
                            "kỹ sư", "quản trị")))
    business = has("business analyst", "ba")
    tools = has("sql", "tableau", "powerbi", "power bi", "python", "r")
    analysis = (has("bi", "business intelligence", "data analyst", "data analysis", "data analytics",
                    "phân tích dữ liệu") & ~business) | (business & tools)
    stewardship = data & has("governance", "quality", "reviewer", "coordinator", "steward")
    return (F.when(lead & data, "Other Data Job")
            .when(science & ~lead, "Data Scientist")
            .when(stewardship, "Other Data Job")
            .when(engineering, "Data Engineer")
            .when(analysis, "Data Analyst")
            .otherwise(F.lit(config.NO_LABEL)))


def extract_terms(text: Column, terms: Iterable[str] = config.SKILLS, *, edges_only: bool = False) -> Column:
    """Distinct dictionary terms as written in the text, sorted; an empty array when there are none.

    Longer terms are tried first. ``edges_only=True`` asks for a word edge on both sides of the
    term, so that ``C++`` is found in ``C++11`` but not in ``C++ developer``.
    """
    ordered = patterns.longest_first(terms)
    pattern = patterns.whole_word(ordered) if edges_only else patterns.standalone_word(ordered)
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))))
    empty = F.array().cast("array<string>")
    return F.when(text.isNull() | (text == config.NO_LABEL), empty).otherwise(found)


def vietnamese_letters() -> tuple[str, str]:
    """Precomposed accented Vietnamese letters and the plain letter each one stands for.

    A vowel takes one of five tones; a, e, o and u also have shaped forms that exist with and
    without a tone. ``đ`` is a letter of its own.
    """
    tones = ["̀", "́", "̉", "̃", "̣"]
    breve, circumflex, horn = "̆", "̂", "̛"
    shapes = {"a": ["", breve, circumflex], "e": ["", circumflex], "i": [""],
              "o": ["", circumflex, horn], "u": ["", horn], "y": [""]}
    accented, plain = "", ""
    for base, forms in shapes.items():
        for shape in forms:
            for tone in ([""] if shape else []) + tones:
                letter = unicodedata.normalize("NFC", base + shape + tone)
                accented += letter + letter.upper()
                plain += base + base.upper()
    return accented + "đĐ", plain + "dD"


def remove_accents(text: Column, letters: tuple[str, str] | None = None) -> Column:
    """Plain letters instead of accented ones, stripped; NULL becomes the empty string."""
    accented, plain = letters or vietnamese_letters()
    return F.coalesce(strip(F.translate(text, accented, plain)), F.lit(""))


def normalise_location(location: Column, names: Iterable[str] = config.PROVINCES, *,
                       letters: tuple[str, str] | None = None, other: str = "Other") -> Column:
    """Place names found in a text, in order of first mention and as spelled there."""
    plain = remove_accents(location, letters)
    found = F.array_distinct(F.regexp_extract_all(plain, F.lit(patterns.optional_space(names)), F.lit(0)))
    return F.when(F.size(found) > 0, F.array_join(found, ", ")).otherwise(F.lit(other))


def distinct_in_order(values: Column) -> Column:
    """A list without repeats, each value where it came first."""
    return F.array_distinct(values)


def join_places(places: Column) -> Column:
    """One text from a list of place names."""
    return F.array_join(places, ", ")


def parse_literal_list(text: Column) -> Column:
    """A list written as text (``['a', 'b']``); broken lists become empty, other text one element."""
    is_list = text.startswith("[")
    parsed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
    return (F.when(is_list, F.coalesce(parsed, F.array().cast("array<string>")))
            .when(text.isNotNull(), F.array(text)))


def missing_to_null(text: Column, markers: Iterable[str] = config.MISSING_MARKERS) -> Column:
    """NULL for the texts that stand for a missing value in a hand-off file."""
    return F.when(~text.isin(list(markers)), text)


def merge_tags(tags: Column, tooltip: Column) -> Column:
    """Visible tags and those of a comma-separated tooltip, distinct, without ``+n`` counters."""
    hidden = F.when(F.length(tooltip) > 0, F.transform(F.split(tooltip, ","), strip))
    none = F.array().cast("array<string>")
    merged = F.array_union(F.coalesce(tags, none), F.coalesce(hidden, none))
    return F.array_sort(F.filter(merged, lambda x: ~x.startswith("+")))


def compare_key(title: Column, employer: Column) -> Column:
    """Text by which two postings are compared: squashed title, a space, squashed employer."""
    return F.concat(squash(F.coalesce(title, F.lit(""))), F.lit(" "), squash(F.coalesce(employer, F.lit(""))))
