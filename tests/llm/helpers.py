"""Small tables with the awkward rows every operator must take."""

import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
_WORDS = "river stone market letter winter engine garden paper window captain bread silver music doctor harbour".split()


def prose(n, seed=0, words=_WORDS):
    dice = random.Random(seed)
    return " ".join(dice.choice(words) + (str(dice.randint(0, 99)) if dice.random() < 0.4 else "") for _ in range(n))


def awkward_documents(spark, extra=()):
    """NULLs in every column, empty and blank texts, repeated rows, ties and one long text."""
    base = prose(120, 1)
    rows = [(1, base, "en", "a", 5), (1, base, "en", "a", 5), (2, base, "en", "a", 5), (3, None, None, None, None),
            (4, "", "en", "a", 0), (5, " \n\t ", "en", "b", 4), (None, prose(60, 3), "en", "b", 1), (6, "one", "en", "b", 3),
            (7, "one two", "en", "b", 7), (8, prose(40_000, 4), "fr", "b", 9), (9, "Ünï cödé ✓ 日本語 " * 30, "de", "b", 1),
            (10, base.upper(), "en", None, 2), *extra]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def empty_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
