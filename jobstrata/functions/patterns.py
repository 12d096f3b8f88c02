"""Regular-expression text for whole-word matching over any script.

Java's ``\\b`` is ASCII-only by default and its Unicode variant disagrees with the usual
definition on combining marks and superscripts, so the word class is spelled out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

WORD = r"[\p{L}\p{N}_]"
# what counts as white space, as a class and as a list of characters
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def alternation(words: Iterable[str]) -> str:
    """``a|b|c`` with every word taken literally."""
    words = list(words)
    if not words:
        raise ValueError("at least one word is needed")
    return "|".join(re.escape(w) for w in words)


def longest_first(words: Iterable[str]) -> list[str]:
    """Longer words before shorter ones, so that a phrase wins over the word it starts with."""
    return sorted(words, key=len, reverse=True)


def _first_letters(words: Iterable[str]) -> str:
    """Look-ahead that rules out most positions by one character before the words are tried."""
    letters = sorted({f for w in words for f in (w[0], w[0].lower(), w[0].upper()) if len(f) == 1})
    return f"(?=[{''.join(re.escape(f) for f in letters)}])"


def _is_word(char: str) -> bool:
    return char == "_" or unicodedata.category(char)[0] in "LN"


# where a small ASCII letter is followed by a capital, and where it is not
CAMEL_EDGE = "(?-iu:(?<=[a-z])(?=[A-Z]))"
_NO_CAMEL_EDGE = "(?-iu:(?<![a-z](?=[A-Z])))"


def _in_camel_case(word: str) -> str:
    """The word as it stands in a text in which camel case was not split: its blanks may be camel-case edges, and no other
    place in it may be one."""
    parts, before = [], ""
    for char in word:
        if char == " ":
            parts.append(f"(?: |{CAMEL_EDGE})")
        else:
            parts.append((_NO_CAMEL_EDGE if before.isascii() and before.isalpha() and char.isascii() and char.isalpha() else "")
                         + re.escape(char))
        before = char
    return "".join(parts)


def whole_word(words: Iterable[str], camel: bool = False) -> str:
    """Any of the words, in any case, with a word edge on both sides (group 1).

    Next to a letter an edge means "no word character on the other side", next to a symbol it
    means "a word character on the other side". With ``camel`` words are found as if camel case had been split by blanks
    before, without rewriting the text.
    """
    words = list(words)
    if not words:
        raise ValueError("at least one word is needed")
    edge = f"|{CAMEL_EDGE}" if camel else ""
    before = {True: f"(?:(?<!{WORD}){edge})", False: f"(?<={WORD})"}
    after = {True: f"(?:(?!{WORD}){edge})", False: f"(?={WORD})"}
    written = _in_camel_case if camel else re.escape
    if all(_is_word(w[0]) and _is_word(w[-1]) for w in words):
        return f"(?iu){_first_letters(words)}{before[True]}({'|'.join(map(written, words))}){after[True]}"
    parts = [before[_is_word(w[0])] + written(w) + after[_is_word(w[-1])] for w in words]
    return f"(?iu){_first_letters(words)}({'|'.join(parts)})"


def standalone_word(words: Iterable[str]) -> str:
    """Like :func:`whole_word`, but words ending in a symbol (``C++``) also match before a space."""
    words = list(words)
    return f"(?iu){_first_letters(words)}(?<!{WORD})({alternation(words)})(?!{WORD})"


def optional_space(words: Iterable[str]) -> str:
    """Any of the words anywhere, in any case, with each space optional."""
    words = list(words)
    parts = ["".join(f"{SPACE}?" if c == " " else re.escape(c) for c in w) for w in words]
    return f"(?iu){_first_letters(words)}(?:{'|'.join(parts)})"
