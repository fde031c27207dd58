"""Words that extraction split at ligatures, joined again by a dictionary; and composed characters.

These scan from left to right and consume what they join, which column expressions cannot say: they are Arrow-batched UDFs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# What a ligature leaves when a word is split around it, longest first
FRAGMENTS = ["ffi", "ffl", "ff", "fi", "fl"]
# One of these must be in a word that a window of tokens makes
SEQUENCES = ["fi", "fl", "ff", "ffi", "ffl", "ft", "st"]
# Short words that stand alone
STANDALONE = ["if", "of", "off", "a", "an", "the", "in", "on", "or", "is", "it", "as", "at", "be", "by", "do", "go", "he", "me", "my", "no", "so", "to", "up", "us", "we", "af"]

# A fragment between two words, after a word and before none, and before a word
PATTERNS = {"middle": r"(\b\w+)\s+(%s)\s+(\w+\b)", "trailing": r"(\b\w+)\s+(%s)\b(?!\s+\w)", "leading": r"(?:^|(?<=\s))(%s)\s+(\w{2,}\b)"}


def _join_one(word: str, valid: Callable[[str], bool], text: str, fragment: str, older: bool) -> str:
    """Joins `left fragment right`, then `left fragment` before no word, by the rule that word names."""
    apart = lambda x: x.lower() in STANDALONE

    def middle(m: re.Match) -> str:
        left, own, right = m.groups()
        whole = left + own + right
        named = (older or whole[0].isupper()) and not apart(left) and not (apart(right) and len(right) <= 2)
        return whole if valid(whole) or named else m[0]

    def trailing(m: re.Match) -> str:
        return m[1] + m[2] if not apart(m[1]) and len(m[1] + m[2]) >= 4 else m[0]

    def leading(m: re.Match) -> str:
        return m[1] + m[2] if valid(m[1] + m[2]) else m[0]

    rules = {"middle": middle, "trailing": trailing, "leading": leading}
    return re.sub(PATTERNS[word] % fragment, rules[word], text)


def _windows(line: str, valid: Callable[[str], bool]) -> str:
    """The longest of four, three or two tokens that make a valid word with a ligature in it, from each place on; other lines keep their blanks."""
    tokens = line.split()
    at, changed = 0, False
    while at < len(tokens):
        for size in (4, 3, 2):
            run = tokens[at : at + size]
            made = "".join(t.strip("-") for t in run)
            if len(run) == size and not any("\x00" in t for t in run) and valid(made) and any(s in made.lower() for s in SEQUENCES):
                tokens[at : at + size] = [made]
                changed = True
                break
        at += 1
    if not changed:
        return line
    return line[: len(line) - len(line.lstrip())] + " ".join(tokens) + ("\n" if line.endswith("\n") else "")


def rejoined_text(text: str, valid: Callable[[str], bool], older: bool = False) -> str:
    """older: a fragment between two words joins them unless one stands alone, whatever they make, and windows of tokens aren't tried."""
    for rule in ("middle", "trailing", "leading"):
        for fragment in FRAGMENTS:
            text = _join_one(rule, valid, text, fragment, older)
    if older:
        return text
    lines = text.splitlines(True)
    return "".join(_windows(x, valid) if len(x.split()) > 1 else x for x in lines)


def rejoined(text: Column, words: list[str], older: bool = False) -> Column:
    """text with words joined that were split around a ligature. words is the dictionary, lower case; it travels with each task, so it should be
    some megabytes at most. A join that makes no word of it is made only for names in capitals. Null stays null."""
    held = frozenset(words)

    @F.pandas_udf(StringType())
    def run(x: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else rejoined_text(t, lambda w: w.lower() in held, older) for t in x], dtype=object)

    return run(text)


@F.pandas_udf(StringType())
def _nfc(x: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else unicodedata.normalize("NFC", t) for t in x], dtype=object)


def composed(text: Column) -> Column:
    """Combining marks composed with their letters, also across blanks between them."""
    return _nfc(F.regexp_replace(_nfc(text), r"(?U)(\w)\s+([\x{300}-\x{36F}])", "$1$2"))


def is_valid(word: Column, words: list[str]) -> Column:
    """Whether a dictionary holds the word in lower case; for long dictionaries join a table instead."""
    return F.lower(word).isin(words)
