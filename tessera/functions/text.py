"""Text columns: Unicode folding with a native path for Latin text, patterns, tokens."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MARKS = range(0x300, 0x370)
#: Latin blocks whose letters the native path covers.
LATIN = (range(0xA0, 0x250), range(0x1E00, 0x1F00))


def without_marks(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if ord(c) not in MARKS)


@lru_cache(maxsize=1)
def latin_table() -> tuple[str, str, str]:
    """Letters that fold to one character and what they fold to, and a character class of all that needs no more than that."""
    one = [(chr(c), f) for block in LATIN for c in block if len(f := without_marks(chr(c))) == 1]
    changed = [(c, f) for c, f in one if c != f]
    inside = "".join(f"\\x{{{ord(c):x}}}" for c, _ in one)
    return "".join(c for c, _ in changed), "".join(f for _, f in changed), f"^[\\x00-\\x7f{inside}]*$"


@F.pandas_udf(StringType())
def _without_marks(text: pd.Series) -> pd.Series:
    return text.map(without_marks, na_action="ignore")


@F.pandas_udf(StringType())
def _compatible(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def strip_marks(text: Column) -> Column:
    """Compatibility decomposition without combining marks U+0300 to U+036F. Only text beyond Latin enters Python."""
    source, target, plain = latin_table()
    text = F.coalesce(text, F.lit(""))
    is_plain = text.rlike(plain)
    return F.when(is_plain, F.translate(text, source, target)).otherwise(_without_marks(F.when(~is_plain, text)))


def compatible_lower(text: Column) -> Column:
    """Compatibility composition, trimmed, in lower case. Only text beyond ASCII enters Python."""
    text = F.coalesce(text, F.lit(""))
    is_plain = text.rlike(r"^[\x00-\x7f]*$")
    composed = F.when(is_plain, text).otherwise(_compatible(F.when(~is_plain, text)))
    return F.lower(stripped(composed))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def squeezed(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def tokens(text: Column) -> Column:
    """The words of a squeezed text."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def sorted_tokens(text: Column) -> Column:
    """The words in code point order, joined by spaces."""
    return F.array_join(F.array_sort(tokens(text)), " ")


def compact(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def replaced(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """Patterns replaced one after another."""
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def numbers(text: Column) -> Column:
    """Every run of digits, in order, with repeats, inside words too."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\d+"), F.lit(0))


def postcode(text: Column, pattern: str = r"\d{5,6}") -> Column:
    """The first postcode, or an empty string."""
    return F.regexp_extract(text, rf"(?U)\b({pattern})\b", 1)
