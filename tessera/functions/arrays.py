"""Sets of tokens as arrays: filters, overlaps, Jaccard similarity, bigrams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import compact, tokens

#: Words too common to block on, in English, French and romanised Hindi.
STOPWORDS = ("the", "and", "of", "in", "at", "to", "for", "a", "an", "de", "du", "la", "le", "les", "et", "en", "ki", "ka", "ke", "aur", "se")


def words_from(text: Column, least: int, digits: bool = True) -> Column:
    """Distinct words of at least `least` characters; digits: those of digits alone too."""
    keep = lambda t: (F.length(t) >= least) if digits else (F.length(t) >= least) & ~t.rlike(r"(?U)^\d+$")
    return F.array_distinct(F.filter(tokens(text), keep))


def shared(a: Column, b: Column) -> Column:
    """How many distinct elements both arrays have."""
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column, empty: float = 0.0) -> Column:
    """Shared of all distinct elements; `empty` where neither has any."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(empty)).otherwise(shared(a, b) / either)


def token_jaccard(a: Column, b: Column) -> Column:
    """Of the words of two texts: 1 if neither has any, 0 if one has none."""
    return jaccard(F.array_distinct(tokens(a)), F.array_distinct(tokens(b)), 1.0)


def common_tokens(a: Column, b: Column) -> Column:
    return shared(F.array_distinct(tokens(a)), F.array_distinct(tokens(b)))


def bit_words(places: Column, words: int, name: str) -> dict[str, Column]:
    """Columns name0, name1, ...: whole numbers that have a bit for each of the places."""
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))
    word = lambda i: F.aggregate(F.filter(places, lambda p: F.floor(p / 64) == i), F.lit(0).cast("long"), lambda x, p: x.bitwiseOR(bit(p)))
    return {f"{name}{i}": F.coalesce(word(i), F.lit(0).cast("long")) for i in range(words)}


def common_bits(a: str, b: str, words: int) -> Column:
    """How many bits are set in both."""
    return reduce(Column.__add__, (F.bit_count(F.col(f"{a}{i}").bitwiseAND(F.col(f"{b}{i}"))) for i in range(words)))


def any_bit(a: str, b: str, words: int) -> Column:
    """Whether a bit is set in both."""
    return reduce(Column.bitwiseOR, (F.col(f"{a}{i}").bitwiseAND(F.col(f"{b}{i}")) for i in range(words))) != 0


def word_set(words: Column, name: str, sketch: int, known: tuple[str, ...] = ()) -> dict[str, Column]:
    """What common_words() needs of a set of words: a bit for each of the `known` ones, the others, and bits of their hashes in `sketch` whole numbers."""
    held = F.array(*map(F.lit, known)).cast("array<string>")
    rest = F.array_except(words, held)
    places = F.transform(F.array_intersect(words, held), lambda w: F.array_position(held, w) - 1)
    hashed = F.transform(rest, lambda w: F.pmod(F.xxhash64(w), F.lit(64 * sketch)))
    return {f"{name}_words": F.coalesce(rest, F.array().cast("array<string>"))} | bit_words(hashed, sketch, f"{name}_sketch") | bit_words(places, -(-len(known) // 64), f"{name}_known")


def common_words(a: str, b: str, sketch: int, known: tuple[str, ...] = ()) -> Column:
    """How many words are in both sets. Where sketches have no bit in common there are none but known ones; else the words are compared."""
    rest = F.when(any_bit(f"{a}_sketch", f"{b}_sketch", sketch), shared(F.col(f"{a}_words"), F.col(f"{b}_words"))).otherwise(0)
    return common_bits(f"{a}_known", f"{b}_known", -(-len(known) // 64)) + rest if known else rest


def share(part: Column, whole: Column) -> Column:
    return part / whole


def share_6(part: Column, whole: Column) -> Column:
    """round(part / whole, 6) of whole numbers below 2^31, without decimals made for each row."""
    part, whole = part.cast("long"), whole.cast("long")
    return F.call_function("div", part * 2_000_000 + whole, whole * 2) / 1e6


def strong_tokens(text: Column, least: int = 3) -> Column:
    """Words, with repeats, long enough to block on and not stopwords."""
    return F.filter(tokens(text), lambda t: (F.length(t) >= least) & ~t.isin(*STOPWORDS))


def bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring characters, spaces left out."""
    held = compact(text)
    many = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(held) - 1), lambda i: F.substring(held, i, F.lit(2))))
    return F.when(F.length(held) < 2, F.array().cast("array<string>")).otherwise(many)
