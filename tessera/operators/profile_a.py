"""Profile A: normalising that keeps other scripts, blocking keys, and the 14 pair features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import arrays, similarity
from tessera.functions.text import compact, numbers, postcode, replaced, sorted_tokens, squeezed, strip_marks, tokens

#: Symbols, and what they stand for.
SYMBOLS = (("&", " and "), ("@", " at "), (r"\+", " plus "))
#: Abbreviations in addresses, in the order in which they are expanded.
EXPANSIONS = (
    (r"(?U)\bst\b", "street"),
    (r"(?U)\brd\b", "road"),
    (r"(?U)\bave\b", "avenue"),
    (r"(?U)\bdr\b", "drive"),
    (r"(?U)\bblvd\b", "boulevard"),
    (r"(?U)\bln\b", "lane"),
    (r"(?U)\bct\b", "court"),
    (r"(?U)\bp\.?\s*o\.?\s*box\b", "pobox"),
    (r"(?U)\b(h\.?\s*no|house\s*no|kh\.?\s*no|plot\s*no)\b", "no"),
)
#: Legal forms, those of several words first.
LEGAL_FORMS = (
    "private limited", "pvt limited", "private ltd", "pvt ltd",
    "sarl", "eurl", "sasu", "scop", "snc", "sci", "gie", "sas", "sa",
    "incorporated", "corporation", "limited", "enterprise", "enterprises", "proprietorship", "pllc", "corp", "inc", "llc", "llp", "ltd", "pvt", "co",
)
#: Address words that tell nothing about a place.
SKIPPED = ("street", "road", "drive", "avenue", "lane", "boulevard", "court", "pobox", "unit", "apt", "suite", "floor", "near", "opp", "opposite")

#: What is left of web addresses.
WEB = ((r"(?U)\bwww\b", " "), (r"(?U)\.(com|co|in|org|net|io|edu|gov)\b", " "))

LEGAL_END = rf"(?U)\b({'|'.join(LEGAL_FORMS)})$"
LEGAL_START = rf"(?U)^({'|'.join(LEGAL_FORMS)})\b"

FEATURES = (
    "name_ratio", "name_token_sort", "name_token_set", "name_jaro_winkler", "name_jaccard", "core_name_exact", "suffix_agreement",
    "addr_jaccard", "addr_ratio", "common_words_count", "house_num_match", "house_num_conflict", "postcode_match", "country_equal",
)


def general(text: Column) -> Column:
    """Folded, in lower case, without web parts and punctuation, symbols spelled out."""
    text = replaced(F.lower(strip_marks(text)), (*WEB, *SYMBOLS))
    return squeezed(F.regexp_replace(text, r"(?U)[^\w\s\x{900}-\x{d7f}]", " "))


def address(text: Column) -> Column:
    return squeezed(replaced(general(text), EXPANSIONS))


def legal_form(clean: Column) -> Column:
    """The legal form at the end, or else at the start; empty without."""
    at_end = F.regexp_extract(clean, LEGAL_END, 1)
    return F.when(at_end != "", at_end).otherwise(F.regexp_extract(clean, LEGAL_START, 1))


def core_name(clean: Column) -> Column:
    """The name without its legal form, unless nothing else is left, and without a leading `the` if it is long enough."""
    without = F.trim(F.when(F.regexp_extract(clean, LEGAL_END, 1) != "", F.regexp_replace(clean, LEGAL_END, "")).otherwise(F.regexp_replace(clean, LEGAL_START, "")))
    core = F.when(without != "", without).otherwise(clean)
    return F.when(core.startswith("the ") & (F.length(core) >= 8), F.trim(F.substring(core, F.lit(5), F.length(core)))).otherwise(core)


def normalise(entities: DataFrame) -> DataFrame:
    """`entities` with clean_name, core_name, legal_suffix, sorted_name (of the core), sorted_clean, compact_name,
    clean_address, numeric_tokens, postcode, country_clean."""
    df = entities.withColumns({"clean_name": general(F.col("business_name")), "clean_address": address(F.col("business_address")), "country_clean": F.upper(F.trim(F.coalesce("country", F.lit(""))))})
    df = df.withColumns({"core_name": core_name(F.col("clean_name")), "legal_suffix": legal_form(F.col("clean_name"))})
    return df.withColumns(
        {
            "sorted_name": sorted_tokens(F.col("core_name")),
            "sorted_clean": sorted_tokens(F.col("clean_name")),
            "compact_name": compact(F.col("clean_name")),
            "numeric_tokens": numbers(F.col("clean_address")),
            "postcode": postcode(F.col("clean_address")),
        }
    )


def blocking_keys(normal: DataFrame) -> DataFrame:
    """entity_id, country_key, key: one row for each key that a record gives, repeats included.

    Fixed values: the marks of the kinds (cn, sn, np, 2t, nh, an), the least lengths, and `UNKNOWN`.
    """
    core, nums, pc = F.col("core_name"), F.slice("numeric_tokens", 1, 2), F.col("postcode")
    words = F.filter(tokens(core), lambda w: (F.length(w) >= 3) & ~w.isin("the", "and"))
    place = F.filter(tokens(F.col("clean_address")), lambda w: (F.length(w) >= 4) & ~w.rlike(r"(?U)^\d+$") & ~w.isin(*SKIPPED))
    df = normal.select("entity_id", F.when(F.col("country_clean") == "", "UNKNOWN").otherwise(F.col("country_clean")).alias("country_key"), "core_name", "sorted_name", pc, nums.alias("nums"), words.alias("words"), F.slice(place, 1, 2).alias("place"))
    first, nums = F.get("words", F.lit(0)), F.col("nums")
    pair = lambda i: F.concat(F.lit("2t:"), F.array_join(F.array_sort(F.array(first, F.get("words", F.lit(i)))), "_"))
    single = F.array(
        F.when(F.length("core_name") >= 3, F.concat(F.lit("cn:"), "core_name")),
        F.when(F.length("sorted_name") >= 3, F.concat(F.lit("sn:"), "sorted_name")),
        F.when(first.isNotNull() & (F.length("postcode") >= 4), F.concat(F.lit("np:"), first, F.lit("_"), "postcode")),
        F.when(F.size("words") >= 2, pair(1)),
        F.when(F.size("words") >= 3, pair(2)),
    )
    house = F.when(first.isNotNull(), F.transform(nums, lambda n: F.concat(F.lit("nh:"), first, F.lit("_"), n)))
    street = F.flatten(F.transform("place", lambda w: F.transform(nums, lambda n: F.concat(F.lit("an:"), w, F.lit("_"), n))))
    every = F.concat(F.filter(single, lambda k: k.isNotNull()), F.coalesce(house, F.array().cast("array<string>")), street)
    return df.select("entity_id", "country_key", F.explode(every).alias("key"))


def pre_score(s: str = "s_", t: str = "t_") -> Column:
    """0.60 Jaccard of name words, 0.25 of address words, 0.15 for a shared number; native, rounded to 12 places for ranking."""
    col = lambda side, name: F.col(side + name)
    names = arrays.jaccard(*(arrays.words_from(col(x, "core_name"), 2) for x in (s, t)))
    places = arrays.jaccard(*(arrays.words_from(col(x, "clean_address"), 2) for x in (s, t)))
    number = F.arrays_overlap(col(s, "numeric_tokens"), col(t, "numeric_tokens"))
    return F.round(0.60 * names + 0.25 * places + 0.15 * number.cast("int"), 12)


def features(pairs: DataFrame) -> DataFrame:
    """`pairs` (columns of normalise() with s_ and t_ in front) with the 14 features."""
    both = lambda name: (F.col("s_" + name), F.col("t_" + name))
    filled = lambda name: (F.col("s_" + name) != "") & (F.col("t_" + name) != "")
    where = lambda here, value: F.when(here, value).otherwise(0.0)
    flag = lambda here: here.cast("double")
    has_name, has_place = filled("core_name"), filled("clean_address")
    places = [arrays.words_from(c, 3, digits=False) for c in both("clean_address")]
    some_numbers = (F.size("s_numeric_tokens") > 0) & (F.size("t_numeric_tokens") > 0)
    overlap = F.arrays_overlap(*both("numeric_tokens"))
    return pairs.withColumns(
        {
            "name_ratio": where(has_name, similarity.ratio_of(*both("core_name"))),
            "name_token_sort": where(has_name, similarity.token_sort_ratio_of(*both("core_name"))),
            "name_token_set": where(has_name, similarity.token_set_ratio_of(*both("core_name"))),
            "name_jaro_winkler": where(has_name, similarity.jaro_winkler_of(*both("core_name"))),
            "name_jaccard": where(has_name, arrays.jaccard(*(arrays.words_from(c, 2) for c in both("core_name")))),
            "core_name_exact": flag(has_name & (F.col("s_core_name") == F.col("t_core_name"))),
            "suffix_agreement": where(filled("legal_suffix"), F.when(F.col("s_legal_suffix") == F.col("t_legal_suffix"), 1.0).otherwise(-1.0)),
            "addr_jaccard": where(has_place, arrays.jaccard(*places)),
            "addr_ratio": where(has_place, similarity.ratio_of(*both("clean_address"))),
            "common_words_count": where(has_place, arrays.shared(*places).cast("double")),
            "house_num_match": flag(some_numbers & overlap),
            "house_num_conflict": flag(some_numbers & ~overlap),
            "postcode_match": flag(filled("postcode") & (F.col("s_postcode") == F.col("t_postcode"))),
            "country_equal": flag(filled("country_clean") & (F.col("s_country_clean") == F.col("t_country_clean"))),
        }
    )
