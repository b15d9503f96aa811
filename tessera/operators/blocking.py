"""Blocking: keys to candidates under a cap on bucket size, ranked top-K, and how much of the truth they hold.

Keys carry only identifiers, so the shuffle on keys is narrow; pairs are made distinct before wide columns are joined,
and only what the native pre-score ranks in the first K ever meets a Python function.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import arrays
from tessera.operators import profile_a, profile_b

TOP_K = 20
MOST_IN_BUCKET = 500
#: What bigrams are made of, the 64-bit words that hold a bit for each bigram, and the blocks that records of a side are dealt to.
SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789"
WORDS = -(-len(SIGNS) ** 2 // 64)
BLOCKS = 16
#: Bits of a mark of an exact key, of which one number holds one for each kind.
MARK_BITS = 12
EACH_MARK = sum(1 << MARK_BITS * n for n in range(len(profile_b.EXACT_KINDS)))
MANY_KEYS = 1 << MARK_BITS * len(profile_b.EXACT_KINDS)
#: So many records at most are broadcast.
FEW = 50_000


def bucket_sizes(target_keys: DataFrame) -> DataFrame:
    """country_key, key, n: emitted keys on the target side, a record's repeats counted."""
    return target_keys.groupBy("country_key", "key").agg(F.count(F.lit(1)).alias("n"))


def capped(target_keys: DataFrame, most: int = MOST_IN_BUCKET) -> DataFrame:
    """The target keys whose bucket holds at most `most` of them."""
    small = bucket_sizes(target_keys).where(F.col("n") <= most).select("country_key", "key")
    return target_keys.join(small, ["country_key", "key"])


def met(s1_keys: DataFrame, target_keys: DataFrame, on: list[str]) -> DataFrame:
    """s1_id, tgt_id: pairs that share a key, each once."""
    left = s1_keys.select(F.col("entity_id").alias("s1_id"), *on).distinct()
    right = target_keys.select(F.col("entity_id").alias("tgt_id"), *on).distinct()
    return left.join(right, on).select("s1_id", "tgt_id").distinct()


def bitmaps(keys: DataFrame, entity: str, name: str) -> DataFrame:
    """entity, and in columns name0, name1, ...: which keys (pairs of a-z and 0-9) an entity has, a bit for each, if it has any."""
    at = lambda n: F.instr(F.lit(SIGNS), F.substring("key", n, 1)) - 1
    place = keys.select(F.col("entity_id").alias(entity), (at(1) * len(SIGNS) + at(2)).alias("place"))
    word = lambda i: F.coalesce(F.bit_or(F.when(F.floor(F.col("place") / 64) == i, F.expr("shiftleft(1L, cast(place % 64 as int))"))), F.lit(0).cast("long"))
    return place.groupBy(entity).agg(*(word(i).alias(f"{name}{i}") for i in range(WORDS)))


def met_often(s1_keys: DataFrame, target_keys: DataFrame, least: int, records: tuple[DataFrame, DataFrame] | None = None, exact: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """s1_id, tgt_id: pairs that share at least `least` distinct bigrams, or a key of `exact` (entity_id, key of both sides), each once; `records` as in pairs_b().

    There are 1,296 bigrams, so lists by bigram would meet more often than there are pairs of records. Records are
    compared as bitmaps, block by block, and only pairs that are found are ever made into rows. Records travel beside
    their bitmaps, as to look them up for each pair takes longer than to find the pair. So do exact keys: their pairs, too,
    grow with the square of the input, and to look bitmaps up for them would shuffle far more than the records.
    """
    left, right = bitmaps(s1_keys, "s1_id", "s"), bitmaps(target_keys, "tgt_id", "t")
    enough = lambda x: reduce(Column.__add__, (F.bit_count(f"{x}{i}") for i in range(WORDS))) >= least
    cells = lambda x, own, other: F.array(*(F.concat_ws(",", *((F.lit(str(n)), own) if x == "t" else (own, F.lit(str(n))))) for n in range(other)))
    deal = lambda c: F.pmod(F.xxhash64(c), F.lit(BLOCKS)).cast("string")
    alike = arrays.common_bits("s", "t", WORDS) >= least
    if exact:
        left, right = with_exact(left, exact[0], "s1_id", "s"), with_exact(right, exact[1], "tgt_id", "t")
        alike = alike | (maybe_met("s", "t") & F.arrays_overlap("s_exact", "t_exact"))
    else:
        left, right = left.where(enough("s")), right.where(enough("t"))
    kept = ["s1_id", "tgt_id"]
    if records:
        beside = marked(records[0], "s_", "s1_id"), marked(records[1], "t_", "tgt_id")
        left, right, kept = left.join(beside[0], "s1_id"), right.join(beside[1], "tgt_id"), list(dict.fromkeys([*kept, *beside[0].columns, *beside[1].columns]))
    left = left.withColumn("cell", F.explode(cells("s", deal("s1_id"), BLOCKS)))
    right = right.withColumn("cell", F.explode(cells("t", deal("tgt_id"), BLOCKS)))
    # a task for each cell or so: the work lies in the pairs, which the size of what is shuffled does not show
    left, right = (df.repartition(BLOCKS * BLOCKS, "cell") for df in (left, right))
    return left.hint("shuffle_hash").join(right, "cell").where(alike).select(*kept)


def with_exact(held: DataFrame, keys: DataFrame, entity: str, name: str) -> DataFrame:
    """bitmaps() with all entities of `keys` too, their keys (`name`_exact) and marks of them (`name`_marks).

    Marks have twelve bits of a hash for each kind of key; a kind without a key has 0 on one side and 1 on the other.
    The bit above them is set if some kind has several keys, so that the marks tell nothing.
    """
    kinds = range(len(profile_b.EXACT_KINDS))
    blank = int(name == "t")
    hashed = lambda n: F.when(F.col("key").startswith(profile_b.EXACT_KINDS[n] + ":"), F.pmod(F.xxhash64("key"), F.lit((1 << MARK_BITS) - 2)) + 2)
    marks = reduce(Column.bitwiseOR, (F.shiftleft(F.coalesce(F.max(hashed(n)), F.lit(blank).cast("long")), MARK_BITS * n) for n in kinds))
    several = reduce(Column.__or__, (F.max(hashed(n)) != F.min(hashed(n)) for n in kinds))
    marks = marks.bitwiseOR(F.when(several, MANY_KEYS).otherwise(0).cast("long"))
    of = keys.groupBy(F.col("entity_id").alias("of_exact")).agg(F.collect_set("key").alias(f"{name}_exact"), marks.alias(f"{name}_marks"))
    none = {f"{name}{i}": F.lit(0).cast("long") for i in range(WORDS)}
    none |= {f"{name}_exact": F.array().cast("array<string>"), f"{name}_marks": F.lit(blank * EACH_MARK).cast("long")}
    both = held.join(of, F.col(entity).eqNullSafe(F.col("of_exact")), "full")
    return both.select(F.coalesce(entity, "of_exact").alias(entity), *(F.coalesce(c, value).alias(c) for c, value in none.items()))


def maybe_met(a: str, b: str) -> Column:
    """By marks of with_exact(): true where a key is shared, false nearly everywhere else."""
    one, other = F.col(f"{a}_marks"), F.col(f"{b}_marks")
    lit = lambda x: F.lit(x).cast("long")
    low, high = EACH_MARK * ((1 << MARK_BITS - 1) - 1), EACH_MARK << MARK_BITS - 1
    differ = one.bitwiseXOR(other)
    # the lower bits of a mark that differ carry into its highest; where that is not set after all, the marks are equal
    set_ = (differ.bitwiseAND(lit(low)) + lit(low)).bitwiseOR(differ).bitwiseAND(lit(high))
    return (set_ != lit(high)) | (one.bitwiseOR(other) >= lit(MANY_KEYS))


def marked(df: DataFrame, mark: str, key: str) -> DataFrame:
    """entity_id as `key`, and `mark` before the other columns."""
    return df.select(F.col("entity_id").alias(key), *(F.col(c).alias(mark + c) for c in df.columns if c != "entity_id"))


def with_records(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """`pairs` joined to both records, their columns with s_ and t_ in front; pairs without a record go."""
    few = lambda df: F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df  # noqa: E731  else very many pairs would be shuffled twice
    return pairs.join(few(marked(s1, "s_", "s1_id")), "s1_id").join(few(marked(targets, "t_", "tgt_id")), "tgt_id")


def ranked(scored: DataFrame, k: int = TOP_K) -> DataFrame:
    """s1_id, tgt_id, pre_score, rk: the first `k` by score, ties by tgt_id."""
    order = Window.partitionBy("s1_id").orderBy(F.desc("pre_score"), "tgt_id")
    return scored.select("s1_id", "tgt_id", "pre_score").withColumn("rk", F.row_number().over(order)).where(F.col("rk") <= k)


def candidates_a(s1: DataFrame, targets: DataFrame, k: int = TOP_K, most: int = MOST_IN_BUCKET) -> DataFrame:
    """Top-K candidates of normalised records, profile A."""
    pairs = met(profile_a.blocking_keys(s1), capped(profile_a.blocking_keys(targets), most), ["country_key", "key"])
    needed = ("entity_id", "core_name", "clean_address", "numeric_tokens")
    return ranked(with_records(pairs, s1.select(*needed), targets.select(*needed)).withColumn("pre_score", profile_a.pre_score()), k)


def same_country(pairs: DataFrame) -> DataFrame:
    """Pairs (s_country_norm, t_country_norm) of one country; all pairs of a record that has none such, or no country."""
    same = (F.col("s_country_norm") == F.col("t_country_norm")) & (F.col("s_country_norm") != "")
    any_same = F.max(same).over(Window.partitionBy("s1_id"))
    return pairs.withColumn("any_same", any_same).where(same | ~F.col("any_same")).drop("any_same")


def pairs_b(s1: DataFrame, targets: DataFrame, bigrams: int | None = 3, records: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """s1_id, tgt_id that share a key of profile B, or at least `bigrams` bigrams (None: do without).

    `records` (columns of both sides, with entity_id): the pairs as with_records() joins them.
    """
    found = lambda pairs: with_records(pairs, *records) if records else pairs
    exact = profile_b.exact_keys(s1), profile_b.exact_keys(targets)
    if bigrams is None:
        return found(met(*exact, ["key"]))
    return met_often(profile_b.bigram_keys(s1), profile_b.bigram_keys(targets), bigrams, records, exact)


def candidates_b(s1: DataFrame, targets: DataFrame, k: int = TOP_K, country_filter: bool = True, bigrams: int | None = 3) -> DataFrame:
    """Top-K candidates of normalised records, profile B."""
    needed = ("entity_id", "name_punct", "addr_punct", "country_norm")
    pairs = with_records(pairs_b(s1, targets, bigrams), s1.select(*needed), targets.select(*needed))
    return ranked((same_country(pairs) if country_filter else pairs).withColumn("pre_score", profile_b.pre_score()), k)


def spine(s1: DataFrame, candidates: DataFrame) -> DataFrame:
    """s1_id, n_candidates: every reference record, those without candidates too."""
    counts = candidates.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"))
    return s1.select(F.col("entity_id").alias("s1_id")).join(counts, "s1_id", "left").select("s1_id", F.coalesce("n", F.lit(0)).alias("n_candidates"))


def _found(candidates: DataFrame, links: DataFrame) -> DataFrame:
    held = candidates.select("s1_id", "tgt_id").distinct().withColumn("hit", F.lit(1))
    return links.join(held, ["s1_id", "tgt_id"], "left").groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_true"), F.count("hit").alias("n_hit"))


def recall_all(s1: DataFrame, candidates: DataFrame, links: DataFrame) -> DataFrame:
    """One row on all reference records: counts, recall of links, mean and most candidates."""
    per = spine(s1, candidates).join(_found(candidates, links), "s1_id", "left").fillna(0, ["n_true", "n_hit"])
    return per.agg(
        F.count(F.lit(1)).alias("total_s1"),
        F.count_if(F.col("n_true") == 0).alias("singletons"),
        F.count_if(F.col("n_true") > 0).alias("nonsingletons"),
        F.coalesce(F.sum("n_true"), F.lit(0)).alias("total_true_matches"),
        F.coalesce(F.sum("n_hit"), F.lit(0)).alias("retrieved_true_matches"),
        _share(F.sum("n_hit"), F.sum("n_true")).alias("blocking_recall"),
        F.coalesce(F.avg("n_candidates"), F.lit(0.0)).alias("avg_candidates_per_s1"),
        F.coalesce(F.max("n_candidates"), F.lit(0)).alias("max_candidates_per_s1"),
    )


def recall_linked(s1: DataFrame, candidates: DataFrame, links: DataFrame, n_targets: Callable[[], int] | None = None) -> DataFrame:
    """One row on the reference records that have links: recall (4 places), mean (2 places) and most candidates."""
    per = spine(s1, candidates).join(_found(candidates, links), "s1_id")
    out = per.agg(
        F.round(_share(F.sum("n_hit"), F.sum("n_true")), 4).alias("blocking_recall"),
        F.round(F.coalesce(F.avg("n_candidates"), F.lit(0.0)), 2).alias("avg_candidates"),
        F.coalesce(F.max("n_candidates"), F.lit(0)).alias("max_candidates"),
        *([F.lit(1.0) - _share(F.sum("n_candidates"), F.count(F.lit(1)) * n_targets())] if n_targets else []),
    )
    return out.withColumnRenamed(out.columns[-1], "reduction_ratio") if n_targets else out


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def sweep_k(s1: DataFrame, candidates: DataFrame, links: DataFrame, ks: tuple[int, ...] = (5, 10, 15, 20, 25, 30)) -> DataFrame:
    """k, blocking_recall, avg_candidates, max_candidates for prefixes of candidates ranked once at the largest K."""
    cut = F.explode(F.array(*map(F.lit, ks))).alias("k")
    found = links.join(candidates, ["s1_id", "tgt_id"], "left").select("rk", cut)
    hits = found.groupBy("k").agg((F.count_if(F.col("rk") <= F.col("k")) / F.count(F.lit(1))).alias("blocking_recall"))
    counts = spine(s1, candidates).select("n_candidates", cut).select("k", F.least("n_candidates", "k").alias("n")).groupBy("k").agg(F.avg("n").alias("avg_candidates"), F.max("n").alias("max_candidates"))
    return counts.join(hits, "k", "left").select("k", F.coalesce("blocking_recall", F.lit(0.0)).alias("blocking_recall"), "avg_candidates", "max_candidates")


def recommended_k(sweep: DataFrame, least: float = 0.90) -> int | None:
    """The K with the fewest candidates whose recall is at least `least`."""
    row = sweep.where(F.col("blocking_recall") >= least).orderBy("avg_candidates", "k").first()
    return row.k if row else None
