"""From probabilities to matches: thresholds, the macro F0.5 score, sweeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Thresholds of the four sweeps: start, stop, points.
COARSE = tuple(round(0.35 + 0.05 * i, 10) for i in range(11))
FINE = tuple(round(0.05 + 0.01 * i, 10) for i in range(91))
WEIGHTS_SWEEP = tuple(round(0.30 + 0.05 * i, 10) for i in range(13))


def between(low: float, high: float, points: int) -> tuple[float, ...]:
    """Evenly spaced thresholds, both ends included."""
    return tuple(low + (high - low) * i / (points - 1) for i in range(points))


#: Thresholds of the analysis.
ANALYSIS = between(0.05, 0.95, 90)


def f05(n_hit: Column, n_true: Column, n_pred: Column) -> Column:
    """F0.5 of one record: right in staying empty is 1, any prediction for a singleton is 0."""
    return F.when((n_true == 0) & (n_pred == 0), 1.0).when(n_hit == 0, 0.0).otherwise(1.25 * n_hit / (0.25 * n_true + n_pred))


def scored_records(truth_counts: DataFrame, links: DataFrame, predicted: DataFrame) -> DataFrame:
    """s1_id, n_true, n_pred, n_hit, f05 for every record of the truth; `predicted` (s1_id, tgt_id), none is empty."""
    told = predicted.select("s1_id", "tgt_id").distinct()
    marked = links.select("s1_id", "tgt_id").distinct().withColumn("hit", F.lit(1))
    counts = told.join(marked, ["s1_id", "tgt_id"], "left").groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_pred"), F.count("hit").alias("n_hit"))
    per = truth_counts.join(counts, "s1_id", "left").fillna(0, ["n_pred", "n_hit"])
    return per.withColumn("f05", f05(F.col("n_hit"), F.col("n_true"), F.col("n_pred")))


def macro_f05(records: DataFrame) -> DataFrame:
    """One row: the mean of scored_records(), of singletons and of others, how many are perfect and how many zero."""
    single = F.col("n_true") == 0
    return records.agg(
        F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"),
        F.coalesce(F.avg(F.when(single, F.col("f05"))), F.lit(0.0)).alias("singleton_f05"),
        F.coalesce(F.avg(F.when(~single, F.col("f05"))), F.lit(0.0)).alias("linked_f05"),
        F.count_if(F.col("f05") == 1.0).alias("n_perfect"),
        F.count_if(F.col("f05") == 0.0).alias("n_zero"),
    )


def predict(spine: DataFrame, scored: DataFrame, threshold: float) -> DataFrame:
    """s1_id, matches (sorted array) for every record of `spine` (s1_id); pairs at or above the threshold."""
    found = scored.where(F.col("proba") >= threshold).groupBy("s1_id").agg(F.array_sort(F.collect_set("tgt_id")).alias("matches"))
    return spine.select("s1_id").join(found, "s1_id", "left").withColumn("matches", F.coalesce("matches", F.array().cast("array<string>")))


def accepted(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.where(F.col("proba") >= threshold).select("s1_id", "tgt_id")


def by_threshold(truth_counts: DataFrame, links: DataFrame, scored: DataFrame, thresholds: tuple[float, ...] = COARSE) -> DataFrame:
    """threshold, s1_id, n_true, n_pred, n_hit, f05: pairs are counted once by the thresholds that they pass, then summed upwards.

    The thresholds are a fixed list; a pair gives one row, not one a threshold.
    """
    levels = F.array(*map(F.lit, thresholds))
    passed = F.size(F.filter(levels, lambda t: F.col("proba") >= t))
    marked = links.select("s1_id", "tgt_id").distinct().withColumn("hit", F.lit(1))
    pairs = scored.join(marked, ["s1_id", "tgt_id"], "left").select("s1_id", "hit", passed.alias("passed")).where("passed > 0")
    counts = pairs.groupBy("s1_id", "passed").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("h"))
    stairs = counts.groupBy("s1_id").agg(F.collect_list(F.struct("passed", "n", "h")).alias("stairs"))
    per = truth_counts.join(stairs, "s1_id", "left").select("s1_id", "n_true", "stairs", F.posexplode(levels).alias("nth", "threshold"))
    total = lambda field: F.coalesce(F.aggregate(F.filter("stairs", lambda x: x["passed"] > F.col("nth")), F.lit(0).cast("long"), lambda a, x: a + x[field]), F.lit(0))
    per = per.select("threshold", "s1_id", "n_true", total("n").alias("n_pred"), total("h").alias("n_hit"))
    return per.withColumn("f05", f05(F.col("n_hit"), F.col("n_true"), F.col("n_pred")))


def sweep(per: DataFrame) -> DataFrame:
    """threshold, macro_f05, singleton_pct (empty predictions), n_matches from by_threshold()."""
    return per.groupBy("threshold").agg(F.avg("f05").alias("macro_f05"), (100.0 * F.count_if(F.col("n_pred") == 0) / F.count(F.lit(1))).alias("singleton_pct"), F.sum("n_pred").alias("n_matches"))


def analysis(per: DataFrame) -> DataFrame:
    """threshold (3 places), and total F0.5, accuracy on singletons, F0.5 on others (4 places), predicted and wrong matches."""
    single = F.col("n_true") == 0
    mean = lambda here, value: F.round(F.coalesce(F.avg(F.when(here, value)), F.lit(0.0)), 4)
    return per.groupBy("threshold").agg(
        F.round(F.avg("f05"), 4).alias("total_f05"),
        mean(single, (F.col("n_pred") == 0).cast("double")).alias("singleton_acc"),
        mean(~single, F.col("f05")).alias("non_singleton_f05"),
        F.sum("n_pred").alias("total_predicted"),
        F.sum(F.col("n_pred") - F.col("n_hit")).alias("fp_count"),
    ).withColumn("threshold", F.round("threshold", 3))


def best_threshold(swept: DataFrame, score: str = "macro_f05") -> tuple[float, float]:
    """The threshold with the best score, the lowest of equals, and that score."""
    row = swept.orderBy(F.desc(F.round(score, 12)), "threshold").first()
    return row["threshold"], row[score]


def resolved(scored: DataFrame, threshold: float) -> DataFrame:
    """s1_id, tgt_id, proba: each target kept with its surest record only (an extra; off by default)."""
    best = scored.where(F.col("proba") >= threshold).groupBy("tgt_id").agg(F.max(F.struct("proba", "s1_id")).alias("best"))
    return best.select(F.col("best.s1_id").alias("s1_id"), "tgt_id", F.col("best.proba").alias("proba"))
