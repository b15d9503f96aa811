"""Entry points: preparation (check, profile, split), training with validation, submission, experiments.

Each works on DataFrames of raw entities and a wide ground truth and returns DataFrames; `matching` holds what one profile
needs. Candidates are ranked once at the largest K and cached, as several consumers read them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import blocking, decision, model, profile_a, profile_b, profiler, split, validate
from tessera.sources import sinks, tables
from tessera.sources.schema import PREFIX


@dataclass(frozen=True)
class Profile:
    """How one profile normalises, finds candidates and describes pairs."""

    normalise: Callable[[DataFrame], DataFrame]
    candidates: Callable[..., DataFrame]
    features: Callable[[DataFrame], DataFrame]
    names: tuple[str, ...]
    settings: model.Settings
    thresholds: tuple[float, ...]


A = Profile(profile_a.normalise, blocking.candidates_a, profile_a.features, profile_a.FEATURES, model.PROFILE_A, decision.FINE)
B = Profile(profile_b.normalise, blocking.candidates_b, profile_b.features, profile_b.FEATURES, model.PROFILE_B, decision.between(0.01, 0.99, 100))


@dataclass
class Prepared:
    """Parts (s1_id, country, n_true, match_bucket, stratum, part), the findings of all checks, and the report."""

    parts: DataFrame
    issues: DataFrame
    report: str


@dataclass
class Trained:
    model: PipelineModel
    threshold: float
    macro_f05: float
    sweep: DataFrame
    scored: DataFrame
    blocking: DataFrame


def prepare(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame) -> Prepared:
    """Check all sources and links, profile them, split the reference records; stops on a finding that is no warning."""
    links, counts = tables.truth_links(truth), tables.truth_counts(truth)
    issues = validate.all_of(
        *(validate.check_source(df, PREFIX[name]) for name, df in (("s1", s1), ("s2", s2), ("s3", s3))),
        validate.check_links(links, truth, s1, s2, s3),
    ).cache()
    validate.raise_on(issues)
    every = validate.all_of(*(df.select("entity_id", "business_name", "business_address", "country").withColumn("source", F.lit(i)) for i, df in enumerate((s1, s2, s3), 1)))
    parts = split.split(counts.join(s1.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id"))
    return Prepared(parts, issues, profiler.report(every, truth, links))


def described(profile: Profile, s1: DataFrame, targets: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Candidates of normalised records, and their features; every candidate is described, none is left at 0."""
    candidates = profile.candidates(s1, targets, k).cache()
    pairs = profile.features(blocking.with_records(candidates, s1, targets))
    return candidates, pairs.select("s1_id", "tgt_id", *profile.names)


def train(profile: Profile, s1: DataFrame, targets: DataFrame, truth: DataFrame, parts: DataFrame, k: int = blocking.TOP_K, settings: model.Settings | None = None) -> Trained:
    """Fit on the training part, with the validation part for stopping; pick the threshold on all its candidates."""
    links = tables.truth_links(truth)
    s1, targets = profile.normalise(s1).cache(), profile.normalise(targets).cache()
    candidates, pairs = described(profile, s1, targets, k)
    pairs = split.labelled(pairs, links).join(parts.select("s1_id", "part"), "s1_id").cache()
    val = pairs.where("part = 'val'")
    fitted = model.fit(split.training_pairs(pairs.where("part = 'train'")).drop("part"), profile.names, settings or profile.settings, val.drop("part"))
    held = parts.where("part = 'val'").select("s1_id", "n_true")
    found = model.scored(fitted, val).cache()
    swept = decision.sweep(decision.by_threshold(held, links, found, profile.thresholds)).cache()
    threshold, score = decision.best_threshold(swept)
    recall = blocking.recall_all(s1.join(held.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi"), candidates, links.join(held.select("s1_id"), "s1_id", "left_semi"))
    return Trained(fitted, threshold, score, swept, found, recall)


def submit(profile: Profile, fitted: PipelineModel, threshold: float, s1: DataFrame, targets: DataFrame, k: int = blocking.TOP_K) -> tuple[DataFrame, DataFrame]:
    """Results files of test records: matching_results and candidate_pairs, checked before they are returned."""
    s1, targets = profile.normalise(s1).cache(), profile.normalise(targets).cache()
    candidates, pairs = described(profile, s1, targets, k)
    accepted = decision.accepted(model.scored(fitted, pairs), threshold).cache()
    spine = s1.select(F.col("entity_id").alias("s1_id"))
    validate.raise_on(validate.check_predictions(accepted, spine, candidates, s1))
    return sinks.match_lists(spine, accepted), sinks.candidate_lists(spine, candidates)


def write_submission(matching: DataFrame, candidates: DataFrame, folder: str) -> None:
    sinks.write_tsv(matching, f"{folder}/matching_results.tsv", files=1)
    sinks.write_tsv(candidates, f"{folder}/candidate_pairs.tsv", files=1)


def dry_run(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, targets: int = 25_000, most: int = 2_000, singletons: int = 200) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A sample for trying things out: the first targets of both sources, reference records linked to them, some singletons, and the links among them."""
    some = tables.limited(s2, targets).unionByName(tables.limited(s3, targets))
    links = tables.truth_links(truth).join(some.select(F.col("entity_id").alias("tgt_id")), "tgt_id", "left_semi")
    linked = links.select(F.col("s1_id").alias("entity_id")).distinct().withColumn("rank", F.lit(0))
    alone = tables.truth_counts(truth).where("n_true = 0").select(F.col("s1_id").alias("entity_id")).orderBy("entity_id").limit(singletons).withColumn("rank", F.lit(1))
    picked = linked.unionByName(alone).orderBy("rank", "entity_id").limit(most).select("entity_id")
    return s1.join(picked, "entity_id", "left_semi"), some, links.join(picked.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")


def sweep_blocking(profile: Profile, s1: DataFrame, targets: DataFrame, truth: DataFrame, ks: tuple[int, ...] = (5, 10, 15, 20, 25, 30)) -> tuple[DataFrame, int | None]:
    """The K sweep from one ranking at the largest K, and the recommended K."""
    s1, targets = profile.normalise(s1).cache(), profile.normalise(targets).cache()
    swept = blocking.sweep_k(s1, profile.candidates(s1, targets, max(ks)), tables.truth_links(truth), ks).cache()
    return swept, blocking.recommended_k(swept)
