"""Validation: each check gives rows (check, n, examples); a check without findings has n = 0 and no examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.schema import CANDIDATES, MATCHES, PREFIX
from tessera.sources.tables import listed_ids, parsed_ids, read_lines

EXAMPLES = 5
ISSUES = "check string, n bigint, examples array<string>"


def finding(name: str, rows: DataFrame, column: str, n: Column | None = None) -> DataFrame:
    """One row: how many rows (or the sum of `n`), and the smallest distinct values of a column."""
    smallest = F.slice(F.array_sort(F.collect_set("spot")), 1, EXAMPLES)
    few = rows.groupBy(column).agg((F.sum(n) if n is not None else F.count(F.lit(1))).alias("times")).withColumn("spot", F.col(column).cast("string"))
    # only the smallest values of each task meet in one place
    top = few.orderBy("spot").limit(EXAMPLES).agg(smallest.alias("examples"))
    total = few.agg(F.coalesce(F.sum("times"), F.lit(0)).cast("bigint").alias("n"))
    return total.join(F.broadcast(top)).select(F.lit(name).alias("check"), "n", "examples")


def all_of(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def columns_differ(df: DataFrame, expected: tuple[str, ...] | list[str]) -> list[str]:
    """Columns that only one of both has."""
    return sorted(set(df.columns) ^ set(expected))


def empty_keys(df: DataFrame, key: str = "entity_id") -> DataFrame:
    return finding("empty_key", df.where(F.trim(F.coalesce(key, F.lit(""))) == ""), key)


def wrong_prefix(df: DataFrame, prefix: str, key: str = "entity_id") -> DataFrame:
    return finding("wrong_prefix", df.where(~F.col(key).startswith(prefix)), key)


def duplicate_keys(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """n counts the rows beyond the first of each key."""
    again = df.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("extra")).where("extra > 0")
    return finding("duplicate_key", again, key, F.col("extra"))


def missing_reference(name: str, rows: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Values of `key` that `other` doesn't have."""
    there = other.select(F.col(other_key).alias(key)).distinct()
    return finding(name, rows.join(there, key, "left_anti"), key)


def check_source(df: DataFrame, prefix: str) -> DataFrame:
    """The checks on one source."""
    return all_of(empty_keys(df), wrong_prefix(df, prefix), duplicate_keys(df))


def check_links(links: DataFrame, truth: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """The checks between ground truth and sources; records without truth are a warning."""
    is_2, is_3 = (F.col("tgt_id").startswith(PREFIX[s]) for s in ("s2", "s3"))
    return all_of(
        missing_reference("truth_s1_unknown", truth.select(F.col("source1_entity_id").alias("s1_id")), "s1_id", s1, "entity_id"),
        finding("link_prefix", links.where(~(is_2 | is_3)), "tgt_id"),
        missing_reference("link_s2_unknown", links.where(is_2), "tgt_id", s2, "entity_id"),
        missing_reference("link_s3_unknown", links.where(is_3), "tgt_id", s3, "entity_id"),
        missing_reference("warning_s1_without_truth", s1.select("entity_id"), "entity_id", truth, "source1_entity_id"),
    )


def check_merge(before: DataFrame, merged: DataFrame) -> DataFrame:
    """After a merge: rows gained or lost, and rows without a country."""
    sizes = before.agg(F.count(F.lit(1)).alias("a")).join(merged.agg(F.count(F.lit(1)).alias("b")))
    changed = sizes.select(F.lit("row_count_changed").alias("check"), F.abs(F.col("b") - F.col("a")).alias("n"), F.array().cast("array<string>").alias("examples"))
    return changed.unionByName(finding("missing_country", merged.where(F.col("country").isNull()), "source1_entity_id"))


def check_split(train: DataFrame, val: DataFrame, every: DataFrame) -> DataFrame:
    """entity_id of both parts: no overlap, nothing missing, no duplicates, right prefix."""
    both = train.select("entity_id").unionByName(val.select("entity_id"))
    return all_of(
        finding("in_both_parts", train.select("entity_id").intersect(val.select("entity_id")), "entity_id"),
        finding("in_no_part", every.select("entity_id").exceptAll(both.distinct()), "entity_id"),
        duplicate_keys(both),
        wrong_prefix(both, PREFIX["s1"]),
    )


def check_predictions(pairs: DataFrame, predictions: DataFrame, candidates: DataFrame, s1: DataFrame) -> DataFrame:
    """Before writing. pairs: (s1_id, tgt_id) as predicted; predictions: one row for each s1_id."""
    return all_of(
        missing_reference("s1_not_predicted", s1.select(F.col("entity_id").alias("s1_id")), "s1_id", predictions, "s1_id"),
        finding("predicted_s1_id", pairs.where(F.col("tgt_id").startswith(PREFIX["s1"])), "tgt_id"),
        finding("predicted_twice", pairs.groupBy("s1_id", "tgt_id").count().where("count > 1"), "s1_id"),
        finding("not_a_candidate", pairs.join(candidates.select("s1_id", "tgt_id").distinct(), ["s1_id", "tgt_id"], "left_anti"), "s1_id"),
    )


def raise_on(issues: DataFrame) -> None:
    """Stop on any finding that isn't a warning."""
    bad = issues.where(F.col("n") > 0).where(~F.col("check").startswith("warning")).collect()
    if bad:
        raise ValueError("; ".join(f"{r.check}: {r.n}, such as {', '.join(r.examples)}" for r in bad))


def rows_of_lines(lines: DataFrame) -> DataFrame:
    """line, s1_id, rest, tab of the lines (line, value) behind the header."""
    tab = F.instr("value", "\t")
    return lines.where("line > 1").select("line", "value", (tab > 0).alias("tab"), F.when(tab > 0, F.substring_index("value", "\t", 1)).otherwise(F.col("value")).alias("s1_id"), F.when(tab > 0, F.substring("value", tab + 1, F.length("value"))).otherwise("").alias("rest"))


def check_list_lines(lines: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The checks on one results file, given as lines (line, value), against the ids that it has to hold (entity_id)."""
    rows = rows_of_lines(lines)
    good = rows.where("tab")
    ids = F.when(F.trim("rest") == "", F.array().cast("array<string>")).otherwise(F.split("rest", ","))
    listed = good.select("s1_id", F.explode(ids).alias("tgt_id")).distinct()
    own, right = F.col("tgt_id").startswith(PREFIX["s1"]), F.col("tgt_id").startswith(PREFIX["s2"]) | F.col("tgt_id").startswith(PREFIX["s3"])
    parts = [
        finding("no_tab", rows.where(~F.col("tab") & (F.trim("value") != "")), "line"),
        finding("duplicate_row", good.groupBy("s1_id").count().where("count > 1"), "s1_id"),
        finding("repeated_id", good.where(F.size(ids) > F.size(F.array_distinct(ids))).select("s1_id").distinct(), "s1_id"),
        finding("self_match", listed.where(own).select("tgt_id").distinct(), "tgt_id"),
        finding("wrong_prefix", listed.where(~own & ~right).select("tgt_id").distinct(), "tgt_id"),
        finding("missing_row", required.select(F.col("entity_id").alias("s1_id")).distinct().join(good.select("s1_id"), "s1_id", "left_anti"), "s1_id"),
        finding("unexpected_row", good.select("s1_id").distinct().join(required.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_anti"), "s1_id"),
    ]
    if known is not None:
        parts.append(finding("unknown_id", listed.where(right).select("tgt_id").distinct().join(known.select(F.col("entity_id").alias("tgt_id")), "tgt_id", "left_anti"), "tgt_id"))
    return all_of(*parts)


def check_file(spark: SparkSession, path: str, expected: list[str], required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The checks on one results file, its header first; a broken header ends them."""
    fatal = lambda name, example: spark.createDataFrame([(name, 1, [example])], ISSUES)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return fatal("file_not_found", path)
    lines = read_lines(spark, path)
    header = lines.where("line = 1").first()
    if header is None:
        return fatal("file_empty", path)
    if "\t" not in header.value and "," in header.value:
        return fatal("comma_separated", header.value)
    if [c.strip().lower() for c in header.value.split("\t")] != expected:
        return fatal("header", header.value)
    return check_list_lines(lines, required, known)


def check_submission(spark: SparkSession, matching: str, candidate: str | None, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Both files, and matches that are no candidates as a warning; without a candidate file only a warning."""
    label = lambda df, name: df.withColumn("check", F.concat(F.lit(f"{name}:"), "check"))
    parts = [label(check_file(spark, matching, MATCHES.names, required, known), "matching")]
    if candidate:
        second = check_file(spark, candidate, CANDIDATES.names, required, known)
        fatal = second.where(F.col("check") == "file_not_found")
        parts.append(label(second.where(F.col("check") != "file_not_found"), "candidate").unionByName(label(fatal, "warning:candidate")))
        if fatal.isEmpty() and not parts[0].where(F.col("check").isin("matching:file_not_found", "matching:file_empty", "matching:comma_separated", "matching:header")).count():
            pairs = [rows_of_lines(read_lines(spark, p)).where("tab").select("s1_id", F.explode(parsed_ids(F.col("rest"))).alias("tgt_id")) for p in (matching, candidate)]
            parts.append(finding("warning:not_a_candidate", pairs[0].join(pairs[1], ["s1_id", "tgt_id"], "left_anti").select("s1_id").distinct(), "s1_id"))
    return all_of(*parts)


def is_valid(issues: DataFrame) -> bool:
    return issues.where((F.col("n") > 0) & ~F.col("check").startswith("warning")).isEmpty()


def safe_count(text: Column) -> Column:
    """Identifiers of a comma list with repeats, empty ones left out."""
    return F.size(listed_ids(text))
