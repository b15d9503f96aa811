"""Profiling of sources and ground truth, each section one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.sinks import markdown

TEXT_FIELDS = ("business_name", "business_address", "country")


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(100.0 * part, whole), F.lit(0.0))


def blanks(entities: DataFrame) -> DataFrame:
    """source, n, and for each text field how many are blank, in number and percent."""
    n = F.count(F.lit(1))
    cols = [x for f in TEXT_FIELDS for x in (F.count_if(F.trim(f) == "").alias(f"blank_{f}"), percent(F.count_if(F.trim(f) == ""), n).alias(f"blank_{f}_pct"))]
    return entities.groupBy("source").agg(n.alias("n"), *cols)


def countries(entities: DataFrame) -> DataFrame:
    """source, country, n, pct of the source."""
    counts = entities.groupBy("source", "country").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("source").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "source").select("source", "country", "n", percent(F.col("n"), F.col("total")).alias("pct"))


def lengths(values: Column) -> list[Column]:
    quartile = F.percentile(values, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return [F.min(values).alias("least"), quartile[0].alias("p25"), quartile[1].alias("median"), quartile[2].alias("p75"), F.max(values).alias("most"), F.avg(values).alias("mean")]


def name_lengths(entities: DataFrame) -> DataFrame:
    """source, country: quartiles (linear), least, most and mean length of names."""
    return entities.groupBy("source", "country").agg(*lengths(F.length("business_name")))


def address_lengths(entities: DataFrame) -> DataFrame:
    """source, country: filled addresses, share of blank ones, and lengths of the filled ones."""
    filled = F.trim("business_address")
    size = F.when(filled != "", F.length(filled))
    n, blank = F.count(size), F.count_if(filled == "")
    return entities.groupBy("source", "country").agg(n.alias("n_filled"), percent(blank, F.count(F.lit(1))).alias("blank_pct"), *lengths(size))


def postcodes(entities: DataFrame) -> DataFrame:
    """source, country: addresses with a postcode in the country's form, and with any number."""
    form = F.when(F.col("country").isin("US", "France"), F.col("business_address").rlike(r"(?U)\b\d{5}\b")).when(F.col("country") == "India", F.col("business_address").rlike(r"(?U)\b\d{6}\b")).otherwise(F.col("business_address").rlike(r"(?U)\b\d{5,6}\b"))
    n, has, number = F.count(F.lit(1)), F.count_if(form), F.count_if(F.col("business_address").rlike(r"(?U)\d"))
    return entities.groupBy("source", "country").agg(n.alias("n"), has.alias("with_postcode"), percent(has, n).alias("postcode_pct"), number.alias("with_number"), percent(number, n).alias("number_pct"))


def comma_count(text: Column) -> Column:
    """Commas and one more; nothing for a blank text."""
    return F.when(F.trim(text) == "", 0).otherwise(F.regexp_count(text, F.lit(",")) + 1)


def match_histogram(truth: DataFrame, most: int = 8) -> DataFrame:
    """n_matches (the last stands for all from there on), n, pct."""
    counts = truth.groupBy(F.least(comma_count(F.col("matched_entity_ids")), F.lit(most)).alias("n_matches")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("n_matches", "n", percent(F.col("n"), F.col("total")).alias("pct"))


def match_averages(truth: DataFrame) -> DataFrame:
    n = comma_count(F.col("matched_entity_ids"))
    return truth.agg(F.avg(n).alias("avg_all"), F.coalesce(F.avg(F.when(n > 0, n)), F.lit(0.0)).alias("avg_linked"), F.max(n).alias("most"))


def match_sources(truth: DataFrame) -> DataFrame:
    """How many reference records are linked to source 2 alone, to 3 alone, to both, to none."""
    ids = F.col("matched_entity_ids")
    two, three = ids.contains("S2-"), ids.contains("S3-")
    return truth.agg(F.count_if(two & ~three).alias("s2_only"), F.count_if(three & ~two).alias("s3_only"), F.count_if(two & three).alias("both"), F.count_if(F.trim(ids) == "").alias("neither"))


def sharing(links: DataFrame) -> DataFrame:
    """One row on how target identifiers are shared between reference records."""
    per = links.groupBy("tgt_id").agg(F.count(F.lit(1)).alias("n"))
    of = lambda mark: F.col("tgt_id").startswith(mark)
    return per.agg(
        F.count(F.lit(1)).alias("unique_ids"),
        F.count_if(of("S2-")).alias("s2_unique"),
        F.coalesce(F.sum(F.when(of("S2-"), F.col("n"))), F.lit(0)).alias("s2_links"),
        F.count_if(of("S3-")).alias("s3_unique"),
        F.coalesce(F.sum(F.when(of("S3-"), F.col("n"))), F.lit(0)).alias("s3_links"),
        F.count_if(F.col("n") > 1).alias("shared_ids"),
        F.coalesce(F.max("n"), F.lit(0)).alias("most_shared"),
    )


def other_scripts(entities: DataFrame) -> DataFrame:
    """source, country: names with anything beyond ASCII."""
    n, has = F.count(F.lit(1)), F.count_if(F.col("business_name").rlike(r"[^\x00-\x7F]"))
    return entities.groupBy("source", "country").agg(has.alias("n"), percent(has, n).alias("pct"))


def report(entities: DataFrame, truth: DataFrame, links: DataFrame) -> str:
    """All sections as Markdown."""
    by = ("source", "country")
    sections = (
        ("Row counts and blank fields", blanks(entities).orderBy("source")),
        ("Countries", countries(entities).orderBy("source", F.desc("n"), "country")),
        ("Name lengths", name_lengths(entities).orderBy(*by)),
        ("Address lengths", address_lengths(entities).orderBy(*by)),
        ("Postcodes and numbers", postcodes(entities).orderBy(*by)),
        ("Matches of a reference record", match_histogram(truth).orderBy("n_matches")),
        ("Average matches", match_averages(truth)),
        ("Linked sources", match_sources(truth)),
        ("Shared targets", sharing(links)),
        ("Other scripts", other_scripts(entities).orderBy(*by)),
    )
    return "# Data profile\n\n" + "\n".join(markdown(f"{i}. {title}", table) for i, (title, table) in enumerate(sections, 1))
