"""Sources: tab-separated and Parquet scans, ground truth, identifier lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.sources.schema import ENTITY, PREFIX, TRUTH, filled

FILES = {
    f"{part}_{source}": (f"{part}/{part}_source{source[1]}.tsv", PREFIX[source]) for part in ("train", "test") for source in ("s1", "s2", "s3")
}


def read_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All columns as text; an empty cell is an empty string, and `NA` stays `NA`."""
    return filled(spark.read.schema(schema).options(sep="\t", header=True, enforceSchema=False, emptyValue="", nullValue="\u0000", quote="").csv(path))


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Entities from Parquet, or from tab-separated text."""
    if path.rstrip("/").endswith(".parquet"):
        return filled(spark.read.parquet(path).select(*ENTITY.names))
    return read_tsv(spark, path, ENTITY)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, TRUTH)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id: one identifier a line."""
    return spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("entity_id"))


def first_column_ids(lines: DataFrame) -> DataFrame:
    """entity_id: the first field of each line (line, value) but the header; blank lines are skipped."""
    return lines.where("line > 1").where(F.trim("value") != "").select(F.split("value", "\t")[0].alias("entity_id")).distinct()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line (from 1), value: the lines of one text file but its empty ones, which are counted all the same.

    Lines are numbered within the blocks that the file is read in, and moved by the lines of the blocks before.
    """
    block = F.col("_metadata.file_block_start").alias("block")
    lines = spark.read.text(path, lineSep="\n").select("value", block, F.monotonically_increasing_id().alias("nth"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("block").orderBy("nth")
    ranked = lines.withColumn("nth", F.row_number().over(inside)).join(F.broadcast(counts), "block")
    return ranked.select((F.col("nth") + F.col("before")).alias("line"), F.regexp_replace("value", "\r$", "").alias("value")).where("value <> ''")


def numbered(df: DataFrame, *keys: str, column: str = "place") -> DataFrame:
    """`df` with `column`, each row's place from 1 in the order of `keys`: sorted by ranges, ranked within each, and moved by the rows before it.

    One number for each range is all that is gathered; no task sees more than a range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *keys).withColumns({"__part": F.spark_partition_id()})
    firsts = dealt.groupBy("__part").agg(F.min(F.struct(*keys)).alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).select("__part", "__before")
    inside = Window.partitionBy("__part").orderBy(*keys)
    ranked = dealt.withColumn(column, F.row_number().over(inside)).join(F.broadcast(firsts), "__part")
    return ranked.withColumn(column, F.col(column) + F.col("__before")).drop("__part", "__before")


def limited(df: DataFrame, n: int, key: str = "entity_id") -> DataFrame:
    """The first `n` rows by key; files alone have no order."""
    return df.orderBy(key).limit(n)


def among(df: DataFrame, ids: DataFrame, key: str = "entity_id") -> DataFrame:
    """The rows whose key is in `ids` (a column of the same name): a semi-join scan."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def parsed_ids(text: Column) -> Column:
    """The identifiers of a comma list: trimmed, without empty ones, each once."""
    return F.array_distinct(listed_ids(text))


def listed_ids(text: Column) -> Column:
    """The identifiers of a comma list with repeats."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != "")


def lenient_ids(text: Column) -> Column:
    """As parsed_ids, but the text `nan` is an empty list."""
    return F.when(F.trim(text).isin("", "nan"), F.array().cast("array<string>")).otherwise(parsed_ids(text))


def truth_links(truth: DataFrame) -> DataFrame:
    """s1_id, tgt_id: one row a link."""
    return truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode(parsed_ids(F.col("matched_entity_ids"))).alias("tgt_id"))


def truth_counts(truth: DataFrame) -> DataFrame:
    """s1_id, n_true: one row for each reference entity, singletons too."""
    return truth.select(F.col("source1_entity_id").alias("s1_id"), F.size(parsed_ids(F.col("matched_entity_ids"))).alias("n_true"))


def register(spark: SparkSession, root: str) -> list[str]:
    """Temporary views of all tables under a folder, and of the ground truth; their names."""
    for name, (path, _) in FILES.items():
        read_entities(spark, f"{root}/{path}").createOrReplaceTempView(name)
    read_truth(spark, f"{root}/train/train_ground_truth.tsv").createOrReplaceTempView("train_ground_truth")
    return [*FILES, "train_ground_truth"]
