"""Mixing sources to target weights by systematic sampling, in DataFrame operations only (operator 2).

Every document of a source is expected in the mix target/size times. Within its source the documents stand in a fixed
order; a document's copies are the integers that the running sum of expected copies, moved by one random offset per
source, crosses at it. The order goes by size class (the whole part of the root of the size) and then by a hash of
doc_id, so that small and large documents are taken alike and the words come near the target. The running sum needs no
sort of a whole source: classes get their place from a small table, and a class with many rows is split by prefixes of
the hash, so many that about `BLOCK_ROWS` rows are ranked together.

Cases: a null text has size 0; a source without words has target 0 and no copies; a null source is a source of its own,
the last one. Offsets and order come from `seed`, source and doc_id, so that reruns agree. Rows that repeat a doc_id are
taken as rows. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, stash, unused
from tessera.llm.exact_dedup import bounded

BLOCK_ROWS = 512
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
#: So many identifiers of the mix at most are broadcast.
EMIT_ROWS = 200_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """key, source_size, target for rows key, source, source_size: one row for each source, null last.

    Sources stand by code point and weigh `weights`, repeating. They share `share` times all sizes; no target is above
    `cap` times its source's size, and what is above goes to the others by weight until none is above.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filled = Window.orderBy("fills_at", "key").rowsBetween(Window.unboundedPreceding, -1)
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1)).withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    asked = (
        weighed.withColumn("fills_at", F.lit(cap) * F.col("source_size") / F.col("weight"))
        .withColumn("left", F.col("total") - F.coalesce(F.sum(F.lit(cap) * F.col("source_size")).over(filled), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0)))
        .withColumn("full", F.col("fills_at") * F.col("weight_left") <= F.col("left"))
    )
    level = (F.max("total").over(everything) - F.coalesce(F.sum(F.when(F.col("full"), F.lit(cap) * F.col("source_size"))).over(everything), F.lit(0))) / F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return asked.withColumn("level", level).select("key", "source_size", F.when(F.col("full"), (F.lit(cap) * F.col("source_size")).cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def unit(text: Column) -> Column:
    """A number from 0 to 1 for a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every row of `docs` (doc_id, source, text)."""
    sized = stash(
        docs.select("doc_id", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key"), "source", word_count(F.col("text")).alias("size"))
        .withColumn("class", F.floor(F.sqrt("size")))
        .withColumn("order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        .drop("text"),
        "sized",
    )
    classes = stash(sized.groupBy("key", "source", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "size-classes")
    asked = targets(classes.groupBy("key", "source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    before = Window.partitionBy("key").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    digits = F.greatest(F.lit(0), F.ceil(F.log(F.col("n") / BLOCK_ROWS) / F.log(F.lit(16.0)))).cast("int")
    placed = stash(
        classes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("digits", digits)
        .join(asked, "key")
        .select("key", "class", "start", "digits", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"), unit(F.concat(F.lit(seed), "key")).alias("offset")),
        "placed",
    )
    blocked = sized.join(bounded(placed.select("key", "class", "digits")), ["key", "class"]).withColumn("block", F.substring("order", F.lit(1), F.col("digits"))).drop("digits", "source")
    earlier = Window.partitionBy("key", "class").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocked.groupBy("key", "class", "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(placed.drop("digits"), ["key", "class"])
        .select("key", "class", "block", (F.col("start") + F.col("ahead")).alias("ahead"), "source_size", "target", "rate", "offset")
    )
    inside = Window.partitionBy("key", "class", "block").orderBy("order", "doc_id", "size")
    place = F.col("ahead") + F.col("rank")
    crossed = F.floor(place * F.col("rate") + F.col("offset")) - F.floor((place - 1) * F.col("rate") + F.col("offset"))
    ranked = blocked.withColumn("rank", F.row_number().over(inside)).join(blocks, ["key", "class", "block"]).withColumn("copies", crossed.cast("long"))
    return ranked.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(docs: DataFrame, **how) -> DataFrame:
    """The rows of the mix: each row of `docs` with all its columns as many times as it has copies.

    Rows are known by doc_id, and where one has rows of different sizes by doc_id and size; rows that repeat these each
    come as often as the first of them.
    """
    copies = stash(mix(docs, **how).groupBy("doc_id", "size").agg(F.max("copies").alias("copies")), "copies")
    of_id, of_size, times, nth = (unused(docs, f"mix_{c}") for c in ("id", "size", "copies", "nth"))
    wanted = copies.where("copies > 0").select(F.col("doc_id").alias(of_id), F.col("size").alias(of_size), F.col("copies").alias(times))
    same = F.col("doc_id").eqNullSafe(F.col(of_id))
    if not copies.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        same &= word_count(F.col("text")) == F.col(of_size)
    joined = docs.join(bounded(wanted, EMIT_ROWS), same)
    return joined.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).drop(of_id, of_size, times, nth)


#: The same mix in DuckDB, ranked by one sort.
ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS ord
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight
  FROM sized GROUP BY source),
filling AS (
  SELECT *, 2 * source_size / weight::DOUBLE AS fills_at, sum(source_size) OVER () * 1.5::DOUBLE AS total,
         sum(weight) OVER () AS weights FROM sources),
asked AS (
  SELECT *, total - coalesce(sum(2 * source_size) OVER f, 0) AS lft, weights - coalesce(sum(weight) OVER f, 0) AS wl
  FROM filling WINDOW f AS (ORDER BY fills_at, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (
  SELECT (max(total) - coalesce(sum(2 * source_size) FILTER (fills_at * wl <= lft), 0)) / sum(weight) FILTER (NOT fills_at * wl <= lft) AS lev FROM asked),
goal AS (
  SELECT source, source_size, CASE WHEN fills_at * wl <= lft THEN (2 * source_size)::DOUBLE ELSE lev * weight END AS target,
         ('0x' || substr(md5('mix' || coalesce('s' || source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM asked, lev),
placed AS (
  SELECT s.*, g.source_size, g.target, g.u, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY floor(sqrt(size)), ord, doc_id) AS k
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, ((floor(k * rate + u) - floor((k - 1) * rate + u))::BIGINT * size)::BIGINT AS taken
FROM placed
"""
