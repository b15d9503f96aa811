"""Exact deduplication by a log-structured merge index of digests, in DataFrame operations only (operator 9).

Rows come in batches. A batch is a memtable: its digests are aggregated map-side (so a digest with a third of all rows
costs each task one row), sorted and flushed as one immutable run of (digest, smallest and largest identifier, count),
with a filter: a bitmap of `FILTER_BITS` bits for each digest, in blocks of 32,768 bits. The digests of a later batch
are first probed against the filters of the earlier runs; only those that a filter lets through are merge-joined with
that run. Two runs are compacted into one by a merge join, which keeps the smallest and largest identifiers and adds the
counts. Hits, the digests that came again in a batch or were found in an earlier run, are then verified by their bytes:
rows are grouped by digest and whole text, and a digest that stands for different texts is split.

`exact_classes` deals rows to `BATCHES` batches by a hash of doc_id; classes are read from the compacted run of all.

Cases: a null text counts as empty, so nulls and empty texts are one class. Rows that repeat an identifier and a text
count in group_size and share `kept`. A null identifier never wins over another; a class of nulls keeps them. Of equal
identifiers in a class every row is kept. An empty table gives no rows.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import scratch, stash, texts, unused

#: So many digests at most are broadcast (some 60 bytes each, and as much again while the driver builds the table, of
#: several tables at once); more are joined by a shuffle.
BROADCAST_ROWS = 50_000
#: Bits of a filter for each digest of its run, and blocks of 4 KB that are broadcast at most.
FILTER_BITS, BROADCAST_BLOCKS = 16, 2_000
#: Bits of a filter for each of many names, and blocks of 4 KB at most: with more names it lets more rows through, it is never left out.
NAMED_BITS, NAMED_BLOCKS = 32, 4_096
BATCHES = 2


def digest(text="text"):
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, broadcast if it is counted to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def matched(rows: DataFrame, named: DataFrame, how: str, /, safe: bool = False, **on: Column) -> DataFrame:
    """`rows` joined (inner, left_semi or left_anti) to `named`, by columns of it (`on`: their names, and what they equal in `rows`).

    Few names are broadcast. Of many a bitmap of hashes is, and only the rows that it lets through are shuffled: where
    rows hold whole texts, their shuffle would take as much disk as the table. safe: nulls are equal to each other.
    """
    same = reduce(Column.__and__, ((c.eqNullSafe(F.col(x)) if safe else c == F.col(x)) for x, c in on.items()))
    if named.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(named), same, how)
    named = stash(named if how == "inner" else named.select(*on).distinct(), "names")
    slots = min(NAMED_BITS * named.count(), NAMED_BLOCKS << 15)
    block, bit, of, bits, there = (unused(rows, c) for c in ("name_block", "name_bit", "name_of", "name_bits", "name_there"))
    slot = lambda columns: F.pmod(F.xxhash64(*columns), F.lit(slots))
    marks = named.select(F.bitmap_bucket_number(slot(on)).alias(of), F.bitmap_bit_position(slot(on)).alias(bit))
    marks = F.broadcast(stash(marks.groupBy(of).agg(F.bitmap_construct_agg(bit).alias(bits)), "name-bits"))
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (F.col(bit) % 8).cast("int")) == 1, F.lit(False))
    at = rows.withColumns({block: F.bitmap_bucket_number(slot(on.values())), bit: F.bitmap_bit_position(slot(on.values()))})
    at = at.join(marks, F.col(block) == F.col(of), "left" if how == "left_anti" else "inner")
    passed, rest = (at.where(x).select(*rows.columns) for x in (hit, ~hit))
    # the optimizer would move a semi or anti join below that with the bitmap, so that all rows were shuffled after all
    if how == "left_anti":
        return passed.join(named.withColumn(there, F.lit(True)), same, "left").where(F.col(there).isNull()).select(*rows.columns).unionByName(rest)
    return passed.join(named, same) if how == "inner" else passed.join(named, same).select(*rows.columns)


def spread(rows: DataFrame, table: DataFrame, key: str, size: str) -> DataFrame:
    """`rows` joined to `table`, which has one row for each `key`, with the number (`size`) of rows that have it.

    A small table is broadcast. Of a large one the keys with more than 1 / BROADCAST_ROWS of all rows are, which are
    fewer than BROADCAST_ROWS by that; the others meet in a shuffle, in which none is hot.
    """
    n, total = table.agg(F.count(F.lit(1)), F.sum(size)).first()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), key)
    hot = F.col(size) > F.lit(total // BROADCAST_ROWS + 1)
    cold = rows.join(F.broadcast(table.where(hot).select(key)), key, "left_anti").join(table.where(~hot), key)
    return rows.join(F.broadcast(table.where(hot)), key).unionByName(cold)


class Run:
    """digest, least, most, n: sorted by digest in every file, with a filter that is made when it is first asked."""

    def __init__(self, rows: DataFrame):
        self.rows = stash(rows.sortWithinPartitions("digest"), "run")

    @cached_property
    def slots(self) -> int:
        return max(1, FILTER_BITS * self.rows.count())

    @cached_property
    def filter(self) -> DataFrame:
        marked = self.rows.select(F.bitmap_bucket_number(self.slot()).alias("block"), F.bitmap_bit_position(self.slot()).alias("bit"))
        return stash(marked.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")), "filter")

    def slot(self) -> Column:
        """The place of a digest in the filter, from its first seven bytes."""
        return F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long") % F.lit(self.slots)

    def passed(self, digests: DataFrame) -> DataFrame:
        """Those of `digests` that the filter lets through."""
        at = digests.withColumns({"block": F.bitmap_bucket_number(self.slot()), "bit": F.bitmap_bit_position(self.slot())})
        byte = F.conv(F.hex(F.substring(F.col("bits"), (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held = at.join(bounded(self.filter, BROADCAST_BLOCKS), "block")
        return held.where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1).select("digest")


class DigestIndex:
    """Runs in the shared folder, oldest first; two of a size are compacted by whoever adds to it."""

    def __init__(self):
        self.runs: list[Run] = []

    def add(self, rows: DataFrame) -> DataFrame:
        """Flush a batch (digest, doc_id) as a run; the digests of it that came again in it or stand in earlier runs."""
        run = Run(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n")))
        hits = run.rows.where("n > 1").select("digest")
        for old in self.runs:
            maybe = bounded(stash(old.passed(run.rows.select("digest")), "maybe"))
            hits = hits.unionByName(old.rows.select("digest").join(maybe, "digest", "left_semi"))
        self.runs.append(run)
        return hits.distinct()

    def compact(self) -> None:
        """Merge the runs, two by two, into one."""
        while len(self.runs) > 1:
            a, b = (r.rows.select("digest", *(F.col(c).alias(f"{c}_{x}") for c in ("least", "most", "n"))) for x, r in zip("ab", self.runs[-2:]))
            merged = a.join(b, "digest", "full_outer")
            n = F.coalesce("n_a", F.lit(0)) + F.coalesce("n_b", F.lit(0))
            self.runs[-2:] = [Run(merged.select("digest", F.least("least_a", "least_b").alias("least"), F.greatest("most_a", "most_b").alias("most"), n.alias("n")))]


def verified(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """digest, text, least, most, n of every hit, with the text compared as bytes."""
    held = texts(docs).withColumn("digest", digest())
    return matched(held, hits.select(F.col("digest").alias("hit")), "left_semi", hit=F.col("digest")).groupBy("digest", "text").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n"))


def exact_classes(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest (binary) of every row; `keep`: which identifier of a class stays."""
    winner = {"smallest": "least", "largest": "most"}[keep]
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES)).cast("int").alias("batch")
    rows = stash(texts(docs).select(digest().alias("digest"), "doc_id", batch), "digests", by="batch")
    index = DigestIndex()
    hits = [index.add(rows.where(F.col("batch") == nth).select("digest", "doc_id")) for nth in range(BATCHES)]
    index.compact()
    rows, found = rows.select("digest", "doc_id"), stash(reduce(DataFrame.unionByName, hits).distinct(), "hits")
    classes = stash(index.runs[0].rows.join(bounded(found), "digest", "left_semi"), "classes")
    checked = stash(verified(docs, found).withColumn("text_hash", F.xxhash64("text")).drop("text"), "verified")
    split = checked.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")
    out = lambda rows: rows.select("doc_id", F.col(winner).alias("keep_id"), F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col(winner)).alias("kept"), "digest")
    alone = rows.join(bounded(found), "digest", "left_anti")
    alone = alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    if split.isEmpty():
        return alone.unionByName(out(spread(rows, classes, "digest", "n")))
    apart = texts(docs).select("doc_id", digest().alias("digest"), F.xxhash64("text").alias("text_hash")).join(split, "digest", "left_semi")
    return alone.unionByName(out(spread(rows.join(split, "digest", "left_anti"), classes, "digest", "n"))).unionByName(out(apart.join(checked, ["digest", "text_hash"])))


def own_digest():
    """The digest of the text of any row of documents, in which a null text counts as empty."""
    return F.coalesce(digest(), F.unhex(F.sha2(F.lit("").cast("binary"), 256)))


def drop_copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of `docs` that stay, with all their columns; of rows that repeat an identifier and a text, one.

    Rows are told apart by identifier (or none) and text: of a class without any identifier one row stays.
    """
    with scratch() as stays:
        found = stays(exact_classes(docs, keep).where("group_size > 1").select("doc_id", "kept", "digest"), "kept")
    of_id, of_digest = unused(docs, "found_id"), unused(docs, "found_digest")
    named = lambda rows: rows.select(F.col("doc_id").alias(of_id), F.col("digest").alias(of_digest))
    on = {of_id: F.col("doc_id"), of_digest: own_digest()}
    left = matched(docs, named(found.where(~F.col("kept"))).distinct(), "left_anti", safe=True, **on)
    again = stash(named(found.where("kept").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("times")).where("times > 1")), "again")
    if again.isEmpty():
        return left
    once = matched(left, again, "left_semi", safe=True, **on).withColumn(of_digest, own_digest()).dropDuplicates(["doc_id", of_digest]).drop(of_digest)
    return matched(left, again, "left_anti", safe=True, **on).unionByName(once)
