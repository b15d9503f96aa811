"""Near-duplicate detection with HyperMinHash sketches (operator 7).

Each text's shingle hashes are dealt over `REGISTERS` buckets; a bucket's register holds the leading zeros of its least
value and the ten bits after the leading one. Texts with one and the same set are one class, and only its first document
goes on. Bands of registers put likely neighbours into one bucket. Within a bucket of up to `CROWDED` documents all pairs
go through the collision-corrected estimate and then through the full sets. A larger bucket, or one with more than
`DENSE` pairs a document that are near by the estimate, is compared with a leader,
the document that stands in the most crowded buckets, in a few rounds; a pair of its other documents can then only be
linked if the two differ from the leader in the same shingles, by a number that follows from their sizes. So such pairs
are found by a prefix-filtered join on those differences, which is exact, and no bucket is ever expanded into all pairs.
Such pairs, too, go through the estimate before their sets are fetched. Links are confirmed on full sets, those of a class
as well: its documents' sets are compared whole, and if two differ (a collision of 128 bits) all its documents go on by
themselves. Components are the least doc_id reachable.

Hot keys: a crowded band, a leader with many documents and the hub of a component each stand in a join between two plain
shuffles of written tables, which adaptive execution splits where one partition is skewed; what is counted or picked by
such a key is aggregated map-side and written first, so that no aggregate holds the join to its key's partition.

With 125 registers in bands of five, two documents at a similarity of 0.85 share no band once in two million; with bands
of four at 0.8, once in ten million. What is estimated only drops a pair that lies 0.2 (more than five standard errors)
below the threshold.

Cases: null and empty texts and those of white space have the empty set and are linked with nothing; rows that repeat a
doc_id and a text each give a row, linked with their like; a null doc_id is not linked. Identifiers that are no whole
numbers are numbered in their order and given back. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tessera.llm.common import arrow_batches, scratch, stash, texts, tidied, unused
from tessera.llm.components import components
from tessera.llm.exact_dedup import BROADCAST_ROWS, bounded, matched, own_digest, spread
from tessera.llm.shingles import ODD, mixed, shingle_set

REGISTERS = 128
MANTISSA = 10
EMPTY = 0xFFFF
SMALL = 16
#: Buckets up to CROWDED documents are compared by estimates, unless more than DENSE pairs a document are near.
CROWDED, DENSE = 1_000, 8
#: Rows of buckets that are shuffled with their sketches at once, for each document, and at least; rows that Python takes at once.
SLICE, SLICE_ROWS, BUCKET_ROWS = 2, 1_000_000, 4_096
ROUNDS = 2
SLACK = 0.2
#: Shingles by which more documents than this differ from one leader come last, told apart no further.
HOT_ELEMENT = 100_000


def sketch(hashes: np.ndarray) -> np.ndarray:
    """A register of 16 bits per bucket: leading zeros, then the bits after the leading one."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    values = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    np.minimum.at(least, (hashes >> np.uint64(57)).astype(np.int64), values)
    held = np.bincount((hashes >> np.uint64(57)).astype(np.int64), minlength=REGISTERS) > 0
    # the place of the leading one, by halves; exact where a float's logarithm is not
    rest, zeros = least.copy(), np.zeros(REGISTERS, np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        low = rest < np.uint64(1) << np.uint64(64 - step)
        zeros[low] += np.uint64(step)
        rest[low] <<= np.uint64(step)
    bits = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return np.where(held, np.minimum(zeros, np.uint64(62)) << np.uint64(MANTISSA) | bits, np.uint64(EMPTY)).astype("<u2")


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity of rows of registers, less the registers expected to be equal by chance."""
    some = ((a != EMPTY) | (b != EMPTY)).sum(axis=1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=1)
    full = ((a != EMPTY) & (b != EMPTY)).sum(axis=1)
    chance = 0.1699 * full / (1 << MANTISSA) * 4.0 * n * m / np.maximum(1, n + m) ** 2
    return np.maximum(0, equal - chance) / np.maximum(1, some)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null if empty), sketch of every whole text."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, prints = [], [], []
            for t in b.column("text"):
                s = shingle_set(t.as_py(), k)
                counts.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                prints.append(sketch(s).tobytes() if len(s) else None)
            yield pa.record_batch([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(prints, pa.binary())], ["doc_id", "n_shingles", "digest", "sketch"])

    return texts(docs).mapInArrow(tidied(run), "doc_id long, n_shingles long, digest binary, sketch binary")


def banded(firsts: DataFrame, rows: int) -> DataFrame:
    """key, id: one row for each band of registers that isn't all empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_numpy()
            held = np.frombuffer(b"".join(b.column("sketch").to_pylist()), "<u2").reshape(-1, REGISTERS)
            keys, owners = [], []
            for band in range(REGISTERS // rows):
                part = held[:, band * rows : (band + 1) * rows]
                some = (part != EMPTY).any(axis=1)
                total = np.full(int(some.sum()), band + 1, np.uint64) * np.uint64(0x2545F4914F6CDD1D)
                for j in range(rows):
                    total = mixed(total + part[some, j].astype(np.uint64) * ODD[j])
                keys.append(total.view(np.int64))
                owners.append(ids[some])
            yield pa.record_batch([pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], ["key", "id"])

    return firsts.select("id", "sketch").mapInArrow(tidied(run), "key long, id long")


def plausible(pairs: DataFrame, firsts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of documents (id, sketch, n) whose estimate is at least `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("sketch_a", "sketch_b")]
            n, m = (b.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            near = pa.array(estimate(*held, n, m) >= least)
            yield pa.record_batch([b.column("a").filter(near), b.column("b").filter(near)], ["a", "b"])

    side = lambda x: firsts.select(F.col("id").alias(x), F.col("sketch").alias(f"sketch_{x}"), F.col("n").alias(f"n_{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(tidied(run), "a long, b long")


def near_in_buckets(keys: np.ndarray, ids: np.ndarray, n: np.ndarray, prints: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of whole buckets, rows of one key in a row: a, b of the pairs whose estimate is at least `least`, and the keys of buckets with too many such pairs."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    group, at, found, by = np.cumsum(new) - 1, np.arange(len(keys)), [], 1
    while len(at := at[at + by < len(keys)]) and len(at := at[group[at] == group[at + by]]):
        for part in np.array_split(at, -(-len(at) // BUCKET_ROWS)):
            near = part[estimate(prints[part], prints[part + by], n[part], n[part + by]) >= least]
            found.append((near, near + by))
        by += 1
    one, other = (np.concatenate(x) for x in zip(*found)) if found else (at, at)
    dense = np.bincount(group[one], minlength=group[-1] + 1 if len(keys) else 0) > DENSE * np.bincount(group)
    few = ~dense[group[one]]
    a, b = ids[one[few]], ids[other[few]]
    return np.minimum(a, b), np.maximum(a, b), keys[new][dense]


def near_pairs(buckets: DataFrame, firsts: DataFrame, least: float) -> DataFrame:
    """key, a, b: pairs of documents (id, sketch, n) in one bucket (key, id) whose estimate is at least `least`, without key; keys of dense buckets, without a pair.

    Sketches go to the buckets, not to pairs, and pairs become rows only if they are near. Buckets are taken in slices,
    so that the sketches on disk at one time follow the documents, not the buckets.
    """
    fields = pa.schema([(c, pa.int64()) for c in ("key", "a", "b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, REGISTERS), "<u2")]
        more, size = [held], 0
        for b in itertools.chain(batches, [None]):
            if b is not None:
                more.append([b.column("key").to_numpy(), b.column("id").to_numpy(), b.column("n").to_numpy().astype(float), np.frombuffer(b"".join(b.column("sketch").to_pylist()), "<u2").reshape(-1, REGISTERS)])
                size += len(b)
                if size < BUCKET_ROWS:
                    continue
            held = [np.concatenate(x) for x in zip(*more)]
            end = len(held[0]) if b is None else int(np.searchsorted(held[0], held[0][-1]))  # the last bucket may go on
            one, other, dense = near_in_buckets(*(x[:end] for x in held), least)
            more, size = [[x[end:] for x in held]], 0
            for columns in ((None, one, other), (dense, None, None)):
                rows = len(next(x for x in columns if x is not None))
                if rows:
                    yield pa.record_batch([pa.nulls(rows, pa.int64()) if x is None else pa.array(x, pa.int64()) for x in columns], fields)

    slices = -(-buckets.count() // max(SLICE_ROWS, SLICE * firsts.count())) or 1
    tasks = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = []
    for nth in range(slices):
        rows = buckets.where(F.pmod(F.xxhash64("key"), F.lit(slices)) == nth).join(firsts, "id").select("key", "id", "n", "sketch")
        rows = rows.repartition(tasks, "key").sortWithinPartitions("key")
        found.append(stash(rows.mapInArrow(tidied(run), "key long, a long, b long"), "near"))
    return union(found)


def sets_of(docs: DataFrame, named: DataFrame, k: int) -> DataFrame:
    """doc_id, held (the sorted hashes of the set as bytes) of the documents of `named`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), k).tobytes() for t in b.column("text")]
            yield pa.record_batch([b.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "held"])

    return matched(texts(docs), named, "left_semi", named=F.col("doc_id")).mapInArrow(tidied(run), "doc_id long, held binary")


def unlike(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """digest: the classes of `members` (doc_id, digest; each pair once) whose sets, compared whole, are not one and the same."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), k).tobytes() for t in b.column("text")]
            yield pa.record_batch([b.column("digest"), pa.array(sets, pa.binary())], ["digest", "held"])

    of = members.select(F.col("doc_id").alias("named"), "digest")
    held = matched(texts(docs), of, "inner", named=F.col("doc_id")).select("digest", "text").mapInArrow(tidied(run), "digest binary, held binary")
    # equal sets of a class are made one before the shuffle, so a class with a third of all rows costs each task one set
    return held.distinct().groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")


def ends(pairs: DataFrame) -> DataFrame:
    """named: the documents of `pairs` for a semi-join; each once, unless they are so few that they are broadcast."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("named"))
    return named if 2 * pairs.limit(BROADCAST_ROWS).count() <= BROADCAST_ROWS else stash(named.distinct(), "named")


def compared(pairs: DataFrame, docs: DataFrame, k: int, differences: bool = False) -> DataFrame:
    """a, b, n_a, n_b, shared of pairs (a, b) on their full sets; differences: also the hashes that only one of them has."""
    arrow_batches(docs.sparkSession)
    named = ends(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m, shared, rest = [], [], [], []
            for x, y in zip(b.column("held_a"), b.column("held_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                same = both[1:] == both[:-1]
                n.append(len(x)), m.append(len(y)), shared.append(int(same.sum()))
                if differences:
                    alone = np.ones(len(both), bool)
                    alone[1:] &= ~same
                    alone[:-1] &= ~same
                    rest.append(both[alone].view(np.int64))
            columns = {"a": b.column("a"), "b": b.column("b"), "n_a": pa.array(n, pa.int64()), "n_b": pa.array(m, pa.int64()), "shared": pa.array(shared, pa.int64())}
            if differences:
                columns["rest"] = pa.array(rest, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    held = stash(sets_of(docs, named, k).dropDuplicates(["doc_id"]), "sets")
    side = lambda x: held.select(F.col("doc_id").alias(x), F.col("held").alias(f"held_{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(tidied(run), "a long, b long, n_a long, n_b long, shared long" + ", rest array<long>" * differences)


def linked(percent: int):
    """Of compared pairs: similar enough."""
    return 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))


def led(crowded: DataFrame, firsts: DataFrame, docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Documents of large buckets (key, id, score) against leaders: the first round with differences, and all links.

    Rounds after the first gather what the first leader left in large groups of its own; only pairs whose estimate
    reaches the threshold are compared there, as what they miss is found by differences all the same.
    """
    left, first, links = crowded, None, []
    for turn in range(ROUNDS):
        best = left.groupBy("key").agg(F.max(F.struct("score", (-F.col("id")).alias("minus"))).alias("best"), F.count(F.lit(1)).alias("n"))
        best = stash(best.where(F.col("n") > (1 if not turn else SMALL)).select("key", (-F.col("best.minus")).alias("a")), "best")
        star = stash(left.join(best, "key").where("id <> a").select("key", "a", F.col("id").alias("b"), "score"), "star")
        pairs = star.select("a", "b").distinct()
        pairs = stash(plausible(pairs, firsts, percent / 100) if turn else pairs, "starred")
        with scratch() as keep:
            found = keep(compared(pairs, docs, k, not turn).withColumn("linked", linked(percent)), "led")
        first = found if first is None else first
        links.append(found.where("linked").select("a", "b"))
        left = stash(star.join(found.where("linked").select("a", "b"), ["a", "b"], "left_anti").select("key", F.col("b").alias("id"), "score"), "left")
        if turn + 1 == ROUNDS or left.isEmpty():
            return first, links


def elements(first: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """The elements by which documents that were compared with one leader differ from it, where differing_alike() may find any alike.

    For documents i, j that lack d and add e shingles against a leader of c: with w = 100 d + percent e and s shingles
    that both lack or both add, i and j are linked iff (100 - percent) c + (100 + percent) s >= w_i + w_j. Those linked
    to the leader have w <= (100 - percent) c and are in one component, so at least one, i, has more. It follows
    s > w_j / (100 + percent) for the other, and for i either the same or, as w_j >= percent s, s >= (w_i - (100 - percent) c) / 100.
    In any one order a pair with s common elements of n shares one of the first n - s + 1 of each, and of the first that
    they share both have at least s - 1 more behind it.
    """
    c, n, s = F.col("n_a"), F.col("n_b"), F.col("shared")
    w = 100 * (c - s) + percent * (n - s)
    over = w - (100 - percent) * c
    among = F.ceil((w + 1) / (100 + percent))
    need = F.when(F.col("linked"), among).otherwise(F.greatest(F.lit(1), F.least(among, F.ceil(over / 100))))
    # leaders with several documents, not all linked, not all of one component; on narrow rows, as a leader may have very many
    narrow = first.select("a", "b", "linked").join(joined.select(F.col("id").alias("b"), "component"), "b", "left").withColumn("component", F.coalesce("component", "b"))
    open_ = narrow.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("linked").alias("all_linked"), F.min("component").alias("low"), F.max("component").alias("high"))
    narrow = stash(narrow.drop("linked").join(open_.where("n > 1 and not all_linked and low < high").select("a"), "a", "left_semi"), "open")
    pairs = first.join(narrow, ["a", "b"]).withColumns({"width": F.size("rest") - need + 1, "w": w, "allowed": (100 - percent) * c}).where("width > 0")
    return pairs.select("a", "b", "linked", "component", "width", "w", "allowed", F.size("rest").alias("size"), F.explode("rest").alias("element"))


def differing_alike(every: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of documents that were compared with one leader and may be linked with each other, by their elements()."""
    # most elements are one document's own: they go by 32 bits of a hash, as to count them all would shuffle more than they take
    slot = lambda: F.hash("a", "element")
    again = stash(every.groupBy(slot().alias("slot")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("slot"), "slots")
    sized = stash(matched(every, again, "left_semi", slot=slot()), "again")
    # in order: first what can find nothing (one document's own, or shared by linked ones or one component only), then the rarest.
    # Counted in an aggregate of narrow rows; only elements that can find something are shuffled whole, as most are one document's own
    counts = sized.groupBy(F.col("a").alias("of_a"), F.col("element").alias("of_element")).agg(F.least(F.count(F.lit(1)), F.lit(HOT_ELEMENT + 1)).alias("times"), F.min("component").alias("low"), F.max("component").alias("high"), F.min("linked").alias("all_linked"))
    finds = stash(counts.where("low < high and not all_linked").select("of_a", "of_element", "times"), "finds")
    own = Window.partitionBy("a", "b")
    found = matched(sized, finds, "inner", of_a=F.col("a"), of_element=F.col("element"))
    place = F.col("size") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("times", "element"))
    prefix = found.withColumn("place", place).where("place <= width")
    prefix = stash(prefix.select("a", "element", "b", "linked", "component", "w", "allowed", (F.col("size") - F.col("place") + 1).alias("ahead")), "prefixes")
    loose = prefix.where("not linked").select("a", "element", F.col("b").alias("i"), F.col("component").alias("component_i"), F.col("w").alias("w_i"), F.col("ahead").alias("ahead_i"))
    enough = (100 + percent) * F.least("ahead", "ahead_i") >= F.col("w") + F.col("w_i") - F.col("allowed")
    pairs = loose.join(prefix, ["a", "element"]).where("component <> component_i and (linked or i < b)").where(enough)
    return pairs.select(F.least("i", "b").alias("a"), F.greatest("i", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of `docs`."""
    kind = docs.schema["doc_id"].dataType
    if isinstance(kind, IntegralType):
        found = linked_rows(docs.select(F.col("doc_id").cast("long"), "text"), k, percent)
        return found.withColumns({c: F.col(c).cast(kind) for c in ("doc_id", "component_id")})
    ids = docs.where("doc_id is not null").select(F.col("doc_id").alias("of")).distinct()
    ids = stash(stash(ids, "ids").orderBy("of").rdd.zipWithIndex().map(lambda x: (x[0][0], x[1])).toDF(f"of {kind.simpleString()}, number long"), "numbered")
    rows = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("of"), "left").select(F.col("number").alias("doc_id"), "text")
    found = linked_rows(stash(rows, "by-number"), k, percent)
    named = lambda c: ids.select(F.col("of").alias(f"{c}_of"), F.col("number").alias(c))
    found = found.join(named("doc_id"), "doc_id", "left").join(named("component_id"), "component_id", "left")
    return found.select(F.col("doc_id_of").alias("doc_id"), "n_shingles", F.col("component_id_of").alias("component_id"), "kept")


def linked_rows(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """near_duplicates() of rows doc_id (long), text."""
    rows = 5 if percent >= 85 else 4
    least = percent / 100 - SLACK
    with scratch() as keep:
        sets = stash(sketches(docs, k), "sketches")
        some = sets.where("digest is not null and doc_id is not null")
        classes = stash(some.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size")), "classes")
        several = bounded(classes.where("size > 1").select("digest"))
        alike = stash(some.join(several, "digest", "left_semi").select("doc_id", "digest").distinct(), "alike")
        apart = stash(unlike(docs, alike, k), "unlike")
        if not apart.isEmpty():
            classes = stash(classes.join(apart, "digest", "left_anti"), "classes")
        lone = matched(sets, classes.where("size > 1").select(F.col("digest").alias("of")), "left_anti", of=F.col("digest"))
        lone = lone.select("digest", *(c for c in sets.columns if c != "digest")).withColumn("first", F.col("doc_id"))
        every = lone.unionByName(spread(sets, classes.where("size > 1"), "digest", "size").select(*lone.columns))
        members = keep(every.select("doc_id", "n_shingles", "first"), "members")
        firsts = every.where(F.col("digest").isNotNull() & (F.col("doc_id") == F.col("first"))).select(F.col("doc_id").alias("id"), "sketch", F.col("n_shingles").alias("n"))
        firsts = keep(firsts.dropDuplicates(["id"]), "firsts")
    with scratch() as keep:
        bands = stash(banded(firsts, rows), "bands")
        sizes = stash(bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
        shared = keep(bands.join(sizes, "key"), "buckets")
    with scratch() as keep:
        near = near_pairs(shared.where(f"size <= {CROWDED}").select("key", "id"), firsts, least)
        likely = keep(near.where("key is null").select("a", "b").distinct(), "likely")
        dense = keep(near.where("key is not null").select("key"), "dense")
    with scratch() as keep:
        links = [keep(compared(likely, docs, k).where(linked(percent)).select("a", "b"), "linked")]
    many = shared.where(f"size > {CROWDED}").unionByName(shared.join(dense, "key", "left_semi").select(*shared.columns))
    if not many.isEmpty():
        with scratch() as keep:
            scores = stash(many.groupBy("id").agg(F.sum("size").alias("score")), "scores")
            first, more = led(stash(many.join(scores, "id").select("key", "id", "score"), "crowded"), firsts, docs, k, percent)
            joined = keep(components(stash(union([*links, *more]), "led-links")), "joined")
            rest = keep(elements(first, joined, percent), "elements")
        with scratch() as keep:
            rest = stash(plausible(stash(differing_alike(rest, percent), "alike"), firsts, least), "rest")
            extra = keep(compared(rest, docs, k).where(linked(percent)).select("a", "b"), "extra")
        links = [joined.where("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b")), extra]
    found = components(stash(union(links), "all-links"))
    out = members.join(found, F.col("first") == F.col("id"), "left").withColumn("component_id", F.coalesce("component", "first"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, digest, number: every identifier and text once, numbered in this order, rows without an identifier last."""
    pairs = docs.select("doc_id", own_digest().alias("digest")).distinct().orderBy(F.col("doc_id").asc_nulls_last(), "digest")
    pairs = stash(pairs, "ordered").orderBy(F.col("doc_id").asc_nulls_last(), "digest")
    kind = pairs.schema["doc_id"].dataType.simpleString()
    return stash(pairs.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])).toDF(f"doc_id {kind}, digest binary, number long"), "numbered")


def drop_near(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, with all their columns, that stand for their component; those without an identifier come last.

    Where an identifier is missing or comes again, rows are numbered by identifier and text, and go by their numbers; rows
    that repeat both stay or go together. Empty and null texts stay, and so does an empty table.
    """
    gone_id, of_id, of_digest, number = (unused(docs, c) for c in ("gone_id", "of_id", "of_digest", "number"))

    def lost(rows: DataFrame) -> DataFrame:
        with scratch() as keep:
            return keep(near_duplicates(rows, k, percent).where(~F.col("kept")).select(F.col("doc_id").alias(gone_id)).distinct(), "lost")

    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").isEmpty():
        return matched(docs, lost(docs.select("doc_id", "text")), "left_anti", **{gone_id: F.col("doc_id")})
    of = numbered(docs).select(F.col("doc_id").alias(of_id), F.col("digest").alias(of_digest), F.col("number").alias(number))
    held = docs.join(of, F.col("doc_id").eqNullSafe(F.col(of_id)) & (own_digest() == F.col(of_digest))).drop(of_id, of_digest)
    held = stash(held, "held")
    gone = lost(held.select(F.col(number).alias("doc_id"), "text"))
    return matched(held, gone, "left_anti", **{gone_id: F.col(number)}).drop(number)
