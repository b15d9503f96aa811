"""Document fingerprints by winnowing over words, in DataFrame operations only (operator 8).

Words are hashed; the polynomial hash of every run of `K` words is put together from hashes of half the length, so each
word is read once. In every window of `WINDOW` such hashes the least is chosen, the rightmost of equal ones, again by
doubling. Any run of K + WINDOW - 1 words that two texts share gives both at least one equal hash. The fingerprint keeps
each chosen hash with the position of its first word.

Cases: a null doc_id comes before all others, equal ones go by the text. A null or empty text has no words and an empty fingerprint; a text of fewer than K words has one hash, of all its
words; one with fewer hashes than a window has the least of them. Two empty fingerprints are alike (1.0), an empty and
another one are not (0.0).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import tasks_for, texts, unused

K = 5
WINDOW = 16
PRIME = (1 << 31) - 1
BASE = 1_000_003
LAST = (1 << 32) - 1
NO_ID = -(1 << 63)
#: Documents that are sorted together to find each one's successor, blocks at most (their bounds reach the driver), and
#: stored input for each task that sorts blocks, in MB.
BLOCK_ROWS, MOST_BLOCKS, TASK_MB = 512, 20_000, 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def rolled(x: Column, k: int) -> Column:
    """At each position the polynomial hash of `k` numbers from there on, doubling; the last k - 1 positions hold nulls."""
    if k == 1:
        return x
    half = k // 2
    lift = F.lit(pow(BASE, half, PRIME))
    twice = let(rolled(x, half), lambda h: F.transform(h, lambda v, i: (v * lift + F.get(h, i + half)) % PRIME))
    if k % 2 == 0:
        return twice
    return let(x, lambda y: F.transform(rolled(y, k - 1), lambda v, i: (v * BASE + F.get(y, i + (k - 1))) % PRIME))


def least_ahead(a: Column, by: int) -> Column:
    """At each position the smaller of the number there and the one `by` further on; beyond the end, the number there."""
    return F.transform(a, lambda v, i: F.least(v, F.get(a, i + by)))


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """An array of hash * 2^32 + (2^32 - 1 - position), by position: a smaller number has a smaller hash or stands further right."""

    def ahead(by: int) -> Callable[[Column], Column]:
        return lambda a: least_ahead(a, by)

    def chosen(grams: Column) -> Column:
        packed = F.transform(grams, lambda v, i: v * (LAST + 1) + (LAST - i))
        step, at = 1, packed
        while step < window:
            by = min(step, window - step)
            at = let(at, ahead(by))
            step += by
        return F.array_distinct(F.slice(at, 1, F.greatest(F.lit(1), F.size(grams) - (window - 1))))

    def of_words(words: Column) -> Column:
        numbers = F.transform(words, lambda w: F.shiftrightunsigned(F.xxhash64(w), 33))
        long = let(F.slice(rolled(numbers, k), 1, F.greatest(F.lit(1), F.size(words) - (k - 1))), chosen)
        short = F.array(F.shiftrightunsigned(F.xxhash64(words), 33) * (LAST + 1) + LAST)
        return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).when(F.size(words) < k, short).otherwise(long)

    return let(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), of_words)


def shown(fingerprints: Column) -> Column:
    """hash in hex, colon, position; comma-joined."""
    return F.array_join(F.transform(fingerprints, lambda v: F.concat(F.hex(F.shiftright(v, 32)), F.lit(":"), (F.lit(LAST) - v.bitwiseAND(F.lit(LAST))).cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the hashes, wherever they stand."""
    hashes = lambda f: F.transform(f, lambda v: F.shiftright(v, 32))
    both, either = F.size(F.array_intersect(hashes(a), hashes(b))), F.size(F.array_union(hashes(a), hashes(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def dealt(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Every row of `docs` with its place (block, copy, wraps), and the names that it and its sort keys have.

    Blocks are ranges of (doc_id, mark) of about `BLOCK_ROWS` rows, cut by sampled ranks, so that far-off identifiers
    widen none; mark is a hash of the text where one identifier (or none) has more rows than a block, else 0. The first
    rows of a block also go, as copies, to the block before; those of the first block to the last, where they wrap.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    n, most = docs.select(key.alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    mark = F.xxhash64(F.coalesce("text", F.lit(""))) if n and most > BLOCK_ROWS else F.lit(0).cast("long")
    blocks = max(1, min(MOST_BLOCKS, (n or 0) // BLOCK_ROWS))
    parts = docs.select(key.alias("id"), mark.alias("mark")).repartitionByRange(blocks, "id", "mark")
    firsts = sorted(r.least for r in parts.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.min(F.struct("id", "mark")).alias("least")).collect()) or [(0, 0)]
    # array literals, as the optimizer folds them
    ids, marks = (F.split(F.lit(",".join(str(f[c]) for f in firsts)), ",").cast("array<bigint>") for c in (0, 1))
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(len(firsts).bit_length()))))
    name = {c: unused(docs, c) for c in ("id", "mark", "place")}
    held = docs.withColumns({name["id"]: key, name["mark"]: mark})
    own, own_mark = F.col(name["id"]), F.col(name["mark"])

    def reached(at: Column) -> Column:
        return (F.get(ids, at) < own) | (F.get(ids, at) == own) & (F.get(marks, at) <= own_mark)

    block = F.aggregate(steps, F.lit(0), lambda at, step: F.when(reached(at + step), at + step).otherwise(at))
    held = held.withColumn(name["place"], block)
    block = F.col(name["place"])
    place = lambda at, copy, wraps: F.struct(at.alias("block"), F.lit(copy).alias("copy"), wraps.alias("wraps"))
    both = F.array(place(block, 0, F.lit(False)), place((block + (len(firsts) - 1)) % len(firsts), 1, block == 0))
    first = (F.get(ids, block) == own) & (F.get(marks, block) == own_mark)
    places = F.when(first, both).otherwise(F.slice(both, 1, 1))
    return held.withColumn(name["place"], F.explode(places)), name


def with_next(docs: DataFrame, *carried: str) -> DataFrame:
    """`docs` (doc_id, text, ...) with next_<column> of the next row by doc_id, the first after the last.

    Rows of one identifier go by a hash of the text where they are many (see dealt()), and by the text; those without an
    identifier come first. The text is shuffled once, and no task sorts more than a few blocks.
    """
    held, name = dealt(docs)
    place = name["place"]
    order = Window.partitionBy(f"{place}.block").orderBy(f"{place}.wraps", name["id"], name["mark"], "text", f"{place}.copy")
    led = held.repartition(tasks_for(docs, TASK_MB), F.col(f"{place}.block")).withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
    return led.where(F.col(f"{place}.copy") == 0).drop(name["id"], name["mark"], place)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every whole text of `docs`."""
    return texts(docs).select("doc_id", fingerprint(F.col("text")).alias("fingerprint"))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Each text against an edited copy, whose second half is the start of the next document, and against that document."""
    own = texts(docs).withColumn("print", fingerprint(F.col("text")))
    led = with_next(own, "text", "print")
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = led.select("doc_id", n.cast("long").alias("n_chars"), "print", "next_print", F.concat(F.left("text", n - half), F.left("next_text", half)).alias("edited"))
    done = edited.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "print", "next_print", fingerprint(F.col("edited")).alias("edited_print"))
    return done.select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("print")).alias("fingerprint"), shown(F.col("edited_print")).alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), likeness(F.col("print"), F.col("next_print")).alias("near_next")
    )
