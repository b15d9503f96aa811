"""Winnowing, mixing and exact dedup against plain Python."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F
from tessera.llm import exact_dedup, language, mixing, near_dedup, winnowing
from tessera.llm.common import stash

ROWS = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "a"),
    (2, None, "b"),
    (3, "", None),
    (4, " \n\t ", "a"),
    (5, "word", "b"),
    (6, "one two three four five six seven eight nine ten eleven twelve", None),
    (7, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a", "a"),
    (8, " ".join(f"w{i % 97}" for i in range(3000)), "c"),
    (9, "ünï cödé ★ text with a no-break space and more words to fill it up to some length", "a"),
    (9, "ünï cödé ★ text with a no-break space and more words to fill it up to some length", "a"),
    (12, "one two three four", "c"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in ("size", "key", "digest", "block", "n", "id", "copies")})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def winnow(text, k=winnowing.K, w=winnowing.WINDOW):
    x = [xxhash.xxh64_intdigest(t.encode(), seed=42) >> 33 for t in words(text)]
    if len(x) < k:
        return None if x else []
    grams = []
    for i in range(len(x) - k + 1):
        h = 0
        for v in x[i : i + k]:
            h = (h * winnowing.BASE + v) % winnowing.PRIME
        grams.append(h)
    out = []
    for i in range(max(1, len(grams) - w + 1)):
        h, at = min((g, -j) for j, g in enumerate(grams) if i <= j < i + w)
        if (h, -at) not in out:
            out.append((h, -at))
    return out


def test_fingerprints(docs):
    got = winnowing.fingerprints(docs).select("doc_id", "fingerprint").collect()
    assert len(got) == len(ROWS)
    by = {r.doc_id: [(v >> 32, winnowing.LAST - (v & winnowing.LAST)) for v in r.fingerprint] for r in got}
    for i, text, _ in ROWS:
        if (want := winnow(text)) is not None:
            assert by[i] == want
        else:
            assert len(by[i]) == 1
    assert by[1] == by[6]


def shown(prints):
    return ",".join(f"{h:X}:{-at}" for h, at in prints)


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a or b else 1.0


def test_edited(spark):
    rnd = random.Random(4)
    texts = [" ".join(f"w{rnd.randint(0, 60)}" for _ in range(rnd.randint(5, 120))) for _ in range(60)] + ["", None, " \n ", "ünï cödé ★ ë f g"]
    texts += [t + " more of it" for t in texts[:20]]
    rows = [(i * 7 - 50, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(c) for c in ("id", "mark", "at", "part", "block", "place", "print", "edited")})
    got = sorted(winnowing.edited_likeness(docs).collect())
    assert len(got) == len(rows)
    for r, (i, text), (_, after) in zip(got, rows, [*rows[1:], rows[0]]):
        text, half = text or "", len(text or "") // 2
        edited = text[: len(text) - half] + (after or "")[:half]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(text), hashlib.sha256(edited.encode()).hexdigest())
        one, two, three = winnow(text), winnow(edited), winnow(after)
        if one is not None:
            assert r.fingerprint == shown([(h, -at) for h, at in one])
        if two is not None:
            assert r.edited_fingerprint == shown([(h, -at) for h, at in two])
        if None not in (one, two):
            assert r.near_edited == pytest.approx(alike(one, two))
        if None not in (one, three):
            assert r.near_next == pytest.approx(alike(one, three))


def test_edited_of_few(spark):
    one = spark.createDataFrame([(5, "just one document here")], "doc_id long, text string")
    assert winnowing.edited_likeness(one).first().near_next == 1.0
    assert winnowing.edited_likeness(one.limit(0)).count() == 0


def test_next_by_even_blocks(spark, monkeypatch):
    """Far-off identifiers, none and many rows of one: the order holds, and no block takes more than a few times its share."""
    monkeypatch.setattr(winnowing, "BLOCK_ROWS", 64)
    rows = [(i * 10**15 if i % 7 == 0 else i, f"text {i}") for i in range(-300, 2000)] + [(1 << 61, "far"), (-(1 << 61), "far below")]
    rows += [(None, f"none {i}") for i in range(700)] + [(77, f"again {i}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    led = winnowing.with_next(docs, "text").collect()
    assert Counter((r.doc_id, r.text) for r in led) == Counter(rows)
    after, text = {(r.doc_id, r.text): r.next_text for r in led}, min((r for r in rows if r[0] is None), key=lambda r: xx(r[1]))[1]
    at = lambda i, t: (i is not None, i or 0, xx(t))
    ordered = sorted(rows, key=lambda r: at(*r))
    assert ordered[0][1] == text
    assert all(after[one] == two[1] for one, two in zip(ordered, [*ordered[1:], ordered[0]]))
    sizes = [r["n"] for r in winnowing.dealt(docs)[0].where("place.copy = 0").groupBy("place.block").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 6 * 64


def xx(text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def test_exact(docs):
    groups = defaultdict(list)
    for i, text, _ in ROWS:
        groups[text or ""].append(i)
    for keep, pick in (("smallest", min), ("largest", max)):
        got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_classes(docs, keep).collect())
        assert got == sorted((i, pick(groups[t or ""]), len(groups[t or ""]), i == pick(groups[t or ""])) for i, t, _ in ROWS)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 4, 5, 7, 8, 9, 12]
    assert exact_dedup.exact_classes(docs.limit(0)).count() == 0


def test_a_batch_reads_only_what_a_filter_lets_through(spark):
    ids = spark.range(4000).select(F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("digest"), F.col("id").alias("doc_id"))
    index = exact_dedup.DigestIndex()
    assert index.add(ids.where("doc_id < 2000")).isEmpty()
    run = index.runs[0]
    assert run.passed(ids.where("doc_id < 2000").select("digest")).count() == 2000
    strangers = run.passed(ids.where("doc_id >= 2000").select("digest")).count()
    assert 0 < strangers < 2000 * 2 / exact_dedup.FILTER_BITS
    # what the filter holds back is never looked up, even if the run has it
    run.filter = run.filter.limit(0)
    assert index.add(ids.where("doc_id between 1000 and 1999")).isEmpty()
    index.compact()
    assert len(index.runs) == 1 and index.runs[0].rows.count() == 2000
    hits = index.add(ids.where("doc_id between 1500 and 2500").unionByName(ids.where("doc_id = 3000")).unionByName(ids.where("doc_id = 3000")))
    assert hits.count() == 501
    index.compact()
    got = {r.least: (r.most, r.n) for r in index.runs[0].rows.join(hits, "digest").collect()}
    assert got == {i: (i, 2 + (i < 2000)) for i in range(1500, 2000)} | {3000: (3000, 2)}


def test_spread(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 4)
    rows = spark.createDataFrame([(k, i) for i, k in enumerate("aaaaaaaaaaaabbbcdefgh")], "key string, i int")
    table = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(exact_dedup.spread(rows, table, "key", "n").select("i", "key", "n").collect()) == [(i, k, {"a": 12, "b": 3}.get(k, 1)) for i, k in enumerate("aaaaaaaaaaaabbbcdefgh")]


def test_columns_of_any_name(spark):
    names = ["found_id", "found_digest", "mix_id", "mix_size", "mix_copies", "mix_nth", "batch", "fourth", "n", "least", "most", "digest", "size", "block", "bit", "bits", "copies", "picked", "spot", "lang"]
    docs = spark.createDataFrame([(i, f"text {i % 3}", "s") for i in range(9)], "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in names})
    assert exact_dedup.drop_copies(docs).columns == docs.columns and exact_dedup.drop_copies(docs).count() == 3
    assert mixing.emit(docs).columns == docs.columns
    assert len(language.labelled(docs)) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(9)) and language.accepted(docs, language.train(docs)).columns == docs.columns


def test_emit_tells_rows_of_one_id_apart(spark):
    docs = spark.createDataFrame([(None, "w " * n, "s") for n in range(1, 200)], "doc_id long, text string, source string")
    copies = {r["size"]: r.copies for r in mixing.mix(docs).collect()}
    got = Counter(len(r.text) // 2 for r in mixing.emit(docs).collect())
    assert got == {n: c for n, c in copies.items() if c}


def test_drop_copies_goes_by_identifier_and_text(spark):
    rows = [(1, "a"), (2, "a"), (2, "b"), (None, "a"), (None, "c"), (None, "c"), (3, None), (3, ""), (3, "d"), (3, "d")]
    left = exact_dedup.drop_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, "c"), (1, "a"), (2, "b"), (3, ""), (3, "d")]


def test_exact_splits_a_digest_of_two_texts(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "digest", lambda text="text": F.unhex(F.lpad(F.hex(F.char_length(text)), 8, "0")))
    groups = defaultdict(list)
    for i, text, _ in ROWS:
        groups[text or ""].append(i)
    got = sorted((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_classes(docs).collect())
    assert got == sorted((i, min(groups[t or ""]), len(groups[t or ""])) for i, t, _ in ROWS)


def test_targets(spark):
    sizes = spark.createDataFrame([("sa", "a", 10), ("sb", "b", 1000), ("sc", "c", 300), ("n", None, 50)], "key string, source string, source_size long")
    got = {r.key: r.target for r in mixing.targets(sizes).collect()}
    left, open_, done = 1.5 * 1360, {"sa": 3, "sb": 1, "sc": 2, "n": 3}, {}
    caps = {"sa": 20, "sb": 2000, "sc": 600, "n": 100}
    while full := [k for k in open_ if left * open_[k] / sum(open_.values()) > caps[k]]:
        for k in full:
            done[k] = caps[k]
            left -= caps[k]
            del open_[k]
    done |= {k: left * w / sum(open_.values()) for k, w in open_.items()}
    assert got == pytest.approx(done)


def test_mix(docs, spark):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS) and all(r.taken <= 2 * r.size for r in got)
    assert sorted(got) == sorted(mixing.mix(docs).collect())
    emitted = mixing.emit(docs)
    assert emitted.columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, 'x', concat('y', id % 5))").alias("source"), F.expr("repeat('w ', cast(1 + id % 50 as int))").alias("text"))
    for key, target, taken in mixing.mix(many).groupBy("source_size").agg(F.first("target"), F.sum("taken")).collect():
        assert abs(target - taken) < 0.02 * target + 60


@pytest.mark.parametrize("few", [0, 100])
def test_matched_is_the_join_for_many_names_too(spark, monkeypatch, few):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", few)
    rows = spark.createDataFrame([(i % 90 if i % 13 else None, f"t{i}") for i in range(300)], "id long, text string")
    names = spark.createDataFrame([(i,) for i in range(0, 120, 4)] + [(None,)], "of long")
    for how in ("inner", "left_semi", "left_anti"):
        for safe in (False, True):
            same = F.col("id").eqNullSafe(F.col("of")) if safe else F.col("id") == F.col("of")
            want = sorted(map(str, rows.join(names, same, how).collect()))
            assert sorted(map(str, exact_dedup.matched(rows, names, how, safe=safe, of=F.col("id")).collect())) == want


def test_texts_of_rows_that_are_not_named_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 4)
    docs = stash(spark.range(2000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 50).alias("text")), "plain")
    named = spark.range(20).select((F.col("id") * 100).alias("named"))
    monkeypatch.setattr(exact_dedup, "stash", lambda df, name: stash(df, name).hint("merge") if name == "names" else stash(df, name))
    for how in ("left_semi", "inner", "left_anti"):
        found = exact_dedup.matched(docs, named, how, named=F.col("doc_id"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("getbit") > plan.index("Exchange hashpartitioning") and found.count() == (1980 if how == "left_anti" else 20)
    assert near_dedup.sets_of(docs, named, 3).count() == 20


def test_shuffle_files_go_with_their_query(spark):
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before = files()
    keep = stash(spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count(), "counts")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and keep.count() == 97
