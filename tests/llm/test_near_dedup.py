"""Near duplicates against all pairs of sets in plain Python."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessera.llm import near_dedup
from tessera.llm.components import components
from tessera.llm.shingles import shingle_set


def plain_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    sets = {i: plain_set(t, k) for i, t in rows}
    over = {i: i for i in sets}

    def top(i):
        while over[i] != i:
            i = over[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                over[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \n", "One", "one", "two words", "TWO words", "a b c", "a b c d", "Ünï ünï b", "x " * 500]

    def edited(words, share):
        return [rnd.choice(vocab) if rnd.random() < share else w for w in words]

    base = [rnd.choice(vocab) for _ in range(120)]
    texts += [" ".join(edited(base, rnd.choice([0.005, 0.01, 0.02, 0.03, 0.05]))) for _ in range(150)]
    other = edited(base, 0.06)
    texts += [" ".join(edited(other, rnd.choice([0.0, 0.01, 0.02, 0.04]))) for _ in range(60)]
    for _ in range(40):
        own = [rnd.choice(vocab) for _ in range(rnd.randint(4, 90))]
        texts += [" ".join(edited(own, 0.01)) for _ in range(rnd.randint(1, 4))]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("k", "percent", "hot"), [(3, 85, 100_000), (5, 80, 100_000), (3, 85, 3)])
def test_against_all_pairs(spark, monkeypatch, k, percent, hot):
    monkeypatch.setattr(near_dedup, "HOT_ELEMENT", hot)
    rows = corpus(k)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, component long")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, k, percent).collect()}
    assert got == brute(rows, k, percent)
    if k == 3:
        return
    left = near_dedup.drop_near(docs, k, percent)
    assert left.columns == docs.columns and left.count() == sum(i == c for i, (_, c) in got.items())


def test_one_crowded_group(spark):
    """Thousands of near copies of one text, each other than all, around one hub, and a few links beside them."""
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(3000):
        words = base[:]
        words[rnd.randrange(100)] = f"x{i}"
        rows.append((10 + i, " ".join(words)))
    rows += [(5, " ".join(base)), (5000, "a b c d e f"), (5001, "A b c d e f"), (5002, "other words in here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 3, 85).collect()}
    assert got == {i: 5 if i < 5000 else min(i, 5000) if i < 5002 else i for i, _ in rows}


def test_text_identifiers_and_names(spark):
    texts = ["a b c d e f g", "A b c d e f g", "other one", None]
    rows = [(i, t, 1) for i, t in zip(["b", "a", "c", None], texts)]
    names = ["gone_id", "of_id", "of_digest", "number", "named", "held", "first", "size", "digest"]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lost_id int").withColumns({c: F.lit(c) for c in names})
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got["b"] == ("a", False) and got["a"] == ("a", True) and got["c"] == ("c", True)
    left = near_dedup.drop_near(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {"a", "c", None}


def test_a_class_of_different_sets_is_split(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "u v w x y z")], "doc_id long, text string")
    members = spark.createDataFrame([(1, b"x"), (2, b"x"), (3, b"y")], "doc_id long, digest binary")
    assert near_dedup.unlike(docs, members, 3).isEmpty()
    wrong = spark.createDataFrame([(1, b"x"), (2, b"x"), (3, b"x")], "doc_id long, digest binary")
    assert near_dedup.unlike(docs, wrong, 3).count() == 1
    real = near_dedup.sketches
    monkeypatch.setattr(near_dedup, "sketches", lambda docs, k: real(docs, k).withColumn("digest", F.lit(b"x")))
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 3, 85).collect()} == {1: 1, 2: 1, 3: 3}


def test_drop_near_goes_by_identifier_and_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a + " z"), (2, b), (None, b + " z"), (None, c), (None, c + " z"), (3, "d e f g h i")]
    left = near_dedup.drop_near(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = Counter((r.doc_id, r.text[:1]) for r in left.collect())
    assert kept == Counter({(1, "a"): 1, (2, "b"): 1, (None, "c"): 1, (3, "d"): 1})


def test_repeated_rows_and_none(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (4, "A b c d"), (None, "a b c d")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in near_dedup.near_duplicates(docs).collect()) in ([(0, 1), (1, 1), (1, 1), (4, 1)], [(0, 0), (1, 1), (1, 1), (4, 1)])
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_sketch_and_estimate():
    rnd = np.random.default_rng(5)
    for true in (0.3, 0.8, 0.95):
        errors = []
        for _ in range(30):
            n = 3000
            common = rnd.integers(0, 2**63, int(n * true)).astype(np.uint64) * np.uint64(2)
            extra = [rnd.integers(0, 2**63, (n - len(common)) // 2).astype(np.uint64) * np.uint64(2) for _ in range(2)]
            from tessera.llm.shingles import mixed

            a, b = (near_dedup.sketch(mixed(np.concatenate([common, x])))[None] for x in extra)
            errors.append(near_dedup.estimate(a, b, np.array([float(n)]), np.array([float(n)]))[0] - true)
        assert abs(np.mean(errors)) < 0.03
    assert len(shingle_set("a b", 3)) == 1 and len(shingle_set("", 3)) == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 99), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(51), 0), 99: 99, 100: 99, 101: 99}
    assert components(links.limit(0)).count() == 0


def test_buckets_are_compared_without_a_row_for_each_pair(spark, monkeypatch):
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 3, (90, near_dedup.REGISTERS)).astype("<u2")
    prints[40:70] = prints[40]  # a dense bucket
    prints[11], prints[88] = prints[3], prints[75]
    keys, ids, n = np.repeat([7, 9, 12, 13], [30, 10, 30, 20]), rng.permutation(90), np.full(90, 100.0)
    a, b, dense = near_dedup.near_in_buckets(keys, ids, n, prints, 0.6)
    assert {*zip(a.tolist(), b.tolist())} == {tuple(sorted((int(ids[i]), int(ids[j])))) for i, j in ((3, 11), (75, 88))}
    assert dense.tolist() == [12]
    assert [len(x) for x in near_dedup.near_in_buckets(keys[:0], ids[:0], n[:0], prints[:0], 0.6)] == [0, 0, 0]

    # buckets go on from one batch to the next, and are taken in slices
    firsts = spark.createDataFrame([(int(i), bytearray(p.tobytes()), 100) for i, p in zip(ids, prints)], "id long, sketch binary, n long")
    buckets = spark.createDataFrame([(int(k), int(i)) for k, i in zip(keys, ids)], "key long, id long")
    for name, value in (("SLICE", 0), ("SLICE_ROWS", 40), ("BUCKET_ROWS", 8)):
        monkeypatch.setattr(near_dedup, name, value)
    found = near_dedup.near_pairs(buckets, firsts, 0.6).collect()
    assert {(r.a, r.b) for r in found if r.key is None} == {*zip(a.tolist(), b.tolist())}
    assert [r.key for r in found if r.key is not None] == [12]


def test_what_a_step_wrote_goes_when_its_result_is_stored(spark):
    from tessera.llm.common import scratch, stash

    with scratch() as outer:
        with scratch() as keep:
            first = keep(stash(spark.range(5), "inner").where("id > 1"), "first")
        second = outer(first.where("id > 2"), "second")
        folder = first.inputFiles()[0].rsplit("/", 2)[0].removeprefix("file:").replace("//", "/")
        assert not [x for x in os.listdir(folder) if x.startswith("tessera-inner")]
        assert first.count() == 3
    assert not [x for x in os.listdir(folder) if x.startswith("tessera-first")]
    assert second.count() == 2
