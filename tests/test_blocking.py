"""Blocking on worked-out records."""

import random
import re

import pytest
from pyspark.sql import functions as F
from tessera.functions import arrays
from tessera.operators import blocking, profile_a, profile_b

COLUMNS = "entity_id string, business_name string, business_address string, country string"
TARGETS = [
    ("S2-101", "Orelee's Barbershop LLC", "1795 Westchester Drive, High Point, NC", "US"),
    ("S3-102", "Orelee Barbershop", "Westchester Dr, 1795, High Point", "US"),
    ("S2-201", "Starbucks Coffee Inc", "123 Main St, Seattle, WA", "US"),
    ("S2-301", "Café Étoile SARL", "15 Rue de Paris, Lyon", "France"),
    ("S2-901", "Random Bakery", "456 Elm St, Dallas, TX", "US"),
    ("S3-902", "French Flowers EURL", "10 Boulevard Sud, Paris", "France"),
]
S1 = [
    ("S1-001", "Orelee's Barbershop", "1795 Westchester Drive, High Point, NC", "US"),
    ("S1-002", "Coffee Starbucks", "123 Main Street, Seattle", "US"),
    ("S1-003", "Cafe Etoile", "15 Rue de Paris, Lyon", "France"),
    ("S1-004", "Unmatched Store Singleton", "999 Nowhere Rd", "US"),
]
LINKS = [("S1-001", "S2-101"), ("S1-001", "S3-102"), ("S1-002", "S2-201"), ("S1-003", "S2-301")]


@pytest.fixture
def sides(spark):
    return [profile_a.normalise(spark.createDataFrame(rows, COLUMNS)).cache() for rows in (S1, TARGETS)]


def test_candidates(spark, sides):
    found = blocking.candidates_a(*sides, k=5, most=50)
    got = {(r.s1_id, r.tgt_id): (round(r.pre_score, 6), r.rk) for r in found.collect()}
    assert got == {("S1-001", "S2-101"): (1.0, 1), ("S1-001", "S3-102"): (0.958333, 2), ("S1-002", "S2-201"): (0.95, 1), ("S1-003", "S2-301"): (1.0, 1)}
    row = blocking.recall_all(sides[0], found, spark.createDataFrame(LINKS, "s1_id string, tgt_id string")).first()
    assert (row.blocking_recall, row.singletons, row.avg_candidates_per_s1, row.max_candidates_per_s1) == (1.0, 1, 1.0, 2)


def test_keys(sides):
    keys = {r.key for r in profile_a.blocking_keys(sides[0]).where("entity_id = 'S1-001'").collect()}
    assert keys == {"cn:orelee s barbershop", "sn:barbershop orelee s", "nh:orelee_1795", "2t:barbershop_orelee", "an:westchester_1795", "an:high_1795"}


def test_cap_counts_emitted_keys(spark):
    rows = [(f"S2-{i}", "Same Name", "", "US") for i in range(5)]
    targets = profile_a.normalise(spark.createDataFrame(rows, COLUMNS))
    s1 = profile_a.normalise(spark.createDataFrame([("S1-1", "Same Name", "", "US")], COLUMNS))
    assert blocking.candidates_a(s1, targets, most=5).count() == 5
    assert blocking.candidates_a(s1, targets, most=4).count() == 0
    twice = profile_a.normalise(spark.createDataFrame([("S2-1", "Acme", "12 12 Elm", "US")], COLUMNS))
    assert blocking.bucket_sizes(profile_a.blocking_keys(twice)).where("key = 'nh:acme_12'").first().n == 2


def test_more_candidates_with_larger_k(sides):
    few, many = ({(r.s1_id, r.tgt_id) for r in blocking.candidates_a(*sides, k=k).collect()} for k in (1, 3))
    assert few <= many


def test_profile_b(spark):
    s1, targets = (profile_b.normalise(spark.createDataFrame(rows, COLUMNS)) for rows in (S1, TARGETS))
    found = {(r.s1_id, r.tgt_id): r.rk for r in blocking.candidates_b(s1, targets).collect()}
    assert all(found[pair] <= 2 for pair in LINKS)
    us = {t for t, *_, country in TARGETS if country == "US"}
    assert {t for s, t in found if s == "S1-002"} <= us
    everywhere = blocking.pairs_b(s1.where("entity_id = 'S1-003'"), targets)
    assert everywhere.count() >= 1


def test_country_fallback(spark):
    pairs = spark.createDataFrame([("a", "x", "us", "us"), ("a", "y", "us", "fr"), ("b", "y", "us", "fr"), ("c", "z", "", "")], "s1_id string, tgt_id string, s_country_norm string, t_country_norm string")
    assert {(r.s1_id, r.tgt_id) for r in blocking.same_country(pairs).collect()} == {("a", "x"), ("b", "y"), ("c", "z")}


def test_features(spark):
    columns = "s1_id string, tgt_id string, " + ", ".join(f"{side}{c} string" for side in ("s_", "t_") for c in ("core_name", "legal_suffix", "clean_address", "postcode", "country_clean")) + ", s_numeric_tokens array<string>, t_numeric_tokens array<string>"
    one = ("orelee barbershop", "llc", "1795 westchester drive", "27262", "US")
    other = ("orelee barbershop", "inc", "2000 main street dallas tx", "75001", "US")
    rows = [("a", "same", *one, *one, ["1795"], ["1795"]), ("a", "other", *one, *other, ["1795"], ["2000"]), ("a", "none", *one, "", "", "", "", "", ["1795"], [])]
    got = {r.tgt_id: r for r in profile_a.features(spark.createDataFrame(rows, columns)).collect()}
    same, other, none = got["same"], got["other"], got["none"]
    assert (same.name_ratio, same.core_name_exact, same.suffix_agreement, same.house_num_match, same.house_num_conflict, same.postcode_match) == (1, 1, 1, 1, 0, 1)
    assert (other.suffix_agreement, other.house_num_match, other.house_num_conflict, other.postcode_match) == (-1, 0, 1, 0)
    assert all(none[f] == 0 for f in profile_a.FEATURES)


def test_features_b(spark):
    s1, targets = (profile_b.normalise(spark.createDataFrame(rows, COLUMNS)) for rows in (S1, TARGETS))
    found = profile_b.features(blocking.with_records(blocking.candidates_b(s1, targets), s1, targets))
    row = found.where("s1_id = 'S1-001' and tgt_id = 'S2-101'").first()
    assert (row.addr_s1_blank, row.addr_both_present, row.country_equal, row.house_agree, row.shared_numeric_count, row.addr_ratio) == (0, 1, 1, 1, 1, 1)
    assert found.select(*profile_b.FEATURES).dropna().count() == found.count()


def test_registered_queries_of_profile_b_use_bigrams(spark):
    from tessera.plans.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    pairs = lambda name: {(r.s1_id, r.tgt_id) for r in QUERIES[name](spark, sf_dir).select("s1_id", "tgt_id").collect()}
    retrieved, met = pairs("candidates_b"), pairs("pairs_b")
    assert pairs("features_b") == retrieved
    assert pairs("features_b_native_all") == pairs("similarity_jaro_winkler_all") == met
    assert retrieved <= pairs("pairs_b_country_all") <= met
    assert met > pairs("similarity_jaro_winkler")


def test_bigrams_meet_without_a_row_for_each_that_is_shared(spark):
    keys = lambda rows: spark.createDataFrame([(e, k) for e, all_ in rows for k in all_.split()], "entity_id string, key string")
    s1, targets = keys([("a", "aa zz 09 90 aa"), ("b", "q1 1q"), (None, "aa zz 09")]), keys([("x", "aa zz 09 m4"), ("y", "aa aa zz q1"), ("z", "90 09 zz")])
    found = blocking.met_often(s1, targets, 3)
    assert sorted(found.collect(), key=str) == [("a", "x"), ("a", "z"), (None, "x")]
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    names = [("S1-1", "Acme Bolt", "", "US"), ("S1-2", "Xy", "12 Elm", "US")], [("S2-1", "Acme Bolt", "", "US"), ("S2-2", "Xy", "12 Elm", "US"), ("S3-1", "Bolt", "", "")]
    met = blocking.pairs_b(*(profile_b.normalise(spark.createDataFrame(rows, COLUMNS)) for rows in names)).collect()
    assert sorted(met) == [("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-2")]


def test_native_features_of_pairs_come_from_parts_of_records(spark):
    from tessera.plans.queries import QUERIES

    words = lambda text: {w for w in text.split(" ") if w}
    digits = lambda text: {w for w in words(text) if w.isdigit()}
    many = " ".join(f"w{i}" for i in range(300))
    rows = [(many, many + " 7 8"), (many + " inc", ""), ("", "7 8 9"), ("acme inc", "12 elm street 12"), ("a verylongwordofmanysigns llc ltd", "12 oak street 99999")]
    columns = "entity_id string, name_punct string, addr_punct string, name_suffix_str string, country_norm string, addr_house string, addr_postcode string"
    legal = lambda name: " ".join(w for w in name.split() if w in profile_b.LEGAL)
    sides = [spark.createDataFrame([(f"{x}{i}", n, a, legal(n), "us" * (i % 2), " " if i == 2 else a[:2], a[-1:]) for i, (n, a) in enumerate(rows)], columns) for x in "st"]
    pairs = sides[0].select(F.col("entity_id").alias("s1_id")).crossJoin(sides[1].select(F.col("entity_id").alias("tgt_id")))
    made = [df.select("entity_id", *(c.alias(name) for name, c in profile_b.parts().items())) for df in sides]
    got = {(r.s1_id, r.tgt_id): r for r in profile_b.native_features(blocking.with_records(pairs, *made), arrays.share_6).collect()}
    for i, (n, a) in enumerate(rows):
        for j, (m, b) in enumerate(rows):
            r, either, place = got[f"s{i}", f"t{j}"], words(n) | words(m), words(a) | words(b)
            assert r.name_token_jaccard == (round(len(words(n) & words(m)) / len(either), 6) if either else 1)
            assert r.addr_token_jaccard == (round(len(words(a) & words(b)) / len(place), 6) if a and b else 0)
            assert (r.addr_common_token_count, r.shared_numeric_count) == (len(words(a) & words(b)), len(digits(a) & digits(b)))
            assert (r.name_suffix_match, r.addr_s1_blank, r.addr_both_present) == (bool(words(legal(n)) & words(legal(m))), not a, bool(a and b))
            assert (r.house_agree, r.house_conflict) == ((a[:2] == b[:2], a[:2] != b[:2]) if a and b and 2 not in (i, j) else (0, 0))
            assert r.country_equal == (i % 2 == j % 2 == 1)

    parts = spark.createDataFrame([(a, b) for b in (*range(1, 130), 640, 12_800, 999_983, 2**31 - 1) for a in {0, 1, b // 3, b // 2, b * 5 // 128, b - 1, b}], "a int, b int")
    assert parts.where(~arrays.share_6(F.col("a"), F.col("b")).eqNullSafe(F.round(F.col("a") / F.col("b"), 6))).count() == 0

    # nothing is split or rounded for each pair, and Java compiles the join: whole, in methods of up to 8000 bytes
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["features_b_native_all"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        above = plan.optimizedPlan().toString().split("Join")[0]
        assert "split(" not in above and "round(" not in above
        shown = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    found = [x for x in shown.split("== Subtree ")[1:] if re.search(r"^[ +:-]*\*\(\d+\) ShuffledHashJoin", x, re.M)]
    assert found and all(int(re.search(r"maxMethodCodeSize:(\d+)", x)[1]) <= 8000 for x in found if "name_token_jaccard" in x)


def test_pairs_of_exact_keys_are_found_beside_the_bitmaps(spark):
    names = [("S1-1", "Acme Bolt", "12 Elm", "US"), ("S1-1", "Zyx", "7 Oak", "US"), ("S1-2", "Xy", "12 Elm", "US"), (None, "Qq", "9 Ash", ""), ("S1-4", "", "", "")]
    others = [("S2-1", "Acme Bolt", "", "US"), ("S2-2", "Xy", "12 Elm", "US"), ("S2-3", "Ab", "7 Oak", ""), ("S2-4", "Cd", "9 Ash", ""), ("S2-5", "", "", ""), (None, "Ef", "7 Oak", "")]
    sides = [profile_b.normalise(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")) for rows in (names, others)]
    found = blocking.pairs_b(*sides)
    exact = blocking.met(*(profile_b.exact_keys(x) for x in sides), ["key"])
    often = blocking.met_often(*(profile_b.bigram_keys(x) for x in sides), 3)
    assert sorted(found.collect(), key=str) == sorted(exact.union(often).distinct().collect(), key=str)
    assert ("S1-1", "S2-3") in found.collect() and (None, "S2-4") in found.collect()

    # no table of pairs is shuffled or joined: only records are
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Union" not in above and "Aggregate" not in above
    held = blocking.pairs_b(*sides, records=tuple(x.select("entity_id", "name_punct") for x in sides))
    assert held.columns == ["s1_id", "tgt_id", "s_name_punct", "t_name_punct"]

    rnd = random.Random(3)
    mark = lambda blank: [rnd.choice([blank, *range(2, 7), 2048, 2050, 4095]) for _ in range(5)]
    rows = [(mark(0), mark(1)) for _ in range(3000)]
    as_one = lambda x: sum(m << blocking.MARK_BITS * n for n, m in enumerate(x))
    got = spark.createDataFrame([(i, as_one(a), as_one(b)) for i, (a, b) in enumerate(rows)], "i int, s_marks long, t_marks long").select("i", blocking.maybe_met("s", "t").alias("hit"))
    assert all(r.hit == any(x == y for x, y in zip(*rows[r.i])) for r in got.collect())


def test_names_are_not_joined_to_pairs(spark, monkeypatch):
    from tessera.plans.queries import QUERIES

    monkeypatch.setattr(blocking, "FEW", 1)
    plan = QUERIES["similarity_jaro_winkler_all"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    assert re.search(r"Join Inner, .*cell", plan.split("\n", 1)[1].split("RepartitionByExpression")[0]) and plan.split("RepartitionByExpression")[0].count("Join ") == 1
