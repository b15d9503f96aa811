"""F0.5, thresholds, splits, training pairs."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tessera.operators import decision, model, split

CASES = [((), (), 1.0), ((), ("S2-100",), 0.0), (("S2-100", "S3-200"), ("S2-100", "S3-200"), 1.0), (("S2-100", "S3-200"), ("S2-100", "S3-200", "S3-999"), 0.714286), (("S2-100", "S3-200"), (), 0.0), (("S2-100", "S3-200"), ("S2-100",), 0.833333), (("S2-100",), ("S2-999", "S3-888"), 0.0)]


def frames(spark, truth, told):
    counts = spark.createDataFrame([(s, len(t)) for s, t in truth.items()], "s1_id string, n_true int")
    links = spark.createDataFrame([(s, x) for s, t in truth.items() for x in t], "s1_id string, tgt_id string")
    return counts, links, spark.createDataFrame(told, "s1_id string, tgt_id string, proba double")


def test_cases(spark):
    counts, links, told = frames(spark, {f"S1-{i}": t for i, (t, _, _) in enumerate(CASES)}, [(f"S1-{i}", x, 1.0) for i, (_, p, _) in enumerate(CASES) for x in p])
    got = {r.s1_id: r.f05 for r in decision.scored_records(counts, links, told).collect()}
    assert got == pytest.approx({f"S1-{i}": s for i, (_, _, s) in enumerate(CASES)}, abs=1e-6)


def test_macro(spark):
    counts, links, told = frames(spark, {"a": ("x",), "b": (), "c": ("y",)}, [("a", "x", 1.0)])
    row = decision.macro_f05(decision.scored_records(counts, links, told)).first()
    assert row.macro_f05 == pytest.approx(0.666667, abs=1e-6) and (row.n_perfect, row.n_zero) == (2, 1)


def test_sweep_takes_the_lowest_of_the_best(spark):
    truth = {f"S1-{i}": ((f"S2-{i}",) if i % 2 == 0 else ()) for i in range(20)}
    told = [row for i in range(20) for row in ((f"S1-{i}", f"S2-{i}", 0.85 if i % 2 == 0 else 0.20), (f"S1-{i}", f"S3-{i}", 0.15))]
    swept = decision.sweep(decision.by_threshold(*frames(spark, truth, told)))
    assert decision.best_threshold(swept) == (0.35, 1.0)
    assert swept.count() == 11 and len(decision.FINE) == 91 and len(decision.WEIGHTS_SWEEP) == 13
    direct = {}
    counts, links, scored = frames(spark, truth, told)
    for t in decision.COARSE:
        direct[t] = decision.macro_f05(decision.scored_records(counts, links, decision.accepted(scored, t))).first().macro_f05
    assert {r.threshold: r.macro_f05 for r in swept.collect()} == pytest.approx(direct)


@given(st.integers(0, 5), st.integers(0, 5), st.integers(0, 5))
def test_f05_formula_agrees_with_precision_and_recall(hit, miss, wrong):
    true, pred = hit + miss, hit + wrong
    if hit:
        p, r = hit / pred, hit / true
        assert 1.25 * hit / (0.25 * true + pred) == pytest.approx(1.25 * p * r / (0.25 * p + r))


def test_split(spark):
    counts = spark.range(1000).select(F.concat(F.lit("S1-"), "id").alias("s1_id"), F.expr("if(id % 10 < 7, 'US', 'France')").alias("country"), (F.col("id") % 6).cast("int").alias("n_true"))
    parts = split.split(counts).cache()
    assert parts.count() == 1000 and parts.select("s1_id").distinct().count() == 1000
    for r in parts.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("part") == "val").alias("val")).collect():
        assert r.val == round(r.n * 0.2)
    assert sorted(map(tuple, split.split(counts.repartition(5)).select("s1_id", "part").collect())) == sorted(map(tuple, parts.select("s1_id", "part").collect()))
    assert split.balance(parts, "country").count() == 2 and split.match_statistics(parts).count() == 2


def test_small_strata_are_merged(spark):
    rows = [(f"S1-{i}", "US", 0) for i in range(10)] + [("S1-20", "US", 1), ("S1-21", "US", 3), ("S1-22", "US", 4)]
    got = {r.stratum for r in split.strata(spark.createDataFrame(rows, "s1_id string, country string, n_true int")).collect()}
    assert got == {"US_singleton", "US_rare"}


def test_training_pairs(spark):
    rows = [("a", f"t{i}", int(i < 2)) for i in range(30)] + [("b", f"t{i}", 0) for i in range(30)] + [("c", "t0", 1)]
    got = split.training_pairs(spark.createDataFrame(rows, "s1_id string, tgt_id string, label int")).groupBy("s1_id", "label").count().collect()
    assert {(r.s1_id, r.label): r["count"] for r in got} == {("a", 1): 2, ("a", 0): 8, ("b", 0): 2, ("c", 1): 1}


def test_model(spark):
    rows = spark.range(600).select(F.concat(F.lit("S1-"), F.col("id") % 50).alias("s1_id"), F.concat(F.lit("S2-"), "id").alias("tgt_id"), F.rand(1).alias("x"), F.rand(2).alias("y"))
    rows = rows.withColumn("label", (F.col("x") + 0.3 * F.rand(3) > 0.7).cast("int")).cache()
    small = model.Settings(trees=8, depth=3, least_in_leaf=5)
    fitted = model.fit(rows, ["x", "y"], small, rows.limit(100))
    found = model.scored(fitted, rows)
    assert model.auc(found) > 0.75
    assert found.where("proba < 0 or proba > 1").isEmpty()
    assert model.importances(fitted, ["x", "y"])[0][0] == "x"
    assert model.link_weight(rows) >= 1.0
