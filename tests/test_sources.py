"""Files in and out, checks on files, profiling, whole pipelines, streams, and the driver's contract."""

import __spark_entry__
import pytest
from pyspark.sql import functions as F
from tessera.operators import blocking, model, profile_a, profiler, validate
from tessera.plans import entities, pipelines
from tessera.sources import sinks, tables
from tessera.sources.schema import CANDIDATES, ENTITY, MATCHES
from tessera.streaming import arrivals

SF = "/root/testdata/sf0.001"


def test_tsv(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNA\t\tUS\nS1-2\t\"q\" x\tnull\t\n", encoding="utf-8")
    assert [tuple(r) for r in tables.read_entities(spark, str(path)).orderBy("entity_id").collect()] == [("S1-1", "NA", "", "US"), ("S1-2", '"q" x', "null", "")]
    sinks.write_tsv(tables.read_entities(spark, str(path)), str(tmp_path / "out"), files=1)
    assert '\t\t' in next((tmp_path / "out").glob("part-*")).read_text(encoding="utf-8")
    again = tables.read_entities(spark, str(tmp_path / "out"))
    assert again.exceptAll(tables.read_entities(spark, str(path))).isEmpty() and again.count() == 2


def test_ids_json_log_model(spark, tmp_path):
    ids = spark.createDataFrame([("S1-2",), ("S1-1",)], "entity_id string")
    sinks.write_ids(ids, str(tmp_path / "ids"))
    assert [r.entity_id for r in tables.read_ids(spark, str(tmp_path / "ids")).collect()] == ["S1-1", "S1-2"]
    sinks.write_json(str(tmp_path / "t.json"), threshold=0.5)
    assert sinks.read_json(str(tmp_path / "t.json")) == {"threshold": 0.5}
    for i in range(2):
        sinks.append_run(spark, str(tmp_path / "log"), f"run {i}", "ok", f05=0.9)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    rows = spark.range(40).select(F.col("id").cast("double").alias("x"), (F.col("id") > 20).cast("int").alias("label"), F.lit("a").alias("s1_id"), F.lit("b").alias("tgt_id"))
    sinks.save_model(model.fit(rows, ["x"], model.Settings(trees=2, depth=2, least_in_leaf=1)), str(tmp_path / "m"))
    assert model.scored(sinks.load_model(str(tmp_path / "m")), rows).count() == 40


GOOD = "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-2\nS1-2\t\n"


@pytest.mark.parametrize(
    ("text", "fault"),
    [
        (None, "file_not_found"),
        ("", "file_empty"),
        ("source1_entity_id,matched_entity_ids\n", "comma_separated"),
        ("a\tb\n", "header"),
        (GOOD + "S1-3 nothing\n", "no_tab"),
        (GOOD + "S1-1\tS2-1\n", "duplicate_row"),
        (GOOD.replace("S3-2", "S2-1"), "repeated_id"),
        (GOOD.replace("S3-2", "S1-9"), "self_match"),
        (GOOD.replace("S3-2", "9"), "wrong_prefix"),
        (GOOD.replace("S1-2", "S1-8"), "missing_row"),
        (GOOD.replace("S1-2", "S1-8"), "unexpected_row"),
        (GOOD.replace("S3-2", "S3-77"), "unknown_id"),
        (GOOD, None),
        (GOOD.replace("source1", " Source1"), None),
    ],
)
def test_results_file(spark, tmp_path, text, fault):
    path = tmp_path / "r.tsv"
    if text is not None:
        path.write_text(text, encoding="utf-8")
    required, known = (spark.createDataFrame([(x,) for x in ids], "entity_id string") for ids in (("S1-1", "S1-2"), ("S2-1", "S3-2")))
    found = {r.check for r in validate.check_file(spark, str(path), MATCHES.names, required, known).where("n > 0").collect()}
    assert fault in found if fault else not found


def test_submission(spark, tmp_path):
    (tmp_path / "m.tsv").write_text(GOOD, encoding="utf-8")
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n", encoding="utf-8")
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    issues = validate.check_submission(spark, str(tmp_path / "m.tsv"), str(tmp_path / "c.tsv"), required).where("n > 0").collect()
    assert [(r.check, r.examples) for r in issues] == [("warning:not_a_candidate", ["S1-1"])]
    missing = validate.check_submission(spark, str(tmp_path / "m.tsv"), str(tmp_path / "none.tsv"), required)
    assert validate.is_valid(missing) and missing.where("check like 'warning%' and n > 0").count() == 1
    assert CANDIDATES.names[1] == "candidate_entity_ids"


def test_integrity(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "entity_id string")
    assert validate.columns_differ(ids("a"), ["entity_id", "b"]) == ["b"]
    got = {r.check: (r.n, r.examples) for r in validate.check_source(ids("S1-1", "S1-1", "S1-1", " ", "X-1"), "S1-").collect()}
    assert got == {"empty_key": (1, [" "]), "wrong_prefix": (2, [" ", "X-1"]), "duplicate_key": (2, ["S1-1"])}
    with pytest.raises(ValueError, match="duplicate_key"):
        validate.raise_on(validate.check_source(ids("S1-1", "S1-1"), "S1-"))


def test_profile_and_pipelines(spark, tmp_path):
    found = entities.entities(spark, "/root/testdata/sf0.01").cache()
    truth = entities.truth(spark, found).cache()
    s1, s2, s3 = (found.where(f"source = {i}").select(*ENTITY.names) for i in (1, 2, 3))
    ready = pipelines.prepare(s1, s2, s3, truth)
    assert "# Data profile" in ready.report and "## 10." in ready.report
    parts = ready.parts.cache()
    done = pipelines.train(pipelines.A, s1, s2.unionByName(s3), truth, parts, settings=model.Settings(trees=5, depth=3, least_in_leaf=5))
    assert done.macro_f05 > 0.7 and done.sweep.count() == 91
    matching, candidates = pipelines.submit(pipelines.A, done.model, done.threshold, s1, s2.unionByName(s3))
    pipelines.write_submission(matching, candidates, str(tmp_path))
    assert matching.count() == candidates.count() == s1.count()
    folder = lambda name: str(next((tmp_path / name).glob("part-*")))
    assert validate.is_valid(validate.check_submission(spark, folder("matching_results.tsv"), folder("candidate_pairs.tsv"), s1))
    few, targets, links = pipelines.dry_run(s1, s2, s3, truth, targets=50, most=30, singletons=5)
    assert few.count() <= 30 and targets.count() == 100 and links.count() > 0
    swept, k = pipelines.sweep_blocking(pipelines.A, s1, s2.unionByName(s3), truth, (5, 10))
    assert swept.count() == 2 and (k is None or k in (5, 10))


def test_stream(spark, tmp_path):
    found = entities.entities(spark, SF)
    s1, targets = (profile_a.normalise(x).cache() for x in entities.sides(found))
    entities.sides(found)[0].select(*ENTITY.names).repartition(3).write.parquet(str(tmp_path / "in"))
    arrivals.start_matching(arrivals.arriving(spark, str(tmp_path / "in"), 1), targets, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("s1_id", "tgt_id", "rk")
    want = blocking.candidates_a(s1, targets).select("s1_id", "tgt_id", "rk")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_contract(spark):
    assert __spark_entry__.entry(spark).count() > 0
    found, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(found) and len(found) > 50
    assert profiler.TEXT_FIELDS
