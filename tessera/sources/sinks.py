"""Sinks: result files, identifier lists, run log, models, metadata, reports."""

from __future__ import annotations

import json
from datetime import UTC, datetime
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.schema import RUN_LOG


def match_lists(spine: DataFrame, pairs: DataFrame) -> DataFrame:
    """source1_entity_id, matched_entity_ids: a sorted comma list for every id of `spine` (s1_id), empty without pairs."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("tgt_id")), ",").alias("ids"))
    return spine.select("s1_id").join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


def candidate_lists(spine: DataFrame, candidates: DataFrame) -> DataFrame:
    """source1_entity_id, candidate_entity_ids: a comma list by rank for every id of `spine`."""
    ranked = F.transform(F.array_sort(F.collect_list(F.struct("rk", "tgt_id"))), lambda c: c["tgt_id"])
    lists = candidates.groupBy("s1_id").agg(F.array_join(ranked, ",").alias("ids"))
    return spine.select("s1_id").join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("candidate_entity_ids"))


def write_tsv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Tab-separated text with truly empty cells; `files`: into so many, for results that are one file by contract."""
    (df.coalesce(files) if files else df).write.mode("overwrite").options(sep="\t", header=True, emptyValue="", quote="").csv(path)


def write_ids(ids: DataFrame, path: str) -> None:
    """entity_id, sorted, one a line."""
    ids.select(F.col("entity_id").alias("value")).orderBy("value").coalesce(1).write.mode("overwrite").text(path)


def append_run(spark: SparkSession, path: str, name: str, status: str, **notes: object) -> None:
    """One row more in the run log; all writers share its schema, details go to `notes` as JSON."""
    row = (datetime.now(UTC).isoformat(), name, status, json.dumps(notes, sort_keys=True, default=str))
    spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_json(path: str, **values: object) -> None:
    """Small metadata, such as a threshold, beside a model."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(values, indent=2, sort_keys=True, default=str), encoding="utf-8")


def read_json(path: str) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def markdown(title: str, table: DataFrame, most: int = 500) -> str:
    """A small result as a Markdown table; at most `most` rows are shown."""
    rows = table.limit(most).collect()
    lines = [f"## {title}", "", "| " + " | ".join(table.columns) + " |", "|" + "---|" * len(table.columns)]
    return "\n".join([*lines, *("| " + " | ".join("" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v) for v in r) + " |" for r in rows), ""])
