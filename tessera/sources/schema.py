"""Schemas. Every data column is text; a missing value is the empty string, never null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


ENTITY = strings("entity_id", "business_name", "business_address", "country")
TRUTH = strings("source1_entity_id", "matched_entity_ids")
MATCHES = strings("source1_entity_id", "matched_entity_ids")
CANDIDATES = strings("source1_entity_id", "candidate_entity_ids")
RUN_LOG = StructType([StructField(n, StringType()) for n in ("run_at", "name", "status", "notes")])
#: Prefix of the identifiers of each source.
PREFIX = {"s1": "S1-", "s2": "S2-", "s3": "S3-"}


def filled(df: DataFrame, *names: str) -> DataFrame:
    """`df` with empty strings for nulls in the named columns, or in all."""
    return df.withColumns({n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names or df.columns})
