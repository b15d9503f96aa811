"""Arriving reference records, matched batch by batch against known targets.

The batch operators run unchanged on each micro-batch: blocking needs no state beyond the targets. A batch writes into a
folder of its own and overwrites it when it is run again, so a restart after a failure leaves each record once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import blocking, profile_a
from tessera.shipping import ship
from tessera.sources.schema import ENTITY, filled


def arriving(spark: SparkSession, folder: str, files_at_once: int = 8) -> DataFrame:
    """A stream of entities from the Parquet files that appear in a folder."""
    return spark.readStream.schema(ENTITY).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def start_matching(stream: DataFrame, targets: DataFrame, out: str, checkpoint: str, k: int = blocking.TOP_K, most: int = blocking.MOST_IN_BUCKET) -> StreamingQuery:
    """Candidates (s1_id, tgt_id, pre_score, rk) of each batch against normalised `targets`, into out/batch=<n>."""
    ship(stream.sparkSession)

    def match(batch: DataFrame, number: int) -> None:
        s1 = profile_a.normalise(filled(batch, *ENTITY.names).dropDuplicates(["entity_id"]))
        blocking.candidates_a(s1, targets, k, most).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(match).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
