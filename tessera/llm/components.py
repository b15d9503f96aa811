"""Connected components of a table of links, in rounds of joins over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stash


def components(links: DataFrame) -> DataFrame:
    """id, component (the least id reachable) of every id in `links` (a, b).

    Each round takes the least label among neighbours and then the label of that label, until none changes. Counts are
    all that reaches the driver. Links may repeat: they meet in aggregates only.
    """
    both = stash(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stash(both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("id"), F.least("a", "near").alias("component")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        stepped = stash(labels.join(seen, F.col("id") == F.col("a")).select("id", F.col("component").alias("was"), F.least("component", "near").alias("component")), "labels")
        over = stepped.select(F.col("id").alias("component"), F.col("component").alias("further"))
        jumped = stash(stepped.join(over, "component").select("id", "was", F.least("component", "further").alias("component")), "labels")
        if jumped.where("component < was").isEmpty():
            return jumped.select("id", "component")
        labels = jumped.select("id", "component")
