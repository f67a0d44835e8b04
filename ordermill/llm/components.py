"""Connected components of links by minimum labels, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable id (``component``) of every ``id`` that occurs in ``links`` (``a``, ``b``).

    In each round a vertex learns the smallest label of its neighbours, tells it to the vertex that it has
    as label, and takes over the label that this one had. Labels are joined and reduced by key with partial
    aggregation, so a vertex with very many links costs no task more than its share.
    """
    both = written(
        links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .union(links.select(F.col("b").alias("src"), F.col("a").alias("dst")))
        .distinct(),
        "links",
    )
    first = both.groupBy("src").agg(F.min("dst").alias("near"))
    labels = written(first.select(F.col("src").alias("id"), F.least("src", "near").alias("label")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "dst"), "dst").groupBy("src").agg(F.min("label").alias("near"))
        )
        known = labels.join(near.withColumnRenamed("src", "id"), "id")
        told = known.select(
            F.explode(F.array(F.struct("id", "near"), F.struct(F.col("label").alias("id"), "near"))).alias("told")
        )
        best = told.select("told.*").groupBy("id").agg(F.min("near").alias("near"))
        above = labels.select(F.col("id").alias("label"), F.col("label").alias("upper"))
        least = F.least("label", "near", "upper")
        moved = labels.join(best, "id", "left").join(above, "label").select("id", least.alias("label"), F.col("label").alias("old"))
        labels = written(moved, "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
        labels = labels.drop("old")
