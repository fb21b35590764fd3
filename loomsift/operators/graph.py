"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.lineage import unwritten, written


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the least id reachable for each id of the edges (x, y).

    Each round takes the least label of the neighbours and then that label's own label, so the number of rounds grows
    with the logarithm of the longest path. Every round is a written table.
    """
    both = written(edges.select("x", "y").union(edges.select("y", "x")).toDF("u", "v").distinct(), "graph-edges")
    labels = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("comp")).withColumnRenamed("u", "id"), "graph-labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "v"), "v").groupBy("u").agg(F.min("comp").alias("near"))
        step = labels.join(near.withColumnRenamed("u", "id"), "id").select("id", "comp", F.least("comp", "near").alias("low"))
        jump = step.join(labels.select(F.col("id").alias("low"), F.col("comp").alias("next")), "low", "left")
        low = F.coalesce("next", "low")
        new = written(jump.select("id", low.alias("comp"), (low != F.col("comp")).alias("moved")), "graph-labels")
        unwritten(labels)
        labels = new
        if labels.where("moved").limit(1).count() == 0:
            unwritten(both)
            return labels.select("id", "comp")
