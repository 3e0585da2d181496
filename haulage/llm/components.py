"""Connected components by contraction, for edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.llm.common import store


def normal(edges: DataFrame) -> DataFrame:
    """Distinct edges (a < b) without loops."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of the edge table (a, b long).

    Each pass replaces every node by its smallest neighbour (or itself) and
    keeps the edges that still join different labels. With labels in random
    order, as hashes are, the number of nodes falls by a constant factor a
    pass. Both tables of a pass are written to the shared folder, so the plan
    stays short and a lost executor costs one pass at most.
    """
    edges = store(normal(edges), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    comp = both.select(F.col("a").alias("node")).distinct().withColumn("comp", F.col("node"))
    while True:
        label = store(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("label")), "labels")
        comp = (comp.join(label, comp["comp"] == label["a"], "left")
                .select("node", F.coalesce("label", "comp").alias("comp")))
        left, right = label.toDF("a", "la"), label.toDF("b", "lb")
        edges = store(normal(edges.join(left, "a").join(right, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))), "edges")
        if edges.isEmpty():
            return store(comp, "components")
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
