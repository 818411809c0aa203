"""Connected components of an edge table, in rounds over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node that can be reached; nodes are those of ``edges`` (a, b).

    Every round gives each node the smallest of its neighbours and itself, then that node's own choice, and contracts
    the edges to the chosen nodes; edges inside a contracted group are gone, so the table shrinks quickly. Rounds end when
    no edge is left.
    """
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    edges = stored(edges.filter("a <> b").select(*ordered("a", "b")).distinct(), "component-edges")
    labels = None
    while True:
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        near = stored(ends.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("near")), "component-near")
        far = near.select(F.col("node").alias("f_node"), F.col("near").alias("f_near"))
        step = stored(near.join(far, F.col("near") == F.col("f_node")).select(F.col("node").alias("s_node"), F.col("f_near").alias("s_label")), "component-step")
        if labels is None:
            labels = step.select(F.col("s_node").alias("node"), F.col("s_label").alias("label"))
        else:
            moved = labels.join(step, F.col("label") == F.col("s_node"), "left")
            labels = stored(moved.select("node", F.coalesce("s_label", "label").alias("label")), "component-labels")
        one, two = (step.select(F.col("s_node").alias(f"{x}_node"), F.col("s_label").alias(f"{x}_label")) for x in "xy")
        edges = stored(
            edges.join(one, F.col("a") == F.col("x_node")).join(two, F.col("b") == F.col("y_node")).filter("x_label <> y_label")
            .select(*ordered("x_label", "y_label")).distinct(),
            "component-edges",
        )
        if edges.isEmpty():
            return labels
