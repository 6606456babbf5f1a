"""Connected components of links between numbered nodes, in a few joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import materialize_rows


def labelled(links: DataFrame) -> DataFrame:
    """Rows (node, label) for every node of ``links`` (a, b); label: its component's least node.

    Each round a node takes the least label around it and then the label of that label,
    so paths shorten by half. Labels are written every round; they are never gathered.
    Give a written table: it is counted first.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rows = 2 * links.count()
    both = materialize_rows(both.distinct(), "links", rows)
    state = materialize_rows(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least")).select(
            "node", F.least("node", "_least").alias("label")
        ),
        "labels",
        rows,
    )
    while True:
        around = (
            both.join(state.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("_around"))
        )
        least = state.join(around.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("_old"), F.least("label", "_around").alias("_label")
        )
        onward = state.select(F.col("node").alias("_label"), F.col("label").alias("_onward"))
        state = materialize_rows(
            least.join(onward, "_label").select("node", "_old", F.least("_label", "_onward").alias("label")), "labels", rows
        )
        if state.filter(F.col("_old") != F.col("label")).isEmpty():
            return state.select("node", "label")
