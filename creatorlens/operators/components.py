"""Connected components of links between numbered nodes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialize
from .joins import lookup_join

#: Links that one task follows to the end. Beyond, rounds over all of them shorten the ways.
LINKS_TOGETHER = 1_000_000


def components(links: DataFrame, *, together: int = LINKS_TOGETHER) -> DataFrame:
    """A written table (node, label) for every node of ``links`` (a, b); label: its component's least node.

    Each round first links every greater neighbour of a node with the least node around it,
    then every smaller one, and drops repeated links; components stay what they are and
    become stars around their least nodes in a number of rounds near the logarithm of their
    longest way. Rounds end when no link changes or when the links left fit one task, which
    joins them up. A node with very many links is many rows, never one.
    """
    now = _written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b"))
    while (many := now.count()) > together:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_around")).select("a", F.least("a", "_around").alias("_least"))
        greater = now.select(F.col("b").alias("a"), F.col("a").alias("_to"))  # every node with its greater neighbours
        out = lookup_join(greater, materialize(least, "least"), "a", how="inner")
        wide = _written(out.select(F.col("_to").alias("a"), F.col("_least").alias("b")))
        least = materialize(wide.groupBy("a").agg(F.min("b").alias("_least")), "least")
        back = lookup_join(wide, least, "a", how="inner")
        moved = back.select(F.col("b").alias("a"), F.col("_least").alias("b")).filter("a <> b")
        after = _written(moved.unionByName(least.select("a", F.col("_least").alias("b"))))
        if after.count() == many and after.join(now, ["a", "b"], "left_anti").isEmpty():
            stars = after.unionByName(after.select(F.col("b").alias("a"), "b"))
            return materialize(stars.select(F.col("a").alias("node"), F.col("b").alias("label")).distinct(), "components")
        now = after
    return materialize(now.coalesce(1).mapInPandas(_joining_up(), "node long, label long"), "components")


def _written(links: DataFrame) -> DataFrame:
    return materialize(links.distinct(), "links")


def _joining_up():
    """A function of its own for tasks: nothing of this package is imported there."""

    def join_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        parts = [batch[["a", "b"]].to_numpy("int64") for batch in batches]
        if not parts:
            return
        nodes, ends = np.unique(np.concatenate(parts), return_inverse=True)
        del parts
        a, b = ends.reshape(-1, 2).T
        above = np.arange(len(nodes))  # places follow the numbers, so the least place is the least node
        while len(apart := np.flatnonzero(above[a] != above[b])):
            a, b = a[apart], b[apart]
            np.minimum.at(above, np.maximum(above[a], above[b]), np.minimum(above[a], above[b]))
            while not np.array_equal(above, higher := above[above]):
                above = higher
        for start in range(0, len(nodes), 100_000):
            here = slice(start, start + 100_000)
            yield pd.DataFrame({"node": nodes[here], "label": nodes[above[here]]})

    return join_up
