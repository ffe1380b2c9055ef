"""Connected components of a link table, as Spark joins.

Each round gives every vertex the neighbour (or itself) of least priority,
replaces both ends of every link by it, and drops loops and repeats; the
priorities are hashed anew each round so that long chains shrink by a constant
factor. Links of a hub are only ever grouped under a minimum (combined before
the shuffle) or joined (skewed partitions are split); no vertex's links are
gathered, and rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import materialize


def component_labels(links: DataFrame) -> DataFrame:
    """(vertex, label) for every vertex of ``links`` (two columns a, b):
    vertices have the same label if and only if links connect them. The label
    is one of the component's vertices."""
    edges = materialize(links.select("a", "b").filter("a <> b").distinct(), "edges")
    labels, round_no = None, 0
    while not edges.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(round_no)).alias("p"), F.col(c).alias("v"))  # noqa: E731, B023
        both = edges.select(F.col("a").alias("u"), rank("b").alias("n")).unionAll(
            edges.select(F.col("b").alias("u"), rank("a").alias("n")))
        step = materialize(both.groupBy("u").agg(F.min("n").alias("n"))
                           .select("u", F.least(F.col("n"), rank("u"))["v"].alias("to")), "step")
        if labels is None:
            labels = step.select(F.col("u").alias("vertex"), F.col("to").alias("label"))
        else:
            labels = labels.join(step, F.col("label") == F.col("u"), "left").select(
                "vertex", F.coalesce("to", "label").alias("label"))
        left = step.select(F.col("u").alias("a"), F.col("to").alias("a2"))
        right = step.select(F.col("u").alias("b"), F.col("to").alias("b2"))
        moved = edges.join(left, "a").join(right, "b").filter("a2 <> b2")
        edges = materialize(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
                            .distinct(), "edges")
        round_no += 1
    if labels is None:
        kind = links.schema["a"].dataType
        return links.select(F.col("a").cast(kind).alias("vertex"), F.col("a").alias("label")).filter(F.lit(False))
    return materialize(labels, "labels")


class Forest:
    """Union of links among 0..n-1 inside a task, vectorised."""

    def __init__(self, n: int):
        import numpy as np

        self.np, self.parent = np, np.arange(n)

    def roots(self, x):
        p = self.parent
        r = p[x]
        while (q := p[r]).tobytes() != r.tobytes():
            r = q
        return r

    def union(self, a, b) -> None:
        np = self.np
        while len(a):
            a, b = self.roots(a), self.roots(b)
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
