"""Connected components of links between numbered nodes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import kept


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least of the numbers that links lead to."""
    label = np.arange(n)
    while len(i):
        before = label.copy()
        np.minimum.at(label, i, before[j])
        np.minimum.at(label, j, before[i])
        label = label[label]
        if (label == before).all():
            break
    return label


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``links`` (a, b); component is the
    least node that can be reached.

    Each round a node takes the least label around it and then the label of
    that label. The neighbours of a node are never gathered, labels are
    combined before they are shuffled, and every round is written out.
    """
    both = kept(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges")
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    before = None
    while True:
        around = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "component")
        near = labels.union(around).groupBy("node").agg(F.min("component").alias("component"))
        far = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        labels = kept(near.join(far, "component", "left").select("node", F.least("component", "next").alias("component")), "labels")
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)")), F.count(F.lit(1))).first()
        if now == before or not now[1]:
            return labels
        before = now
