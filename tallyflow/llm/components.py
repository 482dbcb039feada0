"""Connected components of a distributed edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import staged

#: Edges that one task contracts at a time.
_CHUNK = 1 << 18


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node connected with it) of the edges a-b."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        np.minimum.at(label, before, label)  # the old root follows
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            return nodes, nodes[label]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a chunk as a star around the smallest node of each part."""
    a, b, n = [], [], 0

    def stars():
        node, root = roots(np.concatenate(a), np.concatenate(b))
        away = node != root
        return pa.RecordBatch.from_arrays([pa.array(node[away]), pa.array(root[away])], ["a", "b"])

    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        n += batch.num_rows
        if n >= _CHUNK:
            yield stars()
            a, b, n = [], [], 0
    if n:
        yield stars()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long, not null):
    label is the smallest node reachable. Staged.

    Chunks of edges are contracted to stars first; then labels spread: each
    round a node takes the smallest label among its neighbours, and the label
    of that label, so long paths shorten by half at least. A round is a few
    joins of staged tables on unique nodes, whose other side may be a hub:
    AQE splits such a partition.
    """
    stars = staged(edges.mapInArrow(_contract, "a long, b long").distinct(), "components_edges")
    if stars.isEmpty():
        return stars.select(F.col("a").alias("node"), F.col("b").alias("label"))
    both = staged(stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))), "components_both")
    labels = staged(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")),
        "components_labels",
    )
    while True:
        around = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = staged(
            labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")),
            "components_lower",
        )
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("far"))
        labels = staged(
            lower.join(jump, "label").select("node", F.col("far").alias("label"), (F.col("far") != F.col("old")).alias("changed")),
            "components_labels",
        )
        if labels.where("changed").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
