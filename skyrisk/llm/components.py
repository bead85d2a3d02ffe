"""Connected components of links, by joins and aggregations alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.shared import landed

CHUNK = 200_000  # links that a task contracts at once


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of a chunk of links with the smallest node that the chunk connects it with."""
    above: dict[int, int] = {}

    def root(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    def stars() -> pa.RecordBatch:
        nodes = np.fromiter(above, np.int64, len(above))
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([root(int(i)) for i in nodes], pa.int64())], ["a", "b"])

    links = 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            p, q = root(above.setdefault(a, a)), root(above.setdefault(b, b))
            above[max(p, q)] = min(p, q)
        links += batch.num_rows
        if links >= CHUNK:
            yield stars()
            above.clear()
            links = 0
    if above:
        yield stars()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); the component is its smallest
    node. Tasks first contract the links they hold to stars, which leaves few rounds. Each round
    takes the least label among neighbours, then the label's own label, so that chains shorten
    by half. Labels of a node met by thousands of links are aggregated before they are shuffled.
    Null ends are no nodes; links may repeat, have any order or lead to themselves; without
    links there are no nodes."""
    ends = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).dropna()
    stars = ends.mapInArrow(_contracted, "a long, b long")
    pair = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = landed(stars.select(F.inline(pair)).distinct(), "links")
    labels = landed(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        .select("node", F.least("node", "least").alias("component")), "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        )
        better = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        new = landed(
            better.join(jump, "component").select("node", F.least("component", "next").alias("component"), "old"), "labels"
        )
        labels = new.select("node", "component")
        if new.where(F.col("component") != F.col("old")).isEmpty():
            return labels
