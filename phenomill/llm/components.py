"""Connected components of an edge table.

Each task first reduces its edges to stars (child, root). Then rounds follow: all rows of a child
meet in one task, which unites their roots, and a join lifts each root to its own root. A child has at
most one row from each task, so only roots can be hot; that join is a plain sort-merge join of two
scans, whose large keys adaptive execution splits. Each round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenomill.llm.common import written

STAR = "child long, root long"
EDGES_AT_ONCE = 4_000_000


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes of the edges, ascending, and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        open_ = low != high
        if not open_.any():
            return nodes, nodes[root]
        np.minimum.at(root, high[open_], low[open_])
        while not np.array_equal(jumped := root[root], root):
            root = jumped


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    child = root = np.empty(0, dtype=np.int64)
    for batch in batches:
        child = np.concatenate([child, batch.column(0).to_numpy(zero_copy_only=False)])
        root = np.concatenate([root, batch.column(1).to_numpy(zero_copy_only=False)])
        if len(child) > EDGES_AT_ONCE:
            nodes, roots = local_roots(child, root)
            child, root = nodes[nodes != roots], roots[nodes != roots]
    nodes, roots = local_roots(child.astype(np.int64), root.astype(np.int64))
    apart = nodes != roots
    yield pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(roots[apart])], ["child", "root"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that isn't the smallest of its component.

    ``edges`` has two long columns of any names; nulls are not allowed, loops and repeats do no harm.
    Without edges the result is empty.
    """
    star = written(edges.mapInArrow(stars, STAR), "cc-start")
    while True:
        merged = written(star.repartition("child").mapInArrow(stars, STAR), "cc-merged")
        parent = written(merged.groupBy("child").agg(F.min("root").alias("root")), "cc-parent")
        up = parent.select(F.col("child").alias("root"), F.col("root").alias("above"))
        star = written(
            merged.join(up, "root", "left").select(
                "child", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("lifted")
            ),
            "cc-lifted",
        )
        lifted = star.where("lifted").limit(1).count()
        if not lifted and merged.count() == parent.count():
            return parent.select(F.col("child").alias("node"), F.col("root").alias("component"))
        star = star.select("child", "root")
