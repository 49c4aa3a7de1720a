"""Connected components of an edge list: within partitions first, then by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.workspace import stored

MOST_EDGES = 1 << 20


def _least(edges: DataFrame) -> DataFrame:
    """(a, m): the smallest b of each a. Stored, so that both sides of the joins with it can be split where a node has many edges."""
    return stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node joins its larger neighbours to its smallest neighbour (or itself). All edges lead to smaller nodes."""
    least = _least(edges.union(edges.select("b", "a")))
    up = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return up.join(least.select("a", F.least("a", "m").alias("m")), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node joins its smaller neighbours, and itself, to the smallest of them. All edges lead to smaller nodes."""
    least = _least(edges)
    joined = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.union(least.select("a", F.col("m").alias("b")))


def least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest that edges (a, b) connect it to."""
    label = np.arange(n)
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def _stars(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Edges as stars: each node with the smallest that these edges connect it to."""
    table = pa.Table.from_batches(batches).combine_chunks()
    both = pa.concat_arrays([c for name in "ab" for c in table.column(name).chunks]).dictionary_encode()
    order = pc.sort_indices(both.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    codes = rank[both.indices.to_numpy()]
    label = least_labels(codes[: table.num_rows], codes[table.num_rows :], len(order))
    nodes = np.flatnonzero(label != np.arange(len(order)))
    return pa.RecordBatch.from_arrays([both.dictionary.take(pa.array(order[nodes])), both.dictionary.take(pa.array(order[label[nodes]]))], names=["a", "b"])


def _collapsed(most_edges: int):
    """The edges of a partition as stars, of about ``most_edges`` edges at a time."""

    def run(batches):
        rows, n = [], 0
        for batch in batches:
            if batch.num_rows:
                rows.append(batch)
                n += batch.num_rows
            if n >= most_edges:
                yield _stars(rows)
                rows, n = [], 0
        if rows:
            yield _stars(rows)

    return run


def _are_stars(edges: DataFrame) -> bool:
    """Whether each a has one b, and no b is an a."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("n"), F.lit(0).alias("m")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("n"), F.lit(1).alias("m")))
    per = ends.groupBy("node").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    return not per.where("n > 1 OR n > 0 AND m > 0").limit(1).count()


def components(edges: DataFrame, *, most_edges: int = MOST_EDGES) -> DataFrame:
    """(node, label): for each node of ``edges`` (a, b, of one type), the smallest node that it is connected to.

    Each partition is collapsed to stars by itself, ``most_edges`` at a time, which settles short edge lists of one
    partition. Otherwise rounds of star steps follow, each written to the shared folder; their number grows with the logarithm of a component's size.
    Edges from a node to itself and repeated edges do no harm; an empty list gives no rows.
    """
    own = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = stored(own.mapInArrow(_collapsed(most_edges), own.schema), "edges")
    mark = None
    while not _are_stars(now):
        now = stored(_large_star(now).distinct(), "edges")
        now = stored(_small_star(now).distinct(), "edges")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
