"""Approximate nearest neighbours by the largest inner product, with collision counting over sorted projections.

Vectors are scaled by the longest one and given one more entry that makes them unit vectors; with unit queries, whose
entry there is 0, the nearest vector is then the one with the largest inner product. A block of vectors is projected on
random directions, each with a sorted array of its own. A window around the query's own projection grows with a radius,
from one radius to the next (virtual rehashing: the arrays stay as they are), and a vector that has been in the windows
of enough directions is verified, by its exact inner product. The search in a block ends when ``k`` verified vectors
lie within the radius: a vector within it has been in enough windows but for the probability ``miss``. The last windows
hold the whole block, so that a search always ends.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.vectors import best, matrix, usable

FOUND = "row long, query_id long, vec_id long, score double, block long"
DIRECTIONS, CAUGHT, MISS = 96, 0.5, 0.15
#: The first radius, as a share of that of usual vectors, how it grows, and the vectors of a block that tell what is usual.
START, GROWTH, PROBES = 0.85, 1.12, 16


def enough(directions: int, caught: float, miss: float) -> int:
    """The most collisions out of ``directions`` that are reached but for ``miss``, each having the probability ``caught``."""
    below = 0.0
    for n in range(directions + 1):
        below += math.comb(directions, n) * caught**n * (1 - caught) ** (directions - n)
        if below > miss:
            return max(1, n)
    return directions


def axes(dimensions: int, directions: int, seed: int) -> np.ndarray:
    """Random directions as columns, orthogonal to each other as far as the dimensions go, as long as normal vectors are.

    A projection on one is normally distributed, as on any normal vector; together they say more about a distance.
    """
    draw, found = np.random.default_rng(seed), []
    while len(found) * dimensions < directions:
        normal = draw.standard_normal((dimensions, dimensions))
        found.append(np.linalg.qr(draw.standard_normal((dimensions, dimensions)))[0] * np.sqrt((normal * normal).sum(0)))
    return np.concatenate(found, axis=1)[:, :directions]


class Index:
    """Sorted projections of a block of vectors, the longest of all vectors being ``longest``."""

    def __init__(self, vectors: np.ndarray, longest: float, k: int, directions: int, caught: float, miss: float, seed: int):
        self.vectors, self.longest = vectors, longest
        scaled = vectors / longest
        last = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(1)))
        self.axes = axes(vectors.shape[1] + 1, directions, seed)
        places = np.ascontiguousarray((scaled @ self.axes[:-1] + last[:, None] * self.axes[-1]).T)
        # the arrays stand one after the other in one, so far apart that a window lies in its own
        self.apart = np.arange(directions) * (4 * float(np.abs(places).max(initial=0)) + 4 * float(np.abs(self.axes).sum(0).max()))
        order = np.argsort(places, axis=1)
        self.order = order.astype(np.int32).ravel()
        self.sorted = (np.take_along_axis(places, order, 1) + self.apart[:, None]).ravel()
        self.first = np.arange(directions) * len(vectors)
        self.enough = enough(directions, caught, miss)
        self.half = NormalDist().inv_cdf((1 + caught) / 2)
        probes = vectors[:: math.ceil(len(vectors) / PROBES)]
        lengths = np.sqrt((probes * probes).sum(1))
        near = np.partition(probes @ vectors.T, max(0, len(vectors) - k - 1), axis=1)[:, max(0, len(vectors) - k - 1)]
        self.start = START * float(np.median(self.reach(near, lengths)))

    def reach(self, scores, length):
        """The distance, among unit vectors, that goes with an inner product with a query of that length."""
        return np.sqrt(np.maximum(0, 2 - 2 * scores / (length * self.longest)))

    def nearest(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Verified vectors and their inner products with ``query``, ``k`` of them within the last radius; ``own`` is left out.

        The radius grows by steps, and not beyond that of the k-th nearest vector verified so far.
        """
        n, length = len(self.vectors), math.sqrt(float((query * query).sum()))
        places = query / length @ self.axes[:-1] + self.apart
        counts, done = np.zeros(n, np.int64), np.zeros(n, bool)
        if own is not None:
            done[own] = True
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        begin = end = None
        radius = self.start
        while True:
            lo, hi = self.first, self.first + n
            if radius < 2:
                lo = np.searchsorted(self.sorted, places - self.half * radius, "left").clip(lo, hi)
                hi = np.searchsorted(self.sorted, places + self.half * radius, "right").clip(lo, hi)
            if radius >= 2 or (hi - lo).sum() >= self.enough * min(k, n):  # else too few for k vectors to have collided enough
                if begin is None:
                    runs = [(a, b) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                else:
                    runs = [x for a, b, c, d in zip(lo.tolist(), begin.tolist(), end.tolist(), hi.tolist(), strict=True) for x in ((a, b), (c, d))]
                begin, end = lo, hi
                counts += np.bincount(np.concatenate([self.order[a:b] for a, b in runs], dtype=np.int64), minlength=n)
                new = np.flatnonzero((counts >= self.enough) & ~done)
                done[new] = True
                found, scores = np.concatenate([found, new]), np.concatenate([scores, (self.vectors[new] * query).sum(1)])
            if radius >= 2:
                return found, scores
            wider = max(0.01, radius * GROWTH)
            if len(scores) >= k:
                reach = float(self.reach(np.partition(scores, -k)[-k], length))
                if reach <= radius:
                    return found, scores
                wider = min(wider, reach)
            radius = wider


def _probe(longest: float, k: int, directions: int, caught: float, miss: float, seed: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:  # a side without rows comes without columns
            return pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("block", pa.int64())]).empty_table()
        index = Index(matrix(vectors.column("vector")), longest, k, directions, caught, miss, seed)
        wanted = matrix(queries.column("asked_vector"))
        place = {r: n for n, r in enumerate(vectors.column("row").to_pylist())}
        ids = vectors.column("id").combine_chunks()
        known, numbers = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        out = []
        for n, (row, query) in enumerate(zip(queries.column("asked_row").to_pylist(), wanted, strict=True)):
            found, scores = index.nearest(query, k, place.get(row))
            first = np.lexsort((numbers[found], ~known[found], -scores))[:k]
            out.append((np.full(len(first), n), found[first], scores[first]))
        who, found, scores = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table(
            {
                "row": queries.column("asked_row").take(pa.array(who)),
                "query_id": queries.column("asked_id").take(pa.array(who)),
                "vec_id": vectors.column("id").take(pa.array(found)),
                "score": pa.array(scores),
                "block": pa.array(np.full(len(who), vectors.column("block")[0].as_py(), np.int64)),
            }
        )

    return run


def search(
    df: DataFrame, asks: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 65_536, part_rows: int = 512,
    directions: int = DIRECTIONS, caught: float = CAUGHT, miss: float = MISS, seed: int = 7,
) -> DataFrame:
    """The ``k`` nearest vectors of each query: query_id, rank, vec_id, score (the inner product, in doubles).

    Queries are the rows for which ``asks``, a condition on ``id``, holds; candidates are all rows but the query's own.
    All vectors are dealt evenly into blocks of about ``block_rows``, and queries into parts of ``part_rows``; each part
    is taken to each block. Windows hold a vector at the radius with the probability ``caught`` in each of the
    ``directions``; the share of true neighbours that are missed is ``miss`` at most, and less for nearer ones.

    Ties rank by id, null ids last. Vectors that cannot be computed with, or hold zeros only, take no part (see
    ``usable``). Rows that repeat an id or a vector are rows of their own: each is found, and each asks. Null ids are
    found but do not ask. Tables with fewer rows give all candidates; an empty one no rows. Other columns are not read.
    """
    rows = usable(df, id_col=id_col, vector_col=vector_col, nonzero=True)
    wide = F.transform("vector", lambda v: v.cast("double"))
    length = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, v: a + v * v))
    n, n_asked, longest = rows.agg(F.count(F.lit(1)), F.count_if(asks), F.max(length)).first()
    if not n_asked:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks, parts = math.ceil(n / block_rows), math.ceil(n_asked / part_rows)
    deal = lambda salt, into: F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(into).cast("long"))
    vectors = rows.withColumn("block", deal("block", blocks)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("part", F.col("part").cast("long"))
    queries = rows.where(asks).withColumn("part", deal("part", parts)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    tasks = min(blocks * parts, max(256, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    columns = ["block", "part", "row", "id", "vector"]
    left = vectors.select(columns).repartition(tasks, "block", "part").groupBy("block", "part")
    # both sides come from one table: other names keep their columns apart
    right = queries.select(*(F.col(c).alias(f"asked_{c}") for c in columns)).repartition(tasks, "asked_block", "asked_part").groupBy("asked_block", "asked_part")
    found = left.cogroup(right).applyInArrow(_probe(float(longest), k, directions, caught, miss, seed), FOUND)
    ranked = best(found, ["row", "query_id"], [F.desc("score"), F.asc_nulls_last("vec_id")], k, "block")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
