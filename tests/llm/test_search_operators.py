"""Whitening, lexical search and neighbour search against brute force on small tables."""

import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_corpus_operators import LONG, TEXTS, table

from tributary.llm import lexical, neighbours, queries, vectors, whitening

VECTORS = "vec_id long, embedding array<float>, label int, row string, id string, vector string, block int, part int, rank int"
ODD = [None, [], [1.0, None, 0.0, 0.0], [math.nan, 0.0, 0.0, 0.0], [0.0, math.inf, 0.0, 0.0], [1.0, 2.0], [2.0**46, 0.0, 0.0, 0.0]]


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "r", "i", "v", 1, 2, 3) for i, v in rows], VECTORS)


def clustered(n, d, seed, groups=7):
    draw = np.random.default_rng(seed)
    found = draw.standard_normal((groups, d))[draw.integers(0, groups, n)] + 0.7 * draw.standard_normal((n, d))
    return (found * draw.uniform(0.2, 2, n)[:, None]).astype(np.float32).astype(float)


# Whitening.


@pytest.mark.parametrize("kind", ["apart", "clusters", "equal", "low rank", "zeros", "wide range"])
def test_eigenvectors_have_double_precision(kind):
    draw, d = np.random.default_rng(3), 40
    q = np.linalg.qr(draw.standard_normal((d, d)))[0]
    values = {
        "apart": np.linspace(1, 80, d),
        "clusters": np.concatenate([5 + 1e-9 * np.arange(10), 5 + 1e-5 * np.arange(1, 11), np.linspace(10, 20, 20)]),
        "equal": np.repeat([3.0, 7.0], d // 2),
        "low rank": np.concatenate([np.zeros(30), np.linspace(1, 2, 10)]),
        "zeros": np.zeros(d),
        "wide range": 10.0 ** np.linspace(-8, 4, d),
    }[kind]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    found, vecs = whitening.eigen(a)
    wide, x = a.astype(np.longdouble), vecs.astype(np.longdouble)
    assert (np.diff(found) <= 0).all()
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-14
    assert np.abs(wide @ x - x * found).max() <= 4e-16 * max(1e-300, np.abs(a).max()) * math.sqrt(d)
    assert np.allclose(found, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=1e-13 * max(1, np.abs(a).max()))


def test_clusters_are_solved_within_their_space():
    """Float32 cannot tell the close values apart at all; the sub-solve does, to the last digits."""
    draw, d = np.random.default_rng(4), 30
    q = np.linalg.qr(draw.standard_normal((d, d)))[0]
    values = np.concatenate([1 + 1e-7 * np.arange(15), np.linspace(2, 3, 15)])
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    _, vecs = whitening.eigen(a)
    rough = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(float)
    mixed = lambda x: np.abs(x.T @ a @ x - np.diag(np.diag(x.T @ a @ x))).max()
    assert mixed(vecs) < 1e-14 < 1e-8 < mixed(rough)


def brute_whitening(rows):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(0)
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    y = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums, strict=True)] for r in x])
    values, vecs = np.linalg.eigh(y.T @ y / n)
    return n, deviation, y @ vecs[:, ::-1] / np.sqrt(values[::-1]), values[::-1] / values.sum()


def check_whitening(found, rows, k):
    n, deviation, whitened, explained = brute_whitening(rows)
    assert len(found) == len(rows) * k and {r.n for r in found} == {n}
    by_id = defaultdict(dict)
    for r in found:
        by_id[r.vec_id][r.component] = r
    got = np.array([[by_id[i][c + 1].whitened for c in range(k)] for i, _ in rows])
    assert [by_id[i][1].deviation for i, _ in rows] == deviation
    sign = np.sign((got * whitened[:, :k]).sum(0))
    assert np.allclose(got * sign, whitened[:, :k], atol=1e-8)
    assert np.allclose([by_id[rows[0][0]][c + 1].explained for c in range(k)], explained[:k], rtol=1e-10)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_whitening_equals_brute_force(spark):
    rows = list(enumerate(clustered(300, 12, 1).tolist()))
    odd = [(1000 + n, v) for n, v in enumerate(ODD)]
    check_whitening(whitening.whiten(vector_table(spark, rows + odd).repartition(5), components=7).collect(), rows, 7)


def test_whitening_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check_whitening(queries.op11_whitening(spark, sf).collect(), rows, 32)


def test_whitening_of_odd_tables(spark):
    whole = lambda rows, **more: whitening.whiten(vector_table(spark, rows), **more).collect()
    assert whole([]) == [] and whole([(n, v) for n, v in enumerate(ODD) if v != [1.0, 2.0]]) == []
    one = whole([(None, [1.0, 2.0, 3.0])])
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(None, c, 1, 0, None, None, None) for c in (1, 2, 3)]
    flat = whole([(n, [float(n % 5), 1.0, float(n * n % 7)]) for n in range(40)])
    assert {r.component for r in flat if r.whitened is None} == {3} and flat[0].identity_error < 1e-9
    repeated = whole([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (2, [0.5, 0.5])])
    assert len(repeated) == 8 and {r.n for r in repeated} == {4}


def test_deviations_beyond_64_bits():
    model = whitening.Whitening(3, [0, 5], [1, 2], None, None, 0.0, None)
    x = np.array([[2**40, 7], [-(2**50), 0]])
    assert whitening.deviations(x, model) == [(3 * a - 1) ** 2 + (3 * (b - 5) - 2) ** 2 for a, b in x.tolist()]


# Lexical search.


def brute_search(docs, items, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda t: term.findall((t or "").translate(lower))
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counted:
            if c:
                m = 75 + (25 * sum(c.values()) * n_docs) // n_terms
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
                if score > 0:
                    scored.append((-score, i is None, i or 0, i))
        out += [(item, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


ITEMS = [
    (1, "the cat sat"), (2, "One two THREE one one"), (3, None), (4, " ,;"), (5, "passage1 passage2 žluťoučký"), (6, "nowhere_else 'g'"), (7, "the cat sat"), (None, "漢字 a b"), (8, LONG), (9, "e_f a-b c d"),
]
MORE = ["a b", "A.B", "b;a", "cat_sat cat\tsat\x00THE\x7fthe", "ab", "a" * 100_000, "c d x", "é É e", "the" * 3, "'g' nowhere, else"]


@pytest.mark.parametrize("block_bytes", [4 << 20, 200])
def test_search_equals_brute_force(spark, block_bytes):
    texts = TEXTS + MORE
    docs = table(spark, texts, [None if n % 11 == 3 else n for n in range(len(texts))])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    given = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in ITEMS], "item_id long, text string, doc_id int, item int, rank int")
    found = lexical.search(docs.repartition(4), given, k=5, block_bytes=block_bytes).collect()
    assert ordered(found) == ordered(brute_search(rows, ITEMS, 5))


def test_search_spreads_best_rows_over_tasks(spark):
    rows = [(n, " ".join(["word"] * (1 + n % 3) + ["other"] * (n % 7))) for n in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    items = [(1, "word"), (2, "other word other")]
    found = lexical.search(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert ordered(found) == ordered(brute_search(rows, items, 20))


def test_search_of_odd_tables(spark):
    docs, items = table(spark, ["a b", "a b", None]), spark.createDataFrame([(1, "a"), (1, "a")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).collect() == [] and lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.where("text IS NULL"), items).collect() == []
    assert sorted((r["rank"], r.doc_id) for r in lexical.search(docs, items).collect()) == [(1, 0), (1, 0), (2, 1), (2, 1)]
    same = table(spark, ["a b", "a b"], [5, 5])
    assert [(r["rank"], r.doc_id) for r in lexical.search(same, items.limit(1)).collect()] == [(1, 5), (2, 5)]


# Neighbours.


def brute_neighbours(rows, asks, k):
    """For each row that asks: the ids and scores of the k best others, and the least score that counts."""
    x = np.array([v for _, v in rows])
    out = []
    for n, (i, v) in enumerate(rows):
        if asks(i):
            scores = (x * np.array(v)).sum(1)
            rest = sorted((-s, j is None, j or 0, j) for m, (s, (j, _)) in enumerate(zip(scores, rows, strict=True)) if m != n)
            out.append((i, [(r[3], -r[0]) for r in rest[:k]]))
    return out


def recall_of(found, wanted, k):
    by_query = defaultdict(list)
    for r in found:
        by_query[r.query_id].append(r)
    hits = total = 0
    for i, best in wanted:
        own = sorted(by_query[i], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(best) + 1))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & {j for j, _ in best})
        total += len(best)
    return hits / total


@pytest.mark.parametrize("block_rows", [32_768, 500])
def test_neighbours_reach_the_recall(spark, block_rows):
    rows = list(enumerate(clustered(3000, 24, 5).tolist()))
    found = neighbours.search(vector_table(spark, rows + [(9000 + 20 * n, v) for n, v in enumerate(ODD)]), F.col("id") % 20 == 0, block_rows=block_rows, part_rows=64).collect()
    wanted = brute_neighbours(rows, lambda i: i % 20 == 0, 20)
    x = {i: np.array(v) for i, v in rows}
    assert all(r.score == (x[r.vec_id] * x[r.query_id]).sum() for r in found)
    assert len(found) == 150 * 20 and recall_of(found, wanted, 20) >= 0.9


def test_neighbours_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert recall_of(queries.op13_neighbours(spark, sf).collect(), brute_neighbours(rows, lambda i: i % 20 == 0, 20), 20) >= 0.95


def test_neighbours_of_few_equal_or_odd_rows(spark):
    whole = lambda rows, **more: [tuple(r) for r in neighbours.search(vector_table(spark, rows), F.col("id") % 20 == 0, **more).collect()]
    assert whole([]) == [] and whole([(20 * n, v) for n, v in enumerate(ODD) if v != [1.0, 2.0]]) == [] and whole([(0, [0.0, 0.0])]) == [] and whole([(1, [1.0, 2.0])]) == []
    few = whole([(0, [1.0, 0.0]), (1, [0.5, 3.0]), (2, [-1.0, 0.0]), (None, [0.5, 0.0])])
    assert sorted(few) == [(0, 1, 1, 0.5), (0, 2, None, 0.5), (0, 3, 2, -1.0)]
    same = [(n, [0.25, 0.5]) for n in range(2000)]
    found = whole(same, block_rows=300)
    assert {q: [v for a, _, v, _ in sorted(found) if a == q] for q in (0, 20)} == {0: list(range(1, 21)), 20: list(range(20))}
    repeated = whole([(20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [2.0, 0.0])])
    assert sorted(repeated) == [(20, 1, 3, 2.0), (20, 1, 3, 2.0), (20, 2, 20, 1.0), (20, 2, 20, 1.0)]


def test_windows_end_only_when_enough_lie_within_the_radius():
    x = clustered(400, 8, 9)
    longest = float(np.sqrt((x * x).sum(1)).max())
    index = neighbours.Index(x, longest, 20, 96, 0.5, 0.15, 7)
    found, scores = index.nearest(x[3], 20, 3)
    assert 3 not in found and len(set(found.tolist())) == len(found) >= 20 and np.array_equal(scores, (x[found] * x[3]).sum(1))
    everything, _ = index.nearest(x[3], 1000, None)
    assert sorted(everything.tolist()) == list(range(400))


def test_collisions_find_what_they_promise():
    """The share of vectors at the radius that collide enough, over many draws of directions, is that of the threshold."""
    assert neighbours.enough(96, 0.5, 0.15) == 43 and neighbours.enough(10, 1.0, 0.1) == 10 and neighbours.enough(5, 0.01, 0.1) == 1
    axes = neighbours.axes(30, 4000, 3)
    assert axes.shape == (30, 4000) and abs(float(np.mean(axes**2)) - 1) < 0.02 and np.abs(axes[:, :30].T @ axes[:, :30] - np.diag((axes[:, :30] ** 2).sum(0))).max() < 1e-9
    off = np.random.default_rng(1).standard_normal(30)
    near = np.abs(off / np.linalg.norm(off) @ axes) <= 0.6745
    assert abs(near.mean() - 0.5) < 0.03


def test_best_rows_of_a_hot_key(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") % 1000).alias("v"), "id")
    found = vectors.best(rows, ["k"], [F.desc("v"), F.asc("id")], 5, "id").collect()
    assert sorted((r["rank"], r.v, r.id) for r in found) == [(n + 1, 999, 999 + 1000 * n) for n in range(5)]
