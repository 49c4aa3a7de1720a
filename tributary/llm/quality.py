"""Quality rules: statistics of each text, base rules, and an isolation forest on the statistics.

The forest is grown on labelled rows: each tree splits its own share of them at random values of random statistics, and
a document that a few splits set apart is an anomaly. The score above which a document goes is calibrated on labelled
rows: the one that separates the two labels best among those that keep a stated share of the good rows. All labelled rows
count, in one of these two steps, and Spark keeps them: the driver sees spans of nodes and counts of scores.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.text import _CODES, Words, run_hashes, sliced
from tributary.workspace import stored, temporary

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATES = ["word_length", "symbols_per_word", "dup_line_share", "repeat_share", "words_per_line", "upper_share", "mark_share", "bare_share"]
STATS_SCHEMA = ", ".join([*(f"{c} long" for c in COUNTS), *(f"{c} double" for c in RATES)])

_IS = {name: np.zeros(256, bool) for name in ("symbol", "upper", "mark", "char", "letter")}
_IS["symbol"][list(b"#*$%&|<>")] = True
_IS["upper"][65:91] = True
_IS["letter"][65:91] = _IS["letter"][97:123] = _IS["letter"][128:] = True
_IS["mark"][list(b"!?;:\"'()[]{}/\\=+_~^@#*$%&|<>")] = True
_IS["char"][:] = True
_IS["char"][0x80:0xC0] = False  # all bytes but those that continue a code point


def _sums(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[end] - total[start]


def _by_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def statistics(words: Words) -> dict[str, np.ndarray]:
    """The counts and rates of each document."""
    raw, docs = words.bytes, words.docs
    begin, stop = words.offsets[:-1], words.offsets[1:]
    counts = words.counts
    chars = _sums(_IS["char"][raw], words.start, words.end)
    symbols = _sums(_IS["symbol"][raw], begin, stop)

    # Lines: runs between newlines; only those that hold a word count.
    breaks = np.flatnonzero(raw == 10)
    line_start = np.unique(np.concatenate([begin, breaks + 1, [len(raw)]]))[:-1] if len(raw) else np.zeros(0, np.int64)
    line_start = line_start[line_start < len(raw)]
    line_end = np.concatenate([line_start[1:], [len(raw)]]) if len(line_start) else line_start
    line_end = line_end - ((line_end > line_start) & (raw[np.maximum(line_end - 1, 0)] == 10)) if len(line_start) else line_end
    with_word = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
    line_start, line_end = line_start[with_word], line_end[with_word]
    line_doc = np.searchsorted(words.offsets, line_start, "right") - 1
    line_hash = run_hashes(_CODES[raw], line_start, line_end)
    order = np.lexsort([np.arange(len(line_hash)), line_hash, line_doc])
    again = np.zeros(len(line_hash), bool)
    again[order[1:]] = (line_hash[order[1:]] == line_hash[order[:-1]]) & (line_doc[order[1:]] == line_doc[order[:-1]])
    lines = np.bincount(line_doc, minlength=docs)[:docs]
    dup_lines = np.bincount(line_doc[again], minlength=docs)[:docs]

    # Words covered by a 3-word window that occurs again in the document.
    starts = words.window_starts(3)
    window = run_hashes(words.hashes(), starts, starts + 3)
    owner = words.doc_of_word()[starts] if len(starts) else starts
    order = np.lexsort([window, owner])
    same = (window[order[1:]] == window[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    twice = np.zeros(len(window), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(words.start) + 3, np.int64)
    np.add.at(covered, starts[twice], 1)
    np.add.at(covered, starts[twice] + 3, -1)
    repeat = _by_doc(np.cumsum(covered)[: len(words.start)] > 0, words.first)

    n = np.maximum(counts, 1)
    letters = _sums(_IS["letter"][raw], words.start, words.end)
    return {
        "n_words": counts,
        "word_chars": _by_doc(chars, words.first),
        "n_symbols": symbols,
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat,
        "word_length": _by_doc(chars, words.first) / n,
        "symbols_per_word": symbols / n,
        "dup_line_share": dup_lines / np.maximum(lines, 1),
        "repeat_share": repeat / n,
        "words_per_line": np.log1p(counts / np.maximum(lines, 1)),
        "upper_share": _sums(_IS["upper"][raw], begin, stop) / np.maximum(_by_doc(letters, words.first), 1),
        "mark_share": _sums(_IS["mark"][raw], begin, stop) / n,
        "bare_share": _by_doc(letters == 0, words.first) / n,
    }


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, counts (COUNTS) and rates (RATES) of the whole text; all 0 for a null text.

    Very long texts are measured whole, one at a time. Null ids are carried, repeated rows measured each; an empty table
    gives no rows, and other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            for part in sliced(batch):
                found = statistics(Words(part.column("text")))
                columns = [pa.array(found[c].astype(np.int64)) for c in COUNTS] + [pa.array(found[c].astype(float)) for c in RATES]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=[id_col, *COUNTS, *RATES])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(rows, f"`{id_col}` {kind}, {STATS_SCHEMA}")


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _usual_path(n: np.ndarray | float) -> np.ndarray:
    """The mean path length of an unsuccessful search in a binary search tree of n keys."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclasses.dataclass
class Forest:
    """Trees as arrays: the statistic that a node splits (-1: a leaf), the value, the children, a leaf's path length."""

    trees: list[tuple[np.ndarray, ...]]
    subsample: int
    threshold: float = 1.0

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1, higher for anomalies."""
        depth = np.zeros(len(rows))
        for which, value, left, right, path in self.trees:
            at = np.zeros(len(rows), np.int32)
            while (inner := which[at] >= 0).any():
                go = np.flatnonzero(inner)
                node = at[go]
                at[go] = np.where(rows[go, which[node]] < value[node], left[node], right[node])
            depth += path[at]
        return 2 ** (-depth / len(self.trees) / max(float(_usual_path(self.subsample)), 1e-9))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _members(keys: np.ndarray, trees: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row and a tree that it grows: one tree for each row, and any other with probability ``share``."""
    home = (_mixed(keys) % np.uint64(trees)).astype(np.int64)
    if share <= 0:
        return np.arange(len(keys)), home
    drawn = _mixed(keys[:, None] + np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)
    belongs = drawn * 2.0**-53 < share
    belongs[np.arange(len(keys)), home] = True
    return np.nonzero(belongs)


def _spans(rows: np.ndarray, keys: np.ndarray, share: float, which: np.ndarray, value: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """The nodes at ``depth`` that rows reach (tree times places, plus place), their numbers of rows, least and greatest values."""
    row, tree = _members(keys, len(which), share)
    at = np.zeros(len(row), np.int64)
    for _ in range(depth):
        split = which[tree, at]
        at = np.where(split >= 0, 2 * at + 1 + (rows[row, split] >= value[tree, at]), at)
    here = np.flatnonzero(at >= 2**depth - 1)  # others have ended in a leaf above
    node = tree[here] * which.shape[1] + at[here]
    order = np.argsort(node, kind="stable")
    own, node = rows[row[here[order]]], node[order]
    first = np.flatnonzero(np.diff(node, prepend=-1))
    if not len(first):
        return node, node, own, own
    return node[first], np.diff(first, append=len(node)), np.minimum.reduceat(own, first), np.maximum.reduceat(own, first)


def _rates(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy() for c in RATES])


@dataclasses.dataclass
class Spread:
    """``n`` rows of RATES in a table, each with a hash of its id in ``_key``: what ``grow`` takes beside arrays."""

    table: DataFrame
    n: int

    def __len__(self) -> int:
        return self.n

    def spans(self, share: float, which: np.ndarray, value: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
        """``_spans`` over the whole table: no more rows come back than nodes can be at ``depth``."""
        shared = self.table.sparkSession.sparkContext.broadcast((which, value))
        lows, highs = [f"low_{c}" for c in RATES], [f"high_{c}" for c in RATES]

        def found(batches):
            for batch in batches:
                node, n, low, high = _spans(_rates(batch), batch.column("_key").to_numpy().view(np.uint64), share, *shared.value, depth)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (node, n, *low.T, *high.T)], names=["node", "n", *lows, *highs])

        parts = self.table.select("_key", *RATES).mapInArrow(found, ", ".join(["node long", "n long", *(f"{c} double" for c in lows + highs)]))
        whole = parts.groupBy("node").agg(F.sum("n").alias("n"), *(F.min(c).alias(c) for c in lows), *(F.max(c).alias(c) for c in highs)).toArrow().sort_by("node")
        shared.destroy()
        return whole["node"].to_numpy(), whole["n"].to_numpy(), *(np.column_stack([whole[c].to_numpy() for c in names]) for names in (lows, highs))


def grow(rows: np.ndarray | Spread, *, trees: int = 100, subsample: int = 256, seed: int = 3) -> Forest:
    """Trees of about ``subsample`` rows each, or of more where so many trees would not take in all rows.

    Every row grows one tree at least; of rows up to ``subsample`` each grows all. Trees grow together, level by level, as
    deep as ``subsample`` rows ask for: a level needs the spans of its nodes, which one pass over the rows tells.
    """
    n, rng = len(rows), np.random.default_rng(seed)
    size = min(n, max(subsample, -(-n // trees)))
    share = (size * trees / n - 1) / max(trees - 1, 1) if n and size <= subsample else 0.0
    limit = int(np.ceil(np.log2(max(2, min(subsample, n)))))
    places = np.arange(2 ** (limit + 1) - 1)  # the children of place p are 2 p + 1 and 2 p + 2
    which, value = np.full((trees, len(places)), -1, np.int32), np.zeros((trees, len(places)))
    path = np.tile(np.floor(np.log2(places + 1)), (trees, 1))
    keys = _mixed(np.arange(n, dtype=np.uint64))
    for depth in range(limit + 1):
        node, count, low, high = rows.spans(share, which, value, depth) if isinstance(rows, Spread) else _spans(rows, keys, share, which, value, depth)
        tree, at = np.divmod(node, len(places))
        path[tree, at] = depth + _usual_path(count)
        free = high > low
        chosen = np.where(free, rng.random(free.shape), -1).argmax(1)[:, None]
        low, high = np.take_along_axis(low, chosen, 1)[:, 0], np.take_along_axis(high, chosen, 1)[:, 0]
        cut = low + (high - low) * rng.random(len(low))
        splits = free.any(1) & (depth < limit)
        which[tree[splits], at[splits]], value[tree[splits], at[splits]] = chosen[splits, 0], cut[splits]
        if not splits.any():
            break
    made = []
    for k in range(trees):
        inner = np.flatnonzero(which[k] >= 0)
        used = np.unique(np.concatenate([[0], 2 * inner + 1, 2 * inner + 2]))
        left = np.where(which[k][used] >= 0, np.searchsorted(used, 2 * used + 1), 0).astype(np.int32)
        made.append((which[k][used], value[k][used], left, left + (left > 0).astype(np.int32), path[k][used]))
    return Forest(made, size)


def calibrate(forest: Forest, rows: np.ndarray, good: np.ndarray, keep: float) -> float:
    """The threshold with the most bad rows above it less good rows above it (as shares), keeping ``keep`` of the good."""
    scores = forest.score(rows)
    if not good.any() or good.all():
        return float(np.quantile(scores, keep)) if good.any() else 1.0
    cuts = np.unique(scores)
    good_over = 1 - np.searchsorted(np.sort(scores[good]), cuts, "right") / good.sum()
    bad_over = 1 - np.searchsorted(np.sort(scores[~good]), cuts, "right") / (~good).sum()
    gain = np.where(good_over <= 1 - keep, bad_over - good_over, -1)
    best = int(gain.argmax())
    return float((cuts[best] + cuts[min(best + 1, len(cuts) - 1)]) / 2)


def calibrate_spread(forest: Forest, table: DataFrame, keep: float, *, bins: int = 1 << 16) -> float:
    """``calibrate`` over all rows of a table (RATES and quality, 1 for good), with the same result.

    Scores are counted, and added up from the lowest in ``bins`` of them: the driver sees one row a bin.
    """
    spark = table.sparkSession
    shared = spark.sparkContext.broadcast(forest)

    def scores(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.score(_rates(batch))), batch.column("good")], names=["score", "good"])

    scored = table.select((F.col("quality") == 1).alias("good"), *RATES).mapInArrow(scores, "score double, good boolean")
    counts = scored.groupBy("score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    counts = stored(counts.withColumn("bin", F.floor(F.col("score") * bins)), "scores")
    shared.destroy()
    before, n_good, n_bad = [], 0, 0
    for r in counts.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("bin").toArrow().to_pylist():
        before.append((r["bin"], n_good, n_bad))
        n_good, n_bad = n_good + r["good"], n_bad + r["bad"]
    if not n_good:
        return 1.0
    up_to = Window.partitionBy("bin").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = counts.join(F.broadcast(spark.createDataFrame(before, "bin long, good_before long, bad_before long")), "bin")
    sums = sums.select("score", *((F.col(f"{c}_before") + F.sum(c).over(up_to)).alias(c) for c in ("good", "bad")))
    if not n_bad:
        place = (n_good - 1) * keep
        ends = sums.agg(*(F.min(F.when(F.col("good") > int(k), F.col("score"))) for k in (np.floor(place), np.ceil(place)))).first()
        return float(np.quantile(list(ends), place - np.floor(place)))
    good_over, bad_over = 1 - F.col("good") / n_good, 1 - F.col("bad") / n_bad
    gain = F.when(good_over <= 1 - keep, bad_over - good_over).otherwise(-1.0)
    best = sums.agg(F.max_by("score", F.struct(gain, -F.col("score")))).first()[0]
    after = counts.where(F.col("score") > best).agg(F.min("score")).first()[0]
    return (best + (best if after is None else after)) / 2


def _at_rank(table: DataFrame, name: str, rank: int) -> tuple[int, int]:
    """The value of a column of spread hashes at ``rank`` (from 0, ascending), and how many rows are below it."""
    top = F.shiftright(name, 48)
    below = 0
    for r in table.groupBy(top.alias("top")).count().orderBy("top").toArrow().to_pylist():
        if below + r["count"] > rank:
            break
        below += r["count"]
    near = np.sort(table.where(top == r["top"]).select(name).toArrow()[name].to_numpy())
    found = near[rank - below]
    return int(found), below + int(np.searchsorted(near, found))


def train(measured: DataFrame, labels: DataFrame, *, keep: float = 0.985, halved_from: int = 100, id_col: str = "doc_id") -> Forest | None:
    """Grow on one half of all labelled rows, by a hash of the id, and calibrate on all of the other half.

    ``labels`` has the id and quality (1 good, 0 bad). Rows that fail the base rules, and ids that are labelled both ways,
    are not used; of rows with one id one is. Fewer than ``halved_from`` rows are not halved: the same ones then grow the
    forest and calibrate it. None without labelled rows.
    """
    marked = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
    marked = marked.where("quality = _most").drop("_most")
    once = measured.where(~base_failed()).join(marked, id_col).groupBy(id_col, "quality").agg(F.min(F.struct(*RATES)).alias("_rates"))
    hashes = [F.xxhash64(F.lit(x), id_col).alias(f"_{x}") for x in ("half", "key")]
    with temporary(measured.sparkSession):
        rows = other = stored(once.select("quality", "_rates.*", *hashes), "labelled")
        n, below = rows.count(), 0
        if not n:
            return None
        if n >= halved_from:
            cut, below = _at_rank(rows, "_half", n // 2)
            rows, other = rows.where(F.col("_half") >= cut), rows.where(F.col("_half") < cut)
        forest = grow(Spread(rows, n - below))
        return dataclasses.replace(forest, threshold=calibrate_spread(forest, other, keep))


def judge(measured: DataFrame, forest: Forest | None) -> DataFrame:
    """``measured`` with ``base_failed``, ``anomaly`` (0 to 1) and ``kept``: the base rules, then the forest.

    Without a forest only the base rules hold. Repeated rows are judged alike; an empty table gives no rows.
    """
    shared = measured.sparkSession.sparkContext.broadcast(forest)
    names = measured.columns
    out = measured.withColumn("base_failed", base_failed()).withColumn("anomaly", F.lit(0.0)).schema

    def rows(batches):
        for batch in batches:
            failed = np.asarray(batch.column("base_failed"))
            score = np.zeros(batch.num_rows)
            if shared.value is not None and batch.num_rows:
                score = shared.value.score(_rates(batch))
            good = ~failed & (score <= shared.value.threshold if shared.value is not None else True)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array(good)], names=[*names, "base_failed", "anomaly", "kept"])

    return measured.withColumn("base_failed", base_failed()).mapInArrow(rows, out.add("kept", "boolean"))
