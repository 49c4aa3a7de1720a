"""Language-model scores by a weighted backoff automaton over a corpus of any size.

States are the histories of the training texts: the pairs of words that a third word follows, single words with a
state for the start of a text, and one null state. A state h has an arc for each word w that follows it, of weight
log10((c(hw) - D) / c(h) + b(h) p(w | h')), h' being h without its first word, and a failure arc to the state h' of weight
log10 b(h), b(h) = 1 - sum of (c(hw) - D) / c(h) over its arcs, so that the probabilities of all words add up to 1. The
null state has an arc for every word, p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)). Pairs and triples are kept wherever they
occur; D, the absolute discount, comes from the counts of counts of pairs. Reading a word leads to the
longest history that is a state.

The automaton grows with the corpus, so that each block of documents gets the part of it that its own texts reach. Three
exchanges make it: counts of words and pairs; counts of triples, and how many arcs each word has; how many arcs each pair
has. Every history is followed by some word in its text, so that the counts of its arcs add up to its own count. Of the
blocks that have an n-gram one owns it, so that an arc is counted once, and a frequent one weighs no more than the number
of blocks. What only one block has, it knows by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.blocks import SENT, answered, block_of, into_blocks, part_of, read_answer, sent, text_slices
from tributary.llm.text import Words, distinct, mix
from tributary.workspace import stored

START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814E)  # stand for the two ends of a text
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
SMOOTHING, UNIT = 0.1, 1024
LANE = 512


def held_out_tenth(doc_id: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (each document's words, then END), and the documents' first tokens."""
    first = words.first + np.arange(words.docs + 1)
    token = np.empty(first[-1], np.uint64)
    inner = np.ones(len(token), bool)
    inner[first[1:] - 1] = False
    token[inner] = words.hashes()
    token[~inner] = END
    return token, first


def word_keys(token: np.ndarray) -> np.ndarray:
    return mix(token) & ~np.uint64(1)


def longer_keys(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Keys of a history (a word's hash, or a pair's key) and a word."""
    return mix(history * np.uint64(0x9E3779B97F4A7C15) + mix(token)) | np.uint64(1)


def summed(places: np.ndarray, n: int, counts: np.ndarray) -> np.ndarray:
    """For each value sent: four times the sum of its key, plus 2 if other blocks sent the key too, plus 1 for one of those that sent more than 0."""
    total = np.bincount(places, counts, minlength=n).astype(np.int64)
    some = np.flatnonzero(counts)
    owner = np.full(n, -1)
    owner[places[some]] = some
    out = 4 * total[places] + 2 * (np.bincount(places, minlength=n) > 1)[places]
    out[owner[owner >= 0]] += 1
    return out


def corpus_counts(keys: np.ndarray, places: np.ndarray, counts: np.ndarray) -> list[int]:
    """All tokens, distinct ones, pairs that occur once, and twice."""
    total = np.bincount(places, counts, minlength=len(keys)).astype(np.int64)
    pair = (keys & np.uint64(1)).astype(bool)
    return [int(total[~pair].sum()), int((total[~pair] > 0).sum()), int((total[pair] == 1).sum()), int((total[pair] == 2).sum())]


def discount(once: int, twice: int) -> int:
    """The absolute discount in units of 1 / UNIT, between 0.1 and 0.95; a half if nothing is known."""
    return round(UNIT * min(max(once / (once + 2 * twice), 0.1), 0.95)) if once + twice else UNIT // 2


class Block:
    """The tokens of one block's documents, and the n-grams in them.

    ``keys`` holds its words (even) and pairs (odd), ascending; ``word`` and ``pair`` are the places in it of each token and
    of each token with the one before; ``head`` and ``last`` those of a pair's two words.
    """

    def __init__(self, rows: pa.Table, parts: int):
        self.parts, token, sizes, keep = parts, [], [], []
        for some in text_slices(rows.select(["text", "held_out"])):
            own, first = tokens(Words(some.column("text"), lower=True))
            token.append(own)
            sizes.append(np.diff(first))
            keep.append(~np.asarray(some.column("held_out")))
        self.token, self.sizes = np.concatenate(token), np.concatenate(sizes)
        self.train = np.repeat(np.concatenate(keep), self.sizes)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        before = np.concatenate([[START], self.token[:-1]])
        before[self.first[:-1]] = START
        both = np.concatenate([word_keys(self.token), longer_keys(before, self.token), word_keys(np.array([START, END]))])
        self.keys, places = distinct(both)
        n = len(self.token)
        self.word, self.pair, (self.start, self.end) = places[:n], places[n : 2 * n], places[-2:].tolist()
        self.is_pair = (self.keys & np.uint64(1)).astype(bool)
        self.head, self.last = np.zeros(len(self.keys), np.int64), np.zeros(len(self.keys), np.int64)
        previous = np.concatenate([[self.start], self.word[:-1]])
        previous[self.first[:-1]] = self.start
        self.head[self.pair], self.last[self.pair] = previous, self.word

    def sends(self, block: int, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
        return sent(block, keys, part_of(keys, self.parts), counts, "count")

    def own_counts(self) -> np.ndarray:
        return np.bincount(self.word[self.train], minlength=len(self.keys)) + np.bincount(self.pair[self.train], minlength=len(self.keys))

    def counted(self, answers: pa.Table) -> None:
        """Take in ``total``, how often words and pairs occur in training, which this block owns, and which other blocks have too."""
        found = read_answer(answers, 0, part_of(self.keys, self.parts), "count")
        self.total, self.own, self.shared = found >> 2, (found & 1).astype(bool), (found & 2).astype(bool)

    def triples(self) -> None:
        """The distinct triples: their keys, their own counts, and the pairs that they begin and end with.

        A triple with a pair that no other block has is in no other block either, and needs no exchange.
        """
        at = np.setdiff1d(np.arange(len(self.token)), self.first[:-1], assume_unique=True)
        keys = longer_keys(self.keys[self.pair[at - 1]], self.token[at])
        self.triple_keys, places = distinct(keys)
        where = np.zeros(len(self.triple_keys), np.int64)
        where[places] = np.arange(len(keys))
        self.triple_total = np.bincount(places[self.train[at]], minlength=len(self.triple_keys))
        self.triple_own = self.triple_total > 0
        self.triple_head, self.triple_last = self.pair[at[where] - 1], self.pair[at[where]]
        self.far = self.shared[self.triple_head] & self.shared[self.triple_last]

    def second(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of the second exchange: the arcs of words that this block owns, and triples that others may have."""
        arcs = np.bincount(self.head[self.is_pair & self.own], minlength=len(self.keys))
        keys = np.concatenate([self.keys[~self.is_pair], self.triple_keys[self.far]])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate([arcs[~self.is_pair], self.triple_total[self.far]])[order]

    def kept(self, answers: pa.Table) -> None:
        """Take in ``arcs``, how many arcs each word has, and how often triples occur."""
        keys, _ = self.second()
        found = read_answer(answers, 1, part_of(keys, self.parts), "count")
        triple = (keys & np.uint64(1)).astype(bool)
        self.arcs = np.zeros(len(self.keys), np.int64)
        self.arcs[~self.is_pair] = found[~triple] >> 2
        self.triple_total[self.far], self.triple_own[self.far] = found[triple] >> 2, (found[triple] & 1).astype(bool)

    def third(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of the third exchange: the arcs, among those that this block owns, of pairs that other blocks have too."""
        arcs = np.bincount(self.triple_head[self.triple_own], minlength=len(self.keys))
        self.arcs[self.is_pair] = arcs[self.is_pair]
        at = self.is_pair & self.shared & (self.total > 0)
        return self.keys[at], arcs[at]

    def weighed(self, answers: pa.Table) -> None:
        """Take in how many arcs each pair has."""
        keys, _ = self.third()
        at = self.is_pair & self.shared & (self.total > 0)
        self.arcs[at] = read_answer(answers, 2, part_of(keys, self.parts), "count") >> 2


class Automaton:
    """The states and arcs that one block reaches. State 0 is the null state, k + 1 that of the word or pair ``keys[k]``.

    Arcs are in the order of ``code``, state * number of words and pairs + word.
    """

    def __init__(self, block: Block, tokens: int, types: int, less: int):
        n, d = len(block.keys), less / UNIT
        total = block.total.copy()
        total[block.start] = total[block.end]  # as many training texts start as end
        self.words, self.start = n, block.start + 1 if total[block.start] else 0
        state = np.where(block.is_pair, block.arcs > 0, total > 0)
        state[block.end] = False
        self.null = np.log10((block.total + SMOOTHING) / (tokens + SMOOTHING * (types + 1)))

        # Failure arcs.
        self.fail, self.fail_weight = np.zeros(n + 1, np.int64), np.zeros(n + 1)
        words, pairs = np.flatnonzero(state & ~block.is_pair), np.flatnonzero(state & block.is_pair)
        self.fail[pairs + 1] = block.last[pairs] + 1
        some = np.concatenate([words, pairs])
        self.fail_weight[some + 1] = np.log10(d * block.arcs[some] / total[some])

        # Arcs of the null state, of words and of pairs.
        one = np.flatnonzero(~block.is_pair)
        two = np.flatnonzero(block.is_pair & (total > 0))
        head, last = block.head[two], block.last[two]
        weight_two = np.log10((total[two] - d) / total[head] + 10.0 ** (self.fail_weight[head + 1] + self.null[last]))
        kept = np.flatnonzero(block.triple_total)
        first, second = block.triple_head[kept], block.triple_last[kept]
        lower = weight_two[np.searchsorted(two, second)]
        weight_three = np.log10((block.triple_total[kept] - d) / total[first] + 10.0 ** (self.fail_weight[first + 1] + lower))
        after_word = np.where(state[one], one + 1, 0)
        longest = np.where(state, np.arange(n) + 1, np.where(state[block.last], block.last + 1, 0))  # after a pair
        code = np.concatenate([one, (head + 1) * n + last, (first + 1) * n + block.last[second]])
        order = np.argsort(code)
        self.code = np.append(code[order], np.iinfo(np.int64).max)
        self.weight = np.concatenate([self.null[one], weight_two, weight_three])[order]
        self.next = np.concatenate([after_word, longest[two], longest[second]])[order]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one word in each state: log10 weights and the states that follow."""
        state, weight, left = state.copy(), np.zeros(len(state)), np.arange(len(state))
        while len(left):
            here = state[left]
            code = here * self.words + word[left]
            arc = np.searchsorted(self.code, code)
            found = self.code[arc] == code
            weight[left[found]] += self.weight[arc[found]]
            state[left[found]] = self.next[arc[found]]
            left, here = left[~found], here[~found]
            weight[left] += self.fail_weight[here]
            state[left] = self.fail[here]
        return weight, state

    def walk(self, word: np.ndarray, first: np.ndarray, lane: int = LANE) -> np.ndarray:
        """The sum of weights on the way through each text, from left to right; word[first[d]:first[d + 1]] is text d.

        All texts are walked at once. Long ones are cut into lanes: a lane begins in the null state two words early, and
        is then in the state that the whole way leads to, as no history is longer.
        """
        sizes = np.diff(first)
        lanes = -(-sizes // lane)
        text = np.repeat(np.arange(len(sizes)), lanes)
        later = (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * lane
        early = np.where(later > 0, 2, 0)
        begin = first[text] + later - early
        length = np.minimum(sizes[text] - later, lane) + early
        order = np.argsort(-length, kind="stable")
        begin, early, length, text = begin[order], early[order], length[order], text[order]
        state, score = np.where(early > 0, 0, self.start), np.zeros(len(text))
        going = len(text)
        for t in range(int(length[0]) if len(length) else 0):
            while length[going - 1] <= t:
                going -= 1
            weight, state[:going] = self.step(state[:going], word[begin[:going] + t])
            score[:going] += np.where(t >= early[:going], weight, 0.0)
        return np.bincount(text, score, minlength=len(sizes))


def score(docs: DataFrame, *, held_out: F.Column | None = None, block_bytes: int = 4 << 20) -> DataFrame:
    """SCORES: one row per document of ``docs`` (doc_id, text), learning from those that are not ``held_out``.

    A null text is empty: its only token is the end. Null ids are carried as null and learned from; repeated rows are
    counted and scored each; without training texts all counts are 0. A block holds whole texts, so that a text must fit
    into a task's memory some 60 times over. An empty table gives no rows. Other columns are not read.
    """
    held = F.lit(False) if held_out is None else held_out
    blocked, parts = into_blocks(docs, held.alias("held_out"), block_bytes=block_bytes)

    def ask(rows: pa.Table) -> pa.Table:
        block = Block(rows, parts)
        return block.sends(block_of(rows), block.keys, block.own_counts())

    def ask_again(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return sent(0, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), "count")
        block = Block(rows, parts)
        block.counted(answers)
        block.triples()
        return block.sends(block_of(rows), *block.second())

    def weigh(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return sent(0, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), "count")
        block = Block(rows, parts)
        block.counted(answers)
        block.triples()
        block.kept(answers)
        return block.sends(block_of(rows), *block.third())

    def read(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({n: [] for n in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")})
        block = Block(rows, parts)
        block.counted(answers)
        block.triples()
        block.kept(answers)
        block.weighed(answers)
        automaton = Automaton(block, total, types, less)
        begin = block.first[:-1]
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "held_out": rows.column("held_out"),
                "n_tokens": pa.array(block.sizes),
                "n_known": pa.array(np.add.reduceat((block.total[block.word] > 0).astype(np.int64), begin)),
                "train_tokens": pa.array(np.full(len(begin), total, np.int64)),
                "base_score": pa.array(np.add.reduceat(automaton.null[block.word], begin)),
                "score": pa.array(automaton.walk(block.word, block.first)),
            }
        )

    def told(asked: DataFrame, step: int) -> DataFrame:
        return answered(asked, step, "<u8", "count", "count", summed, corpus_counts if step == 0 else None)

    counted = stored(told(blocked.groupBy("block").applyInArrow(ask, SENT), 0), "counted")
    sums = counted.agg(*(F.coalesce(F.sum(F.col("told")[k]), F.lit(0)) for k in range(4))).first()
    total, types, less = sums[0], sums[1], discount(sums[2], sums[3])
    with_counts = blocked.groupBy("block").cogroup(counted.groupBy("block"))
    known = counted.unionByName(stored(told(with_counts.applyInArrow(ask_again, SENT), 1), "counted"))
    with_triples = blocked.groupBy("block").cogroup(known.groupBy("block"))
    weighed = stored(told(with_triples.applyInArrow(weigh, SENT), 2), "counted")
    return blocked.groupBy("block").cogroup(known.unionByName(weighed).groupBy("block")).applyInArrow(read, SCORES)
