"""Ranked lexical search: items' terms are counted in the texts by an Aho-Corasick automaton, without an index of documents.

A term is a run of ASCII letters, digits and all characters beyond ASCII. In a text, letters A-Z are lower-cased, and all
other ASCII characters become spaces; a pattern is a term between two spaces, which thus matches whole terms only.
Patterns and texts are bytes, one character each. Texts are scanned once; what remains of one are its number of terms
and the counts of those that items have. Document frequencies come from these, and so do the scores.
"""

from __future__ import annotations

import math
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.text import sliced
from tributary.llm.vectors import best
from tributary.workspace import stored

BLOCK_BYTES = 4 << 20
CELLS = 1 << 22
COUNTS = "doc_id long, n long, terms binary, counts binary"

_TERM = np.zeros(256, bool)
_TERM[0x80:] = True
for _lo, _hi in (("0", "9"), ("A", "Z"), ("a", "z")):
    _TERM[ord(_lo) : ord(_hi) + 1] = True
_FOLDED = np.where(_TERM, np.arange(256), 0x20).astype(np.uint8)
_FOLDED[ord("A") : ord("Z") + 1] += 32


class Folded:
    """A few texts as bytes of lower-cased terms and spaces, one space at least before and after each text."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        self.start = offsets - offsets[0] + np.arange(len(offsets))  # where the space before each text is
        self.bytes = np.full(len(raw) + len(offsets), 0x20, np.uint8)
        self.bytes[np.arange(len(raw)) + 1 + np.repeat(np.arange(len(texts)), np.diff(offsets))] = _FOLDED[raw]

    def lengths(self) -> np.ndarray:
        """The number of terms of each text."""
        inside = self.bytes != 0x20
        begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        return np.diff(np.searchsorted(begins, self.start))

    def latin(self) -> str:
        return self.bytes.tobytes().decode("latin-1")


def terms_of(text: str | None) -> list[str]:
    """The terms of a text, each of its bytes a character."""
    return [t for t in Folded(pa.array([text], pa.string())).latin().split(" ") if t]  # other bytes that split() takes for white space are parts of characters


def automaton(terms: list[str]):
    """Finds the number of each of ``terms`` where it stands between spaces."""
    found = ahocorasick.Automaton()
    for n, term in enumerate(terms):
        found.add_word(f" {term} ", n)
    found.make_automaton()
    return found


def _counts(scanner, n_terms: int):
    """Rows of COUNTS for texts."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch):
                texts = Folded(part.column("text"))
                met = np.array(list(scanner.value.iter(texts.latin())), np.int64).reshape(-1, 2)
                doc = np.searchsorted(texts.start, met[:, 0] - 1, side="right") - 1  # a match ends with the space after its term
                pairs, counts = np.unique(doc * n_terms + met[:, 1], return_counts=True)
                cuts = np.searchsorted(pairs, np.arange(part.num_rows + 1) * n_terms)
                term, times = (pairs % n_terms).astype("<i4").tobytes(), counts.astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(texts.lengths().astype(np.int64)),
                        pa.array([term[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        pa.array([times[8 * a : 8 * b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return run


def _frequencies(n_terms: int):
    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for own in batch.column("terms"):
                total[np.frombuffer(own.as_buffer(), "<i4")] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"])

    return run


class Items:
    """The items of a block: their terms' weights, and for each term the items that have it, and how often."""

    def __init__(self, rows: list[int], ids: list, texts: list):
        self.rows, self.ids = np.array(rows, np.int64), ids
        counted = [Counter(terms_of(t)) for t in texts]
        self.terms = sorted({t for c in counted for t in c})
        number = {t: n for n, t in enumerate(self.terms)}
        pairs = sorted((number[t], item, times) for item, c in enumerate(counted) for t, times in c.items())
        term, self.item, self.times = (np.array(x, np.int64) for x in (zip(*pairs, strict=True) if pairs else ((), (), ())))
        self.first = np.searchsorted(term, np.arange(len(self.terms) + 1))

    def scores(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
        """Documents by items: the sum of ``value`` over a document's terms that the item has, as often as it has them."""
        each = np.diff(self.first)[term]
        ends = np.cumsum(each)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - each, each) + np.repeat(self.first[term], each)
        cell = np.repeat(doc, each) * len(self.ids) + self.item[at]
        value = np.repeat(value, each) * self.times[at]
        # bincount adds doubles: halves of numbers stay exact
        high, low = (np.bincount(cell, x, docs * len(self.ids)).astype(np.int64) for x in (value >> 26, value & (2**26 - 1)))
        return ((high << 26) + low).reshape(docs, len(self.ids))


def _scored(items, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    """The ``k`` best documents of each item in a partition: rows of (item row, item_id, doc_id, score)."""

    def first(item, score, known, doc):
        order = np.lexsort((doc, ~known, -score, item))
        item = item[order]
        starts = np.searchsorted(item, item)
        return order[np.arange(len(item)) - starts < k]

    def run(batches):
        own = items.value
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]
        least = np.ones(len(own.ids), np.int64)
        many = max(1, CELLS // max(1, len(own.ids)))
        for batch in batches:
            for lo in range(0, batch.num_rows, many):
                part = batch.slice(lo, many)
                size = np.array([len(x) // 4 for x in part.column("terms").to_pylist()], np.int64)
                doc = np.repeat(np.arange(part.num_rows), size)
                term = np.frombuffer(b"".join(part.column("terms").to_pylist()), "<i4")
                tf = np.frombuffer(b"".join(part.column("counts").to_pylist()), "<i8")
                m = 75 + (25 * part.column("n").to_numpy() * n_docs) // n_terms
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
                score = own.scores(doc, term, value, part.num_rows)
                where, item = np.nonzero(score >= least)
                known = part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)[where]
                ids = part.column("doc_id").fill_null(0).to_numpy()[where]
                both = [np.concatenate(x) for x in zip(kept, (item, score[where, item], known, ids), strict=True)]
                stay = first(*both)
                kept = [x[stay] for x in both]
                full = np.bincount(kept[0], minlength=len(least)) >= k
                worst = np.full(len(least), np.iinfo(np.int64).max)
                np.minimum.at(worst, kept[0], kept[1])
                least = np.where(full, worst, 1)
        item, score, known, ids = kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.rows[item]), pa.array([own.ids[i] for i in item], pa.int64()), pa.array(ids, mask=~known), pa.array(score)],
            names=["item", "item_id", "doc_id", "score"],
        )

    return run


def _blocks(items: DataFrame, block_bytes: int):
    """The items in blocks of about ``block_bytes`` of text; rows are numbered, and repeated ones are rows of their own."""
    numbered = stored(items.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("long").alias("item_id"), F.col("text")), "items")
    total = numbered.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    blocks = math.ceil(total / block_bytes)
    for block in range(blocks):
        rows = numbered.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).toArrow()
        yield Items(*(rows.column(c).to_pylist() for c in ("row", "item_id", "text")))


def search(docs: DataFrame, items: DataFrame, *, k: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each item: item_id, rank, doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read. Scores are whole numbers: a
    term of the item weighs floor(1000 ln((2 N + 2) / (2 df + 1))), its occurrences count less and less, and less in
    longer documents; a term that the item repeats counts as often. Equal scores rank by doc_id, null ids last.

    Whole texts are scanned, very long ones too. A null or empty text has no terms: it is never found, and an item of that
    kind finds nothing. Repeated documents are found each; a repeated item, or a null item id, has ranks of its own.
    Without documents or items there are no rows. Items are taken in blocks of about ``block_bytes`` of text, whose terms
    and automaton are broadcast; each block takes a scan of the texts.
    """
    out = None
    for own in _blocks(items, block_bytes):
        found = _search_block(docs, own, k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return best(out, ["item", "item_id"], order, k, "share").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _search_block(docs: DataFrame, own: Items, k: int) -> DataFrame | None:
    context, size = docs.sparkSession.sparkContext, len(own.terms)
    if not size:
        return None
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = stored(texts.mapInArrow(_counts(context.broadcast(automaton(own.terms)), size), COUNTS), "term-counts")
    n_docs, n_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(size, np.int64)
    for r in counted.select("terms").mapInArrow(_frequencies(size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    scored = counted.mapInArrow(_scored(context.broadcast(own), weights, n_docs, n_terms, k), "item long, item_id long, doc_id long, score long")
    return scored.withColumn("share", F.spark_partition_id())
