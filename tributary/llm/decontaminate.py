"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

An item of n shingles is contained in a document if the document has at least ``threshold`` of them, and so misses at
most m = floor((1 - threshold) * n). Its sketch is its m + 1 smallest hash values (a bottom-k MinHash): a document that
contains the item has one of them for certain, whatever the document's length. Items are partitioned by size; a
partition is probed only with the document shingles that are no larger than its largest sketch value.

A benchmark of at most ``block_bytes`` of text is broadcast. A larger one stays in tables: sketch values of items are joined
with those shingles of documents that a bitmap of all sketch values, of a fixed size, lets through, and candidates
with one text for each digest. That takes one scan for the probes and one for the candidates' texts, however many items
there are.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.text import Words, run_hashes, sliced
from tributary.workspace import stored

SCHEMA = "doc_id long, item_id long, n_shingles long, n_shared long"
BLOCK_BYTES = 8 << 20
BITS = 1 << 22


def item_shingles(words: list[bytes], k: int) -> tuple[int, set]:
    """An item's shingle length (its number of words, if below k) and its distinct shingles."""
    k = min(k, len(words))
    return k, {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()


class Sketches:
    """The items of one block, partitioned by shingle length and by the power of two of their size."""

    def __init__(self, ids: list, texts: list, k: int, percent: int):
        self.percent = percent
        self.items: list[tuple] = []
        parts = defaultdict(list)
        for item, text in zip(ids, texts, strict=True):
            words = Words(pa.array([text], pa.string()), lower=True)
            length, own = item_shingles(words.strings(0), k)
            if not own:
                continue
            starts = words.window_starts(length)
            hashes = np.unique(run_hashes(words.hashes(), starts, starts + length))
            missing = len(own) * (100 - percent) // 100
            parts[length, len(own).bit_length()].append((len(self.items), hashes[: missing + 1]))
            self.items.append((item, own))
        self.parts = defaultdict(list)
        for (length, _), sketches in parts.items():
            values = np.concatenate([s for _, s in sketches])
            owners = np.repeat([n for n, _ in sketches], [len(s) for _, s in sketches])
            order = np.argsort(values, kind="stable")
            self.parts[length].append((values[order], owners[order]))

    def found(self, words: Words) -> list[tuple[int, int, int, int]]:
        """(document, item, its shingles, those shared) for contained items."""
        hashes, doc_of, out = words.hashes(), words.doc_of_word(), []
        for length, parts in self.parts.items():
            starts = words.window_starts(length)
            if not len(starts):
                continue
            own = run_hashes(hashes, starts, starts + length)
            pairs = set()
            for values, owners in parts:
                near = np.flatnonzero(own <= values[-1])
                lo = np.searchsorted(values, own[near], "left")
                near, lo = near[values[lo] == own[near]], lo[values[lo] == own[near]]
                hi = np.searchsorted(values, own[near], "right")
                while len(near):  # a value may belong to several items
                    pairs.update(zip(doc_of[starts[near]].tolist(), owners[lo].tolist(), strict=True))
                    lo = lo + 1
                    near, lo, hi = near[lo < hi], lo[lo < hi], hi[lo < hi]
            by_doc = defaultdict(list)
            for doc, item in pairs:
                by_doc[doc].append(item)
            for doc, items in by_doc.items():
                text = words.strings(doc)
                there = {tuple(text[i : i + length]) for i in range(len(text) - length + 1)}
                for n in items:
                    item, wanted = self.items[n]
                    shared = len(wanted & there)
                    if 100 * shared >= self.percent * len(wanted):
                        out.append((doc, item, len(wanted), shared))
        return out


def _is_small(items: DataFrame, block_bytes: int) -> bool:
    return (items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0) <= block_bytes


def _broadcast(items: DataFrame, k: int, percent: int):
    """The sketches of all of ``items``, which are small."""
    rows = items.select("item_id", "text").toArrow()
    return items.sparkSession.sparkContext.broadcast(Sketches(rows.column(0).to_pylist(), rows.column(1).to_pylist(), k, percent))


def _leaks_in(sketches):
    def leaks(batches):
        for batch in batches:
            for part in sliced(batch):
                rows = sketches.value.found(Words(part.column("text"), lower=True))
                if rows:
                    docs, items, sizes, shared = zip(*rows, strict=True)
                    ids = part.column("doc_id").take(pa.array(docs))
                    yield pa.RecordBatch.from_arrays(
                        [ids.cast(pa.int64()), pa.array(items, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shared, pa.int64())],
                        names=["doc_id", "item_id", "n_shingles", "n_shared"],
                    )

    return leaks


def _without(sketches):
    def clean(batches):
        for batch in batches:
            for part in sliced(batch):
                stays = np.ones(part.num_rows, bool)
                stays[[doc for doc, *_ in sketches.value.found(Words(part.column("text"), lower=True))]] = False
                yield part.filter(pa.array(stays))

    return clean


def _sketched(k: int, percent: int):
    """(length, value, item): the sketch values of items."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch):
                found = Sketches(part.column("row").to_pylist(), part.column("text").to_pylist(), k, percent)
                for length, parts in found.parts.items():
                    for values, owners in parts:
                        rows = np.array([i for i, _ in found.items], np.int64)[owners]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), length, np.int32)), pa.array(values.view(np.int64)), pa.array(rows)], names=["length", "value", "item"])

    return run


def _probes(lengths: list[int], bitmap):
    """(digest, length, value): the distinct shingles of each text that the bitmap lets through."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch):
                words = Words(part.column("text"), lower=True)
                hashes, doc_of = words.hashes(), words.doc_of_word()
                for length in lengths:
                    starts = words.window_starts(length)
                    own = run_hashes(hashes, starts, starts + length)
                    near = np.flatnonzero(bitmap.value[own % np.uint64(BITS)])
                    digest = part.column("digest").take(pa.array(doc_of[starts[near]]))
                    yield pa.RecordBatch.from_arrays([digest, pa.array(np.full(len(near), length, np.int32)), pa.array(own[near].view(np.int64))], names=["digest", "length", "value"])

    return run


def _verified(k: int, percent: int):
    """Of candidates (digest, item, text, item_text) those that contain the item: digest, item, its shingles and those shared."""

    def run(batches):
        for batch in batches:
            out = []
            for digest, item, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("digest", "item", "text", "item_text")), strict=True):
                length, own = item_shingles(Words(pa.array([wanted]), lower=True).strings(0), k)
                words = Words(pa.array([text]), lower=True).strings(0)
                shared = len(own & {tuple(words[i : i + length]) for i in range(len(words) - length + 1)})
                if 100 * shared >= percent * len(own):
                    out.append((digest, item, len(own), shared))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], kind) for n, kind in enumerate(kinds)], names=["digest", "item", "n_shingles", "n_shared"])

    return run


def _digest() -> F.Column:
    return F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")


def _leaks_by_join(docs: DataFrame, items: DataFrame, k: int, percent: int) -> DataFrame:
    """(digest, item_id, n_shingles, n_shared) of the texts of ``docs`` that contain an item, one row per distinct text and row of ``items``."""
    numbered = stored(items.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("long").alias("item_id"), "text"), "items")
    sketches = stored(numbered.mapInArrow(_sketched(k, percent), "length int, value long, item long"), "sketches")
    bitmap = np.zeros(BITS, bool)
    # at most BITS places, however many items there are: those of a 64-bit value taken as unsigned
    places = sketches.select(F.pmod("value", F.lit(BITS)).cast("int").alias("p")).distinct().toArrow().column("p")
    bitmap[places.to_numpy()] = True
    lengths = sorted(r["length"] for r in sketches.select("length").distinct().collect())  # at most k
    texts = docs.select(_digest(), "text").where("text IS NOT NULL")
    probes = texts.mapInArrow(_probes(lengths, docs.sparkSession.sparkContext.broadcast(bitmap)), "digest binary, length int, value long").distinct()
    hits = stored(probes.join(sketches, ["length", "value"]).select("digest", "item").distinct(), "candidates")
    one = texts.join(hits.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
    pairs = hits.join(one, "digest").join(numbered.select(F.col("row").alias("item"), F.col("text").alias("item_text")), "item")
    found = pairs.select("digest", "item", "text", "item_text").mapInArrow(_verified(k, percent), "digest binary, item long, n_shingles long, n_shared long")
    return stored(found.join(numbered.select(F.col("row").alias("item"), "item_id"), "item").select("digest", "item_id", "n_shingles", "n_shared"), "leaks")


def find_leaks(docs: DataFrame, items: DataFrame, *, k: int = 5, percent: int = 80, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and contained item: doc_id, item_id, n_shingles (of the item), n_shared.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read. Items of up to ``block_bytes`` of
    text in all are broadcast to one scan of the documents; more are joined with them. Whole texts are read, very long
    ones too. A-Z are lower-cased. An item of fewer than k words is one shingle of its own length; an item or document
    without words, or with a null text, matches nothing. Repeated documents or items give repeated rows, one per pair of
    rows; null ids are carried as null. Empty tables give no rows.
    """
    if _is_small(items, block_bytes):
        return docs.select("doc_id", "text").mapInArrow(_leaks_in(_broadcast(items, k, percent)), SCHEMA)
    found = _leaks_by_join(docs, items, k, percent)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest()).join(found, "digest").select("doc_id", "item_id", "n_shingles", "n_shared")


def leak_free(docs: DataFrame, items: DataFrame, *, k: int = 5, percent: int = 80, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows whose text contains an item. Each row is judged by its own text, whatever its id."""
    if _is_small(items, block_bytes):
        return docs.mapInArrow(_without(_broadcast(items, k, percent)), docs.schema)
    found = _leaks_by_join(docs, items, k, percent).select("digest").distinct()
    rows = docs.select(_digest(), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    return rows.join(found, "digest", "left_anti").select("_row.*")
