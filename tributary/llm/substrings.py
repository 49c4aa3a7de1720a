"""Exact substring deduplication with fixed-block anchors.

A repeat of W words holds, wherever it stands in a document, a whole block of A = (W + 1) // 2 words that begins at a
multiple of A. The index takes these non-overlapping blocks of all documents; every rolling window of A words probes it.
A probe that finds a block elsewhere is an anchor. Anchors are extended: each W-word window around one is compared, as a
whole, with those around all others, which joins up to the maximal exact repeats; a window that also starts in a
document with a smaller id is removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tributary.llm.blocks import SENT, answered, block_of, into_blocks, part_of, read_answer, sent, text_slices
from tributary.llm.text import Words, distinct, run_hashes
from tributary.workspace import stored

KEPT = "doc_id long, n_words long, n_removed long, kept_text string"
NO_ID = np.iinfo(np.int64).max


class Block:
    """The words of one block's documents, held as hashes, and where its anchors and windows stand."""

    def __init__(self, rows: pa.Table, window: int, parts: int):
        self.window, self.anchor, self.parts = window, (window + 1) // 2, parts
        hashes, counts = [], []
        for some in text_slices(rows.select(["doc_id", "text"])):
            words = Words(some.column("text"))
            hashes.append(words.hashes())
            counts.append(words.counts)
        self.hashes, self.counts = np.concatenate(hashes), np.concatenate(counts)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        ids = rows.column("doc_id").fill_null(NO_ID).to_numpy()
        self.id_of_word = np.repeat(ids, self.counts)
        self.place = np.arange(len(self.hashes)) - np.repeat(self.first[:-1], self.counts)
        self.after = np.repeat(self.first[1:], self.counts)

    def starts(self, k: int) -> np.ndarray:
        return np.flatnonzero(np.arange(len(self.hashes)) + k <= self.after)

    def probes(self):
        """Distinct rolling windows: their parts and 32-bit keys, whether any is an index block or occurs twice."""
        at = self.starts(self.anchor)
        hashes = run_hashes(self.hashes, at, at + self.anchor)
        code = part_of(hashes, self.parts) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)
        codes, places = distinct(code)
        times = np.bincount(places, minlength=len(codes))
        index = np.zeros(len(codes), bool)
        index[places[self.place[at] % self.anchor == 0]] = True
        return at, codes, places, index, times

    def extended(self, at: np.ndarray, anchors: np.ndarray):
        """Distinct whole windows around anchors, with the smallest id that has each in this block."""
        change = np.zeros(len(self.hashes) + 1, np.int64)
        active = at[anchors]
        lowest = np.maximum(active - (self.window - self.anchor), active - self.place[active])
        np.add.at(change, lowest, 1)
        np.add.at(change, active + 1, -1)
        near = np.cumsum(change)[:-1] > 0
        starts = self.starts(self.window)
        starts = starts[near[starts]]
        keys = run_hashes(self.hashes, starts, starts + self.window)
        found, places = distinct(keys)
        least = np.full(len(found), NO_ID)
        np.minimum.at(least, places, self.id_of_word[starts])
        return starts, found, places, least


def _repeated(places: np.ndarray, n: int, flags: np.ndarray) -> np.ndarray:
    """Keys that an index block has and that occur twice or more."""
    times = np.bincount(places, 1 + (flags >> 1), minlength=n)
    index = np.bincount(places, flags & 1, minlength=n)
    return ((times >= 2) & (index > 0))[places]


def _smaller_elsewhere(places: np.ndarray, n: int, ids: np.ndarray) -> np.ndarray:
    least = np.full(n, NO_ID)
    np.minimum.at(least, places, ids)
    return least[places] < ids


def kept_texts(rows: pa.Table, removed: np.ndarray) -> pa.Array:
    """Each document's words that are not removed, joined by one space."""
    out, at = [], 0
    for some in text_slices(rows.select(["doc_id", "text"])):
        words = Words(some.column("text"))
        keep = ~removed[at : at + len(words.start)]
        at += len(words.start)
        start, end, doc = words.start[keep], words.end[keep], words.doc_of_word()[keep]
        change = np.zeros(len(words.bytes) + 1, np.int8)
        np.add.at(change, start, 1)
        np.add.at(change, end, -1)
        mask = np.cumsum(change[:-1], dtype=np.int8) > 0
        data = words.bytes.copy()
        gaps = end[:-1][doc[:-1] == doc[1:]]  # white space follows a word that another one follows
        data[gaps], mask[gaps] = 0x20, True
        offsets = np.concatenate([[0], np.cumsum(mask)])[words.offsets].astype(np.int32)
        out.append(pa.Array.from_buffers(pa.string(), words.docs, [None, pa.py_buffer(offsets), pa.py_buffer(data[mask])]))
    return pa.chunked_array(out, pa.string())


def remove_repeats(docs: DataFrame, *, window: int = 50, block_bytes: int = 8 << 20, keep: list[str] | None = None) -> DataFrame:
    """KEPT and the columns ``keep``: one row per document of ``docs`` (doc_id, text): its words, those removed, and the rest joined by a space.

    A word goes if a window of ``window`` consecutive words over it also starts in a document with a smaller id; windows
    are judged on the input. Null texts have no words. A null id is larger than all others and equal to itself, as are
    repeated ids, which do not remove each other. Empty tables give no rows; other columns are not read, and ``keep`` may not name those of
    KEPT or ``block``.
    """
    kept = [c for c in keep or [] if c != "text"]
    blocked, parts = into_blocks(docs, *kept, block_bytes=block_bytes)
    out = blocked.select("doc_id", *(keep or [])).schema
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_text", "string")):
        out = out.add(name, kind)

    def probe(rows: pa.Table) -> pa.Table:
        _, codes, _, index, times = Block(rows, window, parts).probes()
        flags = (index | (times > 1).astype(np.uint8) << 1).astype(np.uint8)
        return sent(block_of(rows), codes.astype(np.uint32), codes >> np.uint64(32), flags, "u1")

    def anchors_of(block: Block, answers: pa.Table):
        at, codes, places, _, _ = block.probes()
        return at, read_answer(answers, 0, codes >> np.uint64(32), "bool")[places]

    def extend(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return sent(0, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0), "<i8")
        block = Block(rows, window, parts)
        _, keys, _, least = block.extended(*anchors_of(block, answers))
        return sent(block_of(rows), keys, part_of(keys, parts), least, "<i8")

    def remove(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({name: [] for name in out.names})
        block = Block(rows, window, parts)
        starts, keys, places, least = block.extended(*anchors_of(block, answers))
        elsewhere = read_answer(answers, 1, part_of(keys, parts), "bool")
        gone = starts[elsewhere[places] | (least[places] < block.id_of_word[starts])]
        change = np.zeros(len(block.hashes) + window + 1, np.int64)
        np.add.at(change, gone, 1)
        np.add.at(change, gone + window, -1)
        removed = np.cumsum(change)[: len(block.hashes)] > 0
        total = np.concatenate([[0], np.cumsum(removed)])
        return pa.table(
            {
                **{name: rows.column(name) for name in out.names[:-3]},
                "n_words": pa.array(block.counts),
                "n_removed": pa.array(total[block.first[1:]] - total[block.first[:-1]]),
                "kept_text": kept_texts(rows, removed),
            }
        )

    anchors = answered(blocked.groupBy("block").applyInArrow(probe, SENT), 0, "<u4", "u1", "bool", _repeated)
    anchors = stored(anchors, "anchors")
    windows = blocked.groupBy("block").cogroup(anchors.groupBy("block")).applyInArrow(extend, SENT)
    smaller = answered(windows, 1, "<u8", "<i8", "bool", _smaller_elsewhere)
    return blocked.groupBy("block").cogroup(anchors.unionByName(smaller).groupBy("block")).applyInArrow(remove, out)
