"""Words and hashes of word sequences, computed with numpy over Arrow columns inside Spark tasks.

A word is a run of bytes other than space, tab, LF, VT, FF and CR. Hashes are 64 bits: a polynomial over random byte
codes, so that the hash of any run of bytes or words is a difference of prefix sums, followed by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_CODES = np.random.default_rng(20_240_607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 2 * len(_powers[k])), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of a 64-bit hash over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each run values[start:end]; equal runs have equal hashes wherever they stand."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    size = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + size * np.uint64(0xD6E8FEB86659FD93))


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``values`` (unsigned 64-bit numbers), ascending, and the place among them of each.

    What np.unique gives. Numbers are sorted by their upper bits, the first that any has, together with where they stand,
    which takes one sort of plain numbers; should two of them share those bits only, they are sorted in full.
    """
    n = len(values)
    if not n:
        return values, np.zeros(0, np.int64)
    low = np.uint64((1 << n.bit_length()) - 1)
    unused = np.uint64(64 - int(values.max()).bit_length())
    order = (np.sort((values << unused & ~low) | np.arange(n, dtype=np.uint64)) & low).astype(np.int64)
    ordered = values[order]
    if (ordered[1:] < ordered[:-1]).any():
        return np.unique(values, return_inverse=True)
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    places = np.empty(n, np.int64)
    places[order] = np.cumsum(new) - 1
    return ordered[new], places


class Words:
    """The words of a few texts: documents are rows of ``texts``; ``first[d]`` to ``first[d + 1]`` are the words of d."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        _, places, data = texts.buffers()
        offsets = np.frombuffer(places, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.bytes = _LOWER[raw] if lower else raw
        inside = np.zeros(len(raw) + 1, bool)
        inside[:-1] = ~_WHITE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(len(raw) + 1, bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | edge))
        self.end = np.flatnonzero(before & (~inside | edge))
        self.first = np.searchsorted(self.start, self.offsets)
        self.docs = len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return run_hashes(_CODES[self.bytes], self.start, self.end)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), self.counts)

    def window_starts(self, k: int) -> np.ndarray:
        """Words that begin k consecutive words of one document."""
        last = np.repeat(self.first[1:], self.counts)
        return np.flatnonzero(np.arange(len(self.start)) + k <= last)

    def strings(self, doc: int) -> list[bytes]:
        whole = self.bytes[self.offsets[doc] : self.offsets[doc + 1]].tobytes()
        at = self.offsets[doc]
        return [whole[s - at : e - at] for s, e in zip(self.start[self.first[doc] : self.first[doc + 1]], self.end[self.first[doc] : self.first[doc + 1]], strict=True)]


def sliced(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with about ``most`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(lo, hi - lo)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and the document of each; with fewer words than k, the whole sequence is one."""
    hashes = words.hashes()
    starts = words.window_starts(k)
    ends = starts + k
    few = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(few):
        starts, ends = np.concatenate([starts, words.first[few]]), np.concatenate([ends, words.first[few + 1]])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
    return run_hashes(hashes, starts, ends), words.doc_of_word()[starts] if len(starts) else np.zeros(0, np.int64)
