"""Token ids of whole texts by the tokenizers library, an Arrow column at a time.

Texts are cut where the tokenizer's own splitting cuts them for certain: a byte-level tokenizer cuts before a run of
ASCII white space, before the last character of one, and behind that unless it is a space; one that drops white space
cuts before all of it; both cut between Latin letters and ASCII punctuation other than the apostrophe. Arrow finds the
distinct pieces of a slice of texts, new ones are encoded, and all ids are gathered by offsets. Pieces already encoded
are remembered, up to a bound. Letters alone or punctuation alone are one word to the tokenizer's model and are given to
it directly; other pieces go through the whole tokenizer.

A text that holds the string of an added token, or white space beyond ASCII next to other white space, is one piece, and
so are all texts of tokenizers of other kinds.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tributary.llm.text import _WHITE

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MOST_PIECES, MOST_IDS = 1 << 18, 1 << 21
AT_ONCE = 4096
SLICE_BYTES = 1 << 20
# White space beyond ASCII in UTF-8.
WIDE_SPACES = [*map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]

_FIRST = np.zeros(256, bool)
_FIRST[[c.encode()[0] for c in WIDE_SPACES]] = True
_WIDE = {c.encode() for c in WIDE_SPACES}
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK[list(_MARKS)] = True
#: Letters whose lower case and composition do not depend on their neighbours, or punctuation.
_PLAIN = re.compile(rb"(?:(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+|[" + re.escape(_MARKS) + rb"]+)\Z")


def _byte_characters() -> dict[int, str]:
    """What stands for each byte in byte-level vocabularies: itself if it can be printed, else the next free character."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + n) for n, b in enumerate(hidden)}


_BYTES = _byte_characters()


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data, self.n = np.zeros(1 << 10, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(max(len(values), len(self.data)), self.data.dtype)])
        self.data[self.n : self.n + len(values)] = values
        self.n += len(values)


class Encoder:
    """``encode(texts)``: ids and where each text's begin. ``special_as_text``: added tokens' strings are ordinary text."""

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        before, normalizer = (json.loads(x.__getstate__()) if x else {} for x in (self.tokenizer.pre_tokenizer, self.tokenizer.normalizer))
        added, steps = self.tokenizer.get_added_tokens_decoder().values(), before.get("pretokenizers", [])
        self.kind = "whole"
        if not normalizer and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space"):
            self.kind = "bytes"
        elif [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0].get("invert") and steps[0].get("behavior") == "Removed":
            self.kind = "words"
        if any(x.normalized or x.lstrip or x.rstrip or x.single_word for x in added):
            self.kind = "whole"
        self.added = [] if special_as_text else [x.content.encode() for x in added]
        self.lower = self.kind == "words" and "Lowercase" in json.dumps(normalizer)
        self.model = self.tokenizer.model
        self.latest: tuple[list[bytes], np.ndarray] = [], np.zeros(0, np.int64)
        self._forget()

    def _forget(self) -> None:
        """Remember only the pieces of the latest slice: most of those that are frequent are among them."""
        pieces, slots = self.latest
        kept = (pieces, *self._gathered(slots)) if pieces else None
        self.slots: dict[bytes | int, int] = {}
        self.ids, self.begin, self.size = Grown("<u4"), Grown(np.int64), Grown(np.int64)
        if kept:
            self._remember(*kept)

    def _gathered(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces in ``slots``, one after another, and how many each has."""
        sizes = self.size.data[slots]
        before = np.cumsum(sizes) - sizes
        return self.ids.data[np.repeat(self.begin.data[slots] - before, sizes) + np.arange(sizes.sum())], sizes

    def _remember(self, keys: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.slots.update(zip(keys, range(self.begin.n, self.begin.n + len(keys)), strict=True))
        self.begin.add(self.ids.n + np.cumsum(sizes) - sizes)
        self.size.add(sizes)
        self.ids.add(ids)

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces."""
        words, others, found = [], [], []
        for piece in pieces:
            word = piece.lstrip(b" \t\n\v\f\r") if self.kind == "words" else piece[piece[:1] == b" " :]
            if self.kind == "whole" or not _PLAIN.match(word):
                others.append(piece)
                continue
            words.append(piece)
            if self.lower:
                word = word.decode().lower().encode()
            shown = word.decode() if word.isascii() else word.decode("latin-1").translate(_BYTES)
            found.append([t.id for t in self.model.tokenize(shown if self.kind == "words" or word == piece else _BYTES[32] + shown)])
        for lo in range(0, len(others), AT_ONCE):
            found += [x.ids for x in self.tokenizer.encode_batch_fast([x.decode() for x in others[lo : lo + AT_ONCE]], add_special_tokens=False)]
        self._remember(words + others, np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)))

    def _whole(self, raw: np.ndarray, offsets: np.ndarray, white: np.ndarray) -> np.ndarray:
        """Texts that are one piece."""
        whole = [np.zeros(0, np.int64)]
        if self.added:
            data = raw.tobytes()
            for token in self.added:
                at = data.find(token)
                while at >= 0:
                    whole.append(np.array([at]))
                    at = data.find(token, at + 1)
        if self.kind == "bytes":
            first = np.flatnonzero(_FIRST[raw])
            sizes = np.where(raw[first] == 0xC2, 2, 3)
            wide = [raw[a : a + n].tobytes() in _WIDE for a, n in zip(first.tolist(), sizes.tolist(), strict=True)]
            first, after = first[wide], (first + sizes)[wide]
            space = white.copy()
            space[first] = True
            beside = space[np.minimum(after, len(raw) - 1)] & (after < len(raw))
            beside |= white[np.maximum(first - 1, 0)] & (first > 0)
            whole.append(first[beside])
        return np.unique(np.searchsorted(offsets, np.concatenate(whole), "right") - 1)

    def _cuts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin."""
        n = len(raw)
        begins = np.zeros(n + 1, bool)
        begins[offsets] = True
        if self.kind == "whole":
            return np.flatnonzero(begins[:-1])
        white = _WHITE[raw]
        cut = white.copy()
        cut[1:] &= ~white[:-1] | begins[1:-1]
        if self.kind == "bytes":
            last = np.flatnonzero(white[:-1] & ~white[1:] & ~begins[1:-1])  # the last of a run that a word follows
            cut[last] = True
            cut[last[raw[last] != 0x20] + 1] = True
        mark, letter = _MARK[raw], _LETTER[raw]
        wide = np.flatnonzero(raw[:-1] == 0xC3)  # letters of two bytes, but for two signs
        wide = wide[(raw[wide + 1] & 0xDF) != 0x97]
        ends = letter.copy()
        letter[wide] = ends[wide + 1] = True
        cut[1:] |= (mark[1:] & ends[:-1]) | (letter[1:] & mark[:-1])
        for d in self._whole(raw, offsets, white):
            cut[offsets[d] : offsets[d + 1]] = False
        return np.flatnonzero(cut | begins[:-1])

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end_id``, and where each text's begin (one more than texts).

        A null text is empty. Ids are unsigned 32-bit integers.
        """
        if self.begin.n > MOST_PIECES or self.ids.n > MOST_IDS:
            self._forget()
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        texts = texts.cast(pa.large_string())
        _, places, data = texts.buffers()
        offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        cuts = self._cuts(raw, offsets)
        known = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(raw)).astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
        _, places, data = known.dictionary.buffers()
        data, places = data.to_pybytes() if data is not None else b"", np.frombuffer(places, np.int64, len(known.dictionary) + 1).tolist()
        pieces = [data[a:b] for a, b in pairwise(places)]
        if missing := [x for x in pieces if x not in self.slots]:
            self._learn(missing)
        self.latest = pieces, np.fromiter(map(self.slots.__getitem__, pieces), np.int64, len(pieces))
        slots = self.latest[1][known.indices.to_numpy()]
        first = np.searchsorted(cuts, offsets)
        if end_id is not None:
            if end_id not in self.slots:
                self._remember([end_id], np.array([end_id], "<u4"), np.array([1]))
            slots = np.insert(slots, first[1:], self.slots[end_id])
            first = first + np.arange(len(first))
        ids, sizes = self._gathered(slots)
        return ids, np.concatenate([[0], np.cumsum(sizes)])[first]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """One encoder for each Python worker."""
    if (path, special_as_text) not in _encoders:
        _encoders[path, special_as_text] = Encoder(path, special_as_text)
    return _encoders[path, special_as_text]
