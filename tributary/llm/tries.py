"""Similarity self-join of sets in one prefix tree."""

from __future__ import annotations

import numpy as np

from tributary.llm.text import mix


def in_order(items: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places of ``items`` in the global order: by rank, then by a hash that is not the item itself."""
    return np.lexsort([items, mix(items), ranks])


class Trie:
    """Sets stored as a prefix tree of runs, with their items in the global order from its far end, the most frequent first:
    so near copies share long paths, and a set that has none of one leaves all of them at once.

    A node covers a range of the sorted sets; its run is what they share beyond its parent. ``shortest`` and ``longest``
    are the sizes of the sets below it. ``codes`` holds every (set, item) as one ascending number; ``begin`` and
    ``owners`` say which sets have an item.
    """

    def __init__(self, sets: list[np.ndarray], ranks: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets])
        items, at, flat = np.unique(np.concatenate(sets), return_index=True, return_inverse=True)
        place = np.empty(len(items), np.int32)
        place[in_order(items, np.concatenate(ranks)[at])[::-1]] = np.arange(len(items), dtype=np.int32)
        flat = place[flat]
        own = [np.sort(flat[e - n : e]) for n, e in zip(sizes, np.cumsum(sizes), strict=True)]
        self.order = sorted(range(len(own)), key=lambda k: own[k].astype(">i4").tobytes())
        self.sets = [own[k] for k in self.order]
        self.sizes, self.items = sizes[self.order], len(items)
        self.ends = np.cumsum(self.sizes)
        owner = np.repeat(np.arange(len(own)), self.sizes)
        flat = np.concatenate(self.sets)
        self.codes = owner * self.items + flat
        by_item = np.argsort(flat, kind="stable")
        self.begin, self.owners = np.searchsorted(flat[by_item], np.arange(self.items + 1)), owner[by_item]
        common = [_common(a, b) for a, b in zip(self.sets, self.sets[1:], strict=False)]
        self.root = self._node(np.array(common, np.int64), 0, len(own), 0)

    def _node(self, common: np.ndarray, lo: int, hi: int, depth: int) -> tuple:
        """(lo, hi, run, shortest, longest, children) of the sets lo to hi, which share their first ``depth`` items."""
        first = (lo, hi, depth)
        made: dict[tuple, tuple] = {}
        stack = [(first, False)]
        while stack:
            (lo, hi, depth), ready = key, seen = stack.pop()
            end = int(common[lo : hi - 1].min()) if hi - lo > 1 else len(self.sets[lo])
            cuts = [lo, *(np.flatnonzero(common[lo : hi - 1] == end) + lo + 1).tolist(), hi] if hi - lo > 1 else []
            parts = [(a, b, end) for a, b in zip(cuts, cuts[1:], strict=False)]
            if not seen:
                stack.append((key, True))
                stack += [(p, False) for p in parts]
            else:
                sizes = self.sizes[lo:hi]
                made[key] = (lo, hi, self.sets[lo][depth:end], int(sizes.min()), int(sizes.max()), [made.pop(p) for p in parts])
        return made[first]

    def _shared(self, run: np.ndarray, seekers: np.ndarray) -> np.ndarray:
        """How many items of ``run`` each of the sets ``seekers`` has: from the items' owners or the sets, whichever are fewer."""
        owned = self.begin[run + 1] - self.begin[run]
        if owned.sum() <= 16 * len(seekers) * len(run):
            before = np.cumsum(owned) - owned
            some = self.owners[np.repeat(self.begin[run] - before, owned) + np.arange(owned.sum())]
            return np.bincount(some, minlength=len(self.sets))[seekers]
        code = (seekers[:, None] * self.items + run[None, :]).ravel()
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return (self.codes[at] == code).reshape(len(seekers), len(run)).sum(1)

    def linked(self, percent: int, labels: np.ndarray) -> np.ndarray:
        """Labels (one for each set, as given) after joining those of sets a and b with 100 |a & b| >= percent |a | b|.

        The tree is walked once. All sets that may still fit something below a node come to it together, each with its
        overlap with the path, which all sets below share. A set leaves where the sizes below and the lengths that
        remain, of the path and of its own items behind the path's last one, cannot bring the overlap up to the bound,
        or where all below have its label.
        """
        labels = labels[self.order].copy()
        everyone = np.arange(len(self.sets))
        stack = [(self.root, everyone, np.zeros(len(everyone), np.int64), 0)]
        while stack:
            (lo, hi, run, shortest, longest, children), seekers, overlap, depth = stack.pop()
            stays = seekers < hi - 1 if children else seekers < lo  # each pair once
            if (labels[lo:hi] == labels[lo]).all():
                stays &= labels[seekers] != labels[lo]
            # Before the run is compared: the sizes below.
            sizes = self.sizes[seekers]
            stays &= (100 * longest >= percent * sizes) & (100 * sizes >= percent * shortest)
            seekers, overlap = seekers[stays], overlap[stays]
            if not len(seekers):
                continue
            if len(run):
                overlap = overlap + self._shared(run, seekers)
                depth += len(run)
            sizes = self.sizes[seekers]
            if children:
                last = seekers * self.items + (run[-1] if len(run) else -1)
                rest = self.ends[seekers] - np.searchsorted(self.codes, last, "right") if len(run) else sizes
                best = np.clip(depth + rest, shortest, longest)  # the size below that suits a set best
                most = overlap + np.minimum(best - depth, rest)
                stays = (100 + percent) * most >= percent * (best + sizes)
                seekers, overlap = seekers[stays], overlap[stays]
                if len(seekers):
                    stack += [(child, seekers, overlap, depth) for child in children]
            else:
                for k in seekers[(100 + percent) * overlap >= percent * (depth + sizes)].tolist():
                    if labels[k] != labels[lo]:
                        labels[labels == labels[k]] = labels[lo]
        out = np.empty_like(labels)
        out[self.order] = labels
        return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the longest common prefix."""
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n
