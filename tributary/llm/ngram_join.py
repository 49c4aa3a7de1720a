"""N-gram Jaccard join with prefix trees.

All sets' n-grams have one global order, the rarest first: by the number of sets that have them (its logarithm, in 1024ths),
then by hash. Two sets that are similar enough share one of the first n - ceil(t n) + 1 of their n items, so that each set
is filed under these only; what is filed together, and of a fitting size, is a cluster; passages that many documents share
come last and are seldom filed. The sets of a cluster go into a prefix tree in the global order, which is walked once by
all of them, overlaps with a path being shared by all below it; see ``tries``. Equal sets are one class throughout.

A cluster of any size is handled: it is cut into blocks that share a few pivot sets, each block has a tree of its own,
and the sets that are then outside the cluster's largest component are joined with all its blocks.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.blocks import SENT, answered, block_of, decoded, encoded, into_blocks, packed_keys, part_of, read_answer, sent, text_slices, unpacked_keys
from tributary.llm.graph import components
from tributary.llm.skew import join_counted
from tributary.llm.text import Words, shingles, sliced
from tributary.llm.tries import Trie, in_order
from tributary.workspace import stored

MEASURED = "doc_id long, digest binary, n long, key binary"
FILED = "part long, salt long, items binary, which binary, keys binary, sizes binary, spans binary, links binary, key binary, ranks binary"
FILED_TYPES = [pa.int64()] * 2 + [pa.binary()] * 8


def sets_of(batch: pa.RecordBatch, k: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    words = Words(batch.column("text"), lower=True)
    hashes, owner = shingles(words, k)
    first = np.searchsorted(owner, np.arange(words.docs + 1))
    return [np.unique(hashes[a:b]) for a, b in zip(first, first[1:], strict=False)]


def key_of(own: np.ndarray) -> bytes:
    return hashlib.md5(own.tobytes(), usedforsecurity=False).digest()


def _measure(k: int):
    def rows(batches):
        for batch in batches:
            for part in sliced(batch):
                sets = sets_of(part, k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("digest"), pa.array([len(s) for s in sets], pa.int64()), pa.array([key_of(s) for s in sets], pa.binary())],
                    names=["doc_id", "digest", "n", "key"],
                )

    return rows


def distinct_sets(rows: pa.Table, k: int) -> dict[bytes, np.ndarray]:
    """The sets of a block by their keys."""
    found: dict[bytes, np.ndarray] = {}
    for some in text_slices(rows.select(["text"])):
        for own in sets_of(some, k):
            if len(own):
                found.setdefault(key_of(own), own)
    return found


def _codes(items: np.ndarray, parts: int) -> np.ndarray:
    """What the frequency of an item is counted by: its part and 32 bits. Items that share a code only share a rank."""
    return part_of(items, parts) << np.uint64(32) | items & np.uint64(0xFFFFFFFF)


def _count(k: int, parts: int):
    """Ask in how many sets each item of a block is."""

    def ask(rows: pa.Table) -> pa.Table:
        sets = distinct_sets(rows, k)
        codes, n = np.unique(_codes(np.concatenate([np.zeros(0, np.uint64), *sets.values()]), parts), return_counts=True)
        return sent(block_of(rows), codes.astype(np.uint32), codes >> np.uint64(32), n, "count")

    return ask


def _add(places: np.ndarray, n: int, counts: np.ndarray) -> np.ndarray:
    return np.bincount(places, counts, minlength=n).astype(np.int64)[places]


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Logarithms of counts, in 1024ths of a doubling: of two items the one with the higher rank is in more sets."""
    return (np.log2(np.maximum(counts, 1)) * 1024).astype("<u2")


def _runs(item: np.ndarray, low: np.ndarray, high: np.ndarray, owner: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Chain what is filed under one item while sizes fit, each entry being a set or a run of sets with sizes from low to high.

    Item, smallest owner and largest size of each chain; and for the entries chained to one, its owner and their own.
    """
    order = np.lexsort([owner, low, item])
    item, low, high, owner = item[order], low[order], high[order], owner[order]
    new = np.ones(len(item), bool)
    new[1:] = item[1:] != item[:-1]
    segment = np.cumsum(new) << 34
    reach = np.maximum.accumulate(segment + high) - segment
    new[1:] |= 100 * reach[:-1] < percent * low[1:]
    at = np.flatnonzero(new)
    high = np.maximum.reduceat(high, at) if len(at) else high
    return item[at], owner[at], high, owner[at][np.cumsum(new) - 1][~new], owner[~new]


def _links(a: np.ndarray, b: np.ndarray, keys: np.ndarray) -> bytes:
    """The distinct pairs of keys, 16 bytes each."""
    n = max(len(keys), 1)
    pairs = np.unique((a * n + b)[a != b])
    return np.column_stack([keys[pairs // n], keys[pairs % n]]).tobytes()


def _packed(item: np.ndarray, owner: np.ndarray, high: np.ndarray, keys: np.ndarray, sizes: np.ndarray, links: bytes, parts: int, part: int, salt: int) -> pa.Table:
    """Rows of FILED: one for each part of the item space, and one for ``part`` with the links found so far."""
    own = part_of(item, parts).astype(np.int64)
    cuts = np.flatnonzero(np.diff(own, prepend=-1))
    out: list[tuple] = [(part, salt, b"", b"", b"", b"", b"", links)] if links else []
    for a, b in zip(cuts, np.append(cuts[1:], len(own))[: len(cuts)], strict=True):
        sets, which = np.unique(owner[a:b], return_inverse=True)
        spans = encoded(high[a:b] - sizes[owner[a:b]], "count")
        out.append((int(own[a]), salt, packed_keys(item[a:b]), which.astype("<u4").tobytes(), keys[sets].tobytes(), sizes[sets].astype("<u4").tobytes(), spans, b""))
    return _filed([(*row, None, None) for row in out])


def _filed(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(FILED_TYPES)
    return pa.table([pa.array(x, t) for x, t in zip(columns, FILED_TYPES, strict=True)], names=[x.split()[0] for x in FILED.split(", ")])


def _distinct_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key (a pair of words) stands first in key order, and each key's number among them."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
    same = np.empty(len(order), np.int64)
    same[order] = np.cumsum(new) - 1
    return order[new], same


def _unpacked(rows: pa.Table) -> tuple:
    """Items, owners and largest sizes of rows of FILED, the owners' keys and sizes, and the links found so far."""
    columns = {c: rows.column(c).to_pylist() for c in ("items", "which", "keys", "sizes", "spans", "links")}
    keys, sizes = np.frombuffer(b"".join(columns["keys"]), "<u8").reshape(-1, 2), np.frombuffer(b"".join(columns["sizes"]), "<u4").astype(np.int64)
    before = np.concatenate([[0], np.cumsum([len(x) // 4 for x in columns["sizes"]])])
    item = np.concatenate([unpacked_keys(x, "<u8") for x in columns["items"]])
    owner = np.concatenate([np.frombuffer(x, "<u4").astype(np.int64) + n for x, n in zip(columns["which"], before[:-1], strict=True)])
    high = sizes[owner] + np.concatenate([decoded(x, len(w) // 4, "count") for x, w in zip(columns["spans"], columns["which"], strict=True)])
    # One number for each class: the same set may have come from several blocks.
    at, same = _distinct_keys(keys)
    return item, same[owner], high, keys[at], sizes[at], b"".join(columns["links"])


def _file(k: int, percent: int, parts: int, file_parts: int, salts: int):
    """File each set under the first items of its global order: a block sends the runs of each item, and links within them.

    Of a set that may have a partner the ranks of its items, in ascending order of the items, are sent as well.
    """

    def file(rows: pa.Table, answers: pa.Table) -> pa.Table:
        sets = dict(sorted(distinct_sets(rows, k).items()))
        items, owners, sizes, ranked = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], np.array([len(s) for s in sets.values()], np.int64), []
        codes = np.unique(_codes(np.concatenate([items[0], *sets.values()]), parts))
        times = read_answer(answers, 0, codes >> np.uint64(32), "count")
        for n, (key, own) in enumerate(sets.items()):
            count = times[np.searchsorted(codes, _codes(own, parts))]
            ranks = ranks_of(count)
            # Parts are ranges of hashes: ties are broken by another hash, or the first parts would get most.
            first = in_order(own, ranks)[: len(own) - (percent * len(own) + 99) // 100 + 1]
            items.append(own[first])
            owners.append(np.full(len(first), n))
            if (count[first] > 1).any():
                ranked.append((*[None] * 8, key, ranks.tobytes()))
        item, owner = np.concatenate(items), np.concatenate(owners)
        keys = np.frombuffer(b"".join(sets), "<u8").reshape(-1, 2)
        item, owner, high, a, b = _runs(item, sizes[owner], sizes[owner], owner, percent)
        block = block_of(rows) if rows.num_rows else 0
        return pa.concat_tables([_packed(item, owner, high, keys, sizes, _links(a, b, keys), file_parts, block % file_parts, block % salts), _filed(ranked)])

    return file


def _reduced(percent: int, file_parts: int):
    """Chain the runs of the blocks of one salt."""

    def reduce(rows: pa.Table) -> pa.Table:
        item, owner, high, keys, sizes, links = _unpacked(rows)
        item, owner, high, a, b = _runs(item, sizes[owner], high, owner, percent)
        return _packed(item, owner, high, keys, sizes, links + _links(a, b, keys), file_parts, rows.column("part")[0].as_py(), 0)

    return reduce


def _candidates(percent: int):
    """Chain the runs of each item; each set is joined to the smallest of its run, and that to the smallest of its chain."""

    def gather(rows: pa.Table) -> pa.Table:
        item, owner, high, keys, sizes, links = _unpacked(rows)
        *_, a, b = _runs(item, sizes[owner], high, owner, percent)
        both = np.frombuffer(links + _links(a, b, keys), np.uint8).reshape(-1, 2, 16)
        side = lambda n: pa.Array.from_buffers(pa.binary(16), len(both), [None, pa.py_buffer(both[:, n].tobytes())]).cast(pa.binary())
        return pa.table({"a": side(0), "b": side(1)})

    return gather


def _joined(k: int, percent: int):
    """Join the sets of each group (cluster, place) in a prefix tree: edges from each set to its component's first key."""

    def join(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("cluster", "ascending"), ("place", "ascending"), ("key", "ascending")]).combine_chunks()
        sets: list[np.ndarray] = []
        for batch in rows.select(["text"]).to_batches():
            for some in sliced(batch):
                sets += sets_of(some, k)
        cluster, place, keys, labels, ranks = (rows.column(c).to_pylist() for c in ("cluster", "place", "key", "label", "ranks"))
        a, b = [], []
        lo = 0
        for hi in range(1, len(sets) + 1):
            if hi < len(sets) and (cluster[hi], place[hi]) == (cluster[lo], place[lo]):
                continue
            members = list({keys[n]: n for n in range(lo, hi)}.values())  # one key may have come twice
            if len(members) > 1:
                names: dict[bytes, int] = {}
                start = np.array([names.setdefault(labels[n] or keys[n], len(names)) for n in members])
                found = Trie([sets[n] for n in members], [np.frombuffer(ranks[n], "<u2") for n in members]).linked(percent, start)
                centre: dict[int, bytes] = {}
                for n, label in zip(members, found.tolist(), strict=True):
                    if centre.setdefault(label, keys[n]) != keys[n]:
                        a.append(keys[n])
                        b.append(centre[label])
            lo = hi
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return join


def text_digest(column: str = "text"):
    """128 bits that stand for a text; null for a null text."""
    return F.unhex(F.md5(F.col(column).cast("binary")))


def _trees(docs: DataFrame, members: DataFrame, ranked: DataFrame, k: int, percent: int, group_items: int) -> DataFrame:
    """Edges found by the trees of ``members`` (digest, cluster, place, key, label, n), several small trees to a task.

    ``ranked`` has the ranks of the items of each key's set.
    """
    total = members.agg(F.sum("n")).first()[0] or 0
    groups = max(1, math.ceil(total / group_items))
    dealt = members.withColumn("_group", F.pmod(F.xxhash64("cluster", "place"), F.lit(groups)))
    # A merge join at every size: members of a small corpus would be broadcast, those of a large one may not be.
    # Each digest has one text, whatever ids its documents have: a member gets one row.
    dealt = dealt.join(ranked.hint("merge"), "key")
    texts = docs.where(F.col("text").isNotNull()).groupBy(text_digest().alias("digest")).agg(F.first("text").alias("text")).join(dealt.hint("merge"), "digest")
    return texts.select("_group", "cluster", "place", "key", "label", "ranks", "text").groupBy("_group").applyInArrow(_joined(k, percent), "a binary, b binary")


def _linked(docs: DataFrame, k: int, percent: int, block_sets: int, block_items: int, part_items: int, pivots: int, block_bytes: int, most_blocks: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, n, key) of each row of ``docs``, and (key, doc_id, _docs, _label): the class of each key, its rows and its component."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = stored(docs.withColumn("digest", text_digest()).mapInArrow(_measure(k), MEASURED), "measured")
    total = measured.agg(F.sum("n")).first()[0] or 0
    blocked, parts = into_blocks(docs, block_bytes=block_bytes)
    answers = answered(blocked.groupBy("block").applyInArrow(_count(k, parts), SENT), 0, "<u4", "count", "count", _add)
    file_parts = max(1, math.ceil(total * (100 - percent) / 100 / part_items))
    # Of each item a block sends runs, not sets; where blocks are many, their runs are chained in two steps.
    salts = math.ceil(parts / most_blocks)
    filed = blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_file(k, percent, parts, file_parts, salts), FILED)
    filed = stored(filed, "filed")
    ranked = filed.where("key IS NOT NULL").groupBy("key").agg(F.first("ranks").alias("ranks"))
    filed = filed.where("part IS NOT NULL")
    if salts > 1:
        filed = filed.groupBy("part", "salt").applyInArrow(_reduced(percent, file_parts), FILED)
    near = filed.groupBy("part").applyInArrow(_candidates(percent), "a binary, b binary")
    classes = measured.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min("digest").alias("digest"), F.min("n").alias("n"), F.count(F.lit(1)).alias("_docs"))

    clusters = components(near).select(F.col("node").alias("key"), F.col("label").alias("cluster"))
    inside = stored(clusters.join(classes.drop("doc_id", "_docs"), "key"), "members")
    scale = inside.groupBy("cluster").agg(F.count(F.lit(1)).alias("_sets"), F.sum("n").alias("_items"))
    blocks = F.greatest(F.ceil(F.col("_sets") / block_sets), F.ceil(F.col("_items") / block_items)).cast("int")
    scale = stored(scale.select("cluster", "_sets", F.col("_sets").alias("_rows"), blocks.alias("_blocks")), "scale")
    inside = stored(join_counted(inside, scale, "cluster", "_rows"), "members")
    chance = F.pmod(F.xxhash64(F.lit("pivot"), "key"), F.col("_sets"))
    own_block = F.pmod(F.xxhash64("key"), F.col("_blocks")).cast("int")
    several = F.col("_blocks") > 1
    places = F.when(several & (chance < pivots), F.sequence(F.lit(0), F.col("_blocks") - 1)).otherwise(F.array(own_block))
    members = inside.select("digest", "cluster", F.explode(places).alias("place"), "key", F.lit(None).cast("binary").alias("label"), "n")
    links = stored(_trees(docs, members, ranked, k, percent, block_items), "links")
    labels = components(links)
    if inside.where(several).limit(1).count():
        links = links.union(_outside(docs, inside.where(several), ranked, labels, own_block, k, percent, block_sets, block_items))
        labels = components(stored(links, "links"))

    label = F.coalesce("label", "key")
    named = classes.join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", "doc_id", "_docs", label.alias("_label"))
    return measured, stored(named, "classes")


def join_similar(
    docs: DataFrame, *, k: int = 5, percent: int = 80, block_sets: int = 4096, block_items: int = 1 << 21, part_items: int = 1 << 19, pivots: int = 16, block_bytes: int = 4 << 20, most_blocks: int = 1 << 14
) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Words are lower-cased in A-Z; two documents link if 100 |a & b| >= percent |a | b| for their sets of distinct k-word
    shingles (with fewer words, the whole sequence). component_id is the smallest doc_id reachable by links. Without
    words, or with a null text, the set is empty, linked with nothing, and component_id the own id. Repeated rows and
    equal sets are linked; a null id is never a component's smallest, so that component_id is null only where all its
    documents have null ids. Empty tables give no rows; other columns are not read.
    """
    measured, named = _linked(docs, k, percent, block_sets, block_items, part_items, pivots, block_bytes, most_blocks)
    least = stored(named.groupBy("_label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_keys")), "least")
    named = stored(join_counted(named, least, "_label", "_keys").select("key", "_docs", "component_id"), "classes")
    found = join_counted(measured.where("n > 0"), named, "key", "_docs").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.unionByName(measured.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _outside(docs, inside, ranked, labels, own_block, k, percent, block_sets, block_items) -> DataFrame:
    """Join the sets outside the largest component of their cluster with all blocks of the cluster."""
    named = inside.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    named = stored(named, "labelled")
    counts = named.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("_n"))
    largest = stored(counts.groupBy("cluster").agg(F.max_by("label", F.struct("_n", "label")).alias("_largest"), F.sum("_n").alias("_all"), F.sum("_n").alias("_rows")), "largest")
    outer = stored(join_counted(named, largest, "cluster", "_rows").where("label <> _largest"), "outer")
    size = outer.groupBy("cluster").agg(F.count(F.lit(1)).alias("_out"), F.sum("n").alias("_out_items"), F.first("_all").alias("_all"))
    cuts = F.greatest(F.ceil(F.col("_out") / block_sets), F.ceil(F.col("_out_items") / block_items)).cast("int")
    size = stored(size.select("cluster", cuts.alias("_cuts"), "_out", "_all"), "outer_sizes")
    place = lambda block, cut: F.struct(block.alias("block"), cut.alias("cut"))
    all_sets = join_counted(named, size.drop("_out"), "cluster", "_all").select("*", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)).alias("_cut"))
    all_sets = all_sets.select("digest", "cluster", place(own_block, F.col("_cut")).alias("place"), "key", "label", "n")
    own_cut = F.pmod(F.xxhash64("key"), F.col("_cuts")).cast("int")
    outer = join_counted(outer.drop("_all"), size.drop("_all"), "cluster", "_out").select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
    outer = outer.select("digest", "cluster", place(F.col("_block"), own_cut).alias("place"), "key", "label", "n")
    both = all_sets.unionByName(outer).withColumn("place", F.col("place.block").cast("long") * (1 << 31) + F.col("place.cut"))
    return _trees(docs, both, ranked, k, percent, block_items)


def one_of_each(docs: DataFrame, *, k: int = 5, percent: int = 80, block_sets: int = 4096, block_items: int = 1 << 21, part_items: int = 1 << 19, pivots: int = 16, block_bytes: int = 4 << 20, most_blocks: int = 1 << 14) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, null ids being the largest, and the smallest digest.

    Of equal rows one stays. Rows without words all stay.
    """
    measured, named = _linked(docs, k, percent, block_sets, block_items, part_items, pivots, block_bytes, most_blocks)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    least = measured.where("n > 0").groupBy("key").agg(first).join(named.select("key", "_label"), "key").groupBy("_label").agg(F.min("first").alias("first"))
    row = lambda doc_id, digest: F.md5(F.concat(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), F.lit(" "), F.hex(digest)).cast("binary"))
    stays = least.select(row(F.col("first.doc_id"), F.col("first.digest")).alias("_row"))
    some = F.coalesce(F.col("text").rlike("[^ \\t\\n\\x0B\\f\\r]"), F.lit(False))
    rows = docs.where(some).groupBy(row(F.col("doc_id"), text_digest()).alias("_row")).agg(F.first(F.struct(*docs.columns)).alias("_first"))
    return rows.join(stays.hint("merge"), "_row").select("_first.*").unionByName(docs.where(~some))
