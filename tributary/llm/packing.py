"""Packing by vector bin packing with the dot-product heuristic.

A sequence has limits on tokens, segments and loss-bearing tokens. Pieces are dealt by a hash into blocks of bounded
size; in a block, the open sequence takes, of the pieces that fit all its limits, the one whose vector has the largest
dot product with the room left, weighted by how scarce each kind of room is. Pieces with equal vectors are one class, so
that a choice looks at classes, of which there are few. Where pieces may be cut, one is cut to fill the sequence to the
end. All ids of a document bear loss; of a conversation only those of turns with given roles do.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.encoding import SLICE_BYTES, encoder
from tributary.llm.text import mix, run_hashes, sliced

PIECES = "block long, doc_id long, turn long, start long, doc_tokens long, loss long, ids binary"
PACKED = "doc_id long, turn long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss long, ids binary"
PER_BLOCK = 1 << 24


def pieces_of(texts: DataFrame, tokenizer: str, end_id: int, capacity: int, loss_tokens: int, blocks: int, special_as_text: bool = False) -> DataFrame:
    """The ids of each row of ``texts`` (doc_id, turn, text, bears) with ``end_id``, cut into pieces that fit a sequence.

    All ids of a row bear loss, or none. A piece goes to a block by a hash of its row, place, ids and partition, so that
    a row that is repeated does not fall into one block.
    """

    def cut(batches: Iterator[pa.RecordBatch]):
        own, salt = encoder(tokenizer, special_as_text), np.uint64(TaskContext.get().partitionId())
        for batch in batches:
            for some in sliced(batch, most=SLICE_BYTES):
                ids, bounds = own.encode(some.column("text"), end_id)
                bears = some.column("bears").to_numpy(zero_copy_only=False)
                sizes, most = np.diff(bounds), np.where(bears, min(capacity, loss_tokens), capacity)
                pieces = -(-sizes // most)
                row = np.repeat(np.arange(len(sizes)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * most[row]
                lo = bounds[row] + start
                hi = np.minimum(lo + most[row], bounds[row + 1])
                about = mix(some.column("doc_id").fill_null(-1).to_numpy().astype(np.uint64)[row] + mix(start.astype(np.uint64) + salt))
                block = (run_hashes(ids.astype(np.uint64) + np.uint64(1), lo, hi) ^ about) % np.uint64(blocks)
                data = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(np.append(lo, len(ids)) * 4), pa.py_buffer(ids)])
                columns = [block.astype(np.int64), *(some.column(c).take(pa.array(row)) for c in ("doc_id", "turn")), start, sizes[row], np.where(bears[row], hi - lo, 0), data.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names=[x.split()[0] for x in PIECES.split(", ")])

    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("turn").cast("long").alias("turn"), "text", F.coalesce("bears", F.lit(False)).alias("bears")).mapInArrow(cut, PIECES)


def fill(lengths: np.ndarray, loss: np.ndarray, limits: tuple[int, int, int], cut: bool) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (piece, from, to). A piece may be cut only where none or all of its ids bear loss."""
    if (lengths > limits[0]).any() or (loss > limits[2]).any():
        raise ValueError("a piece is larger than a sequence")
    vectors, which = np.unique(np.column_stack([lengths, loss]), axis=0, return_inverse=True)
    waiting: list[list[tuple[int, int]]] = [[] for _ in vectors]  # (piece, ids of it that are placed)
    for k, c in reversed(list(enumerate(which.ravel().tolist()))):
        waiting[c].append((k, 0))
    place = {v: c for c, v in enumerate(map(tuple, vectors.tolist()))}
    size, own_loss = (np.array(x, float) for x in vectors.T) if len(vectors) else (np.zeros(0), np.zeros(0))
    there = np.array([len(x) for x in waiting], float)
    room_at_first = np.array(limits, float)
    done: list[list[tuple[int, int, int]]] = []
    left = np.array([lengths.sum(), len(lengths), loss.sum()], float)

    def take(c: int) -> tuple[int, int]:
        nonlocal left
        there[c] -= 1
        left -= (size[c], 1, own_loss[c])
        return waiting[c].pop()

    while left[1] > 0:
        room, members = room_at_first.copy(), []
        scarce = left / room_at_first
        weight = scarce / max(scarce.max(), 1e-9) / room_at_first**2
        while room[0] > 0 and room[1] > 0 and left[1] > 0:
            fits = (there > 0) & (size <= room[0]) & (own_loss <= room[2])
            if fits.any():
                c = int(np.where(fits, size * room[0] * weight[0] + room[1] * weight[1] + own_loss * room[2] * weight[2], -1.0).argmax())
                k, at = take(c)
                members.append((k, at, at + int(size[c])))
                room -= (size[c], 1, own_loss[c])
                continue
            able = (there > 0) & ((own_loss == 0) | ((own_loss == size) & (room[2] > 0))) if cut else np.zeros(1, bool)
            if not able.any():
                break
            c = int(np.where(able, size, -1.0).argmax())
            bears = own_loss[c] > 0
            part = int(min(room[0], room[2] if bears else room[0]))
            k, at = take(c)
            members.append((k, at, at + part))
            room -= (part, 1, part if bears else 0)
            rest = (int(size[c]) - part, int(size[c]) - part if bears else 0)
            if rest not in place:
                place[rest] = len(waiting)
                waiting.append([])
                size, own_loss, there = np.append(size, rest[0]), np.append(own_loss, rest[1]), np.append(there, 0)
            waiting[place[rest]].append((k, at + part))
            there[place[rest]] += 1
            left += (rest[0], 1, rest[1])
        done.append(members)
    return done


def trimmed(members: list[tuple[int, int, int]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """A sequence that is not full, as sequences whose lengths are powers of two, which need no padding."""
    total = sum(b - a for _, a, b in members)
    if total == capacity:
        return [members]
    out, rest = [], list(members)
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            room, own = 1 << bit, []
            while room:
                k, a, b = rest[0]
                size = min(room, b - a)
                own.append((k, a, a + size))
                rest[0:1] = [(k, a + size, b)] if a + size < b else []
                room -= size
            out.append(own)
    return out


def pack_pieces(pieces: DataFrame, *, capacity: int, segments: int, loss_tokens: int, cut: bool) -> DataFrame:
    """Pack pieces (PIECES), block by block, into sequences (PACKED, one row for each part of a piece in a sequence)."""
    limits = (capacity, segments, loss_tokens)

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([(c, "ascending") for c in ("doc_id", "turn", "start", "ids")])
        block = rows.column("block")[0].as_py()
        ids = [np.frombuffer(x, "<u4") for x in rows.column("ids").to_pylist()]
        sequences = fill(np.array([len(x) for x in ids]), rows.column("loss").to_numpy(), limits, cut)
        if cut:
            rows_loss = rows.column("loss").to_pylist()
            # Only sequences short of their end for want of pieces or of segments are left; they become powers of two.
            sequences = [t for s in sequences for t in (trimmed(s, capacity) if all(rows_loss[k] in (0, len(ids[k])) for k, _, _ in s) else [s])]
        if len(sequences) > PER_BLOCK:
            raise ValueError("a block has too many sequences")
        which, lo, hi, seq, offset = [], [], [], [], []
        for n, members in enumerate(sequences):
            at = 0
            for k, a, b in members:
                which.append(k)
                lo.append(a)
                hi.append(b)
                seq.append(block * PER_BLOCK + n)
                offset.append(at)
                at += b - a
        own = rows.take(pa.array(which, pa.int64())).combine_chunks()
        cuts = [ids[k][a:b].tobytes() for k, a, b in zip(which, lo, hi, strict=True)]
        loss = [min(x, b - a) for x, a, b in zip(own.column("loss").to_pylist(), lo, hi, strict=True)]
        return pa.Table.from_arrays(
            [
                own.column("doc_id"),
                own.column("turn"),
                pa.array(own.column("start").to_numpy() + np.array(lo)),
                pa.array(np.array(hi) - np.array(lo)),
                pa.array([zlib.crc32(x) for x in cuts], pa.int64()),
                own.column("doc_tokens"),
                pa.array(seq, pa.int64()),
                pa.array(offset, pa.int64()),
                pa.array(loss, pa.int64()),
                pa.array(cuts, pa.binary()),
            ],
            names=[x.split()[0] for x in PACKED.split(", ")],
        )

    return pieces.groupBy("block").applyInArrow(pack, PACKED)


def _blocks(texts: DataFrame, block_bytes: int) -> int:
    total = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    return max(1, math.ceil(total / block_bytes))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, *, capacity: int = 2048, segments: int = 256, block_bytes: int = 4 << 20) -> DataFrame:
    """Pack whole ``docs`` (doc_id, text) into sequences of ``capacity`` ids at most: PACKED without turn, with the ids of each piece.

    A null or empty text is ``end_id`` alone; null ids and repeated rows are packed like others; an empty table gives no
    rows; other columns are not read. A block is about ``block_bytes`` of text, and holds pieces, not whole documents, so
    that a very long text is spread over blocks. Of equal dot products the shorter piece is taken, and of equal pieces the
    first by id, place and ids; the same table in the same partitions gives the same sequences.
    """
    texts = docs.select("doc_id", F.lit(None).alias("turn"), "text", F.lit(True).alias("bears"))
    pieces = pieces_of(texts, tokenizer, end_id, capacity, capacity, _blocks(docs, block_bytes))
    return pack_pieces(pieces, capacity=capacity, segments=segments, loss_tokens=capacity, cut=True).drop("turn")


def pack_turns(turns: DataFrame, tokenizer: str, end_id: int, *, capacity: int = 2048, segments: int = 16, loss_tokens: int = 1024, roles: tuple[str, ...] = ("assistant",), block_bytes: int = 4 << 20) -> DataFrame:
    """Pack the turns of conversations (conv_id, turn, role, text): PACKED with conv_id for doc_id.

    A turn is an example. Those of ``roles`` bear loss on all their ids, others, and those without a role, on none; a
    sequence holds at most ``segments`` of them and ``loss_tokens`` ids that bear loss. Only turns that are longer than a
    sequence may be are cut, at multiples of that. Null and empty texts, null ids, repeated rows, ties, other columns and
    empty tables as for documents; a conversation may be of any length, as its turns go to blocks each for itself.
    """
    texts = turns.select(F.col("conv_id").alias("doc_id"), "turn", "text", F.col("role").isin(*roles).alias("bears"))
    pieces = pieces_of(texts, tokenizer, end_id, capacity, loss_tokens, _blocks(turns, block_bytes))
    return pack_pieces(pieces, capacity=capacity, segments=segments, loss_tokens=loss_tokens, cut=False).withColumnRenamed("doc_id", "conv_id")
