"""Exchanges of hashed keys between blocks of documents, in packed arrays.

Documents are dealt by a hash of their ids into blocks of bounded size. A block sends its distinct keys, with a few
bytes about each, to parts of the key space, in one row for each part; a part gathers a key's values from all blocks and
answers each block with an array in the order of the keys it sent. A key sends one value from each block however often
it occurs, so that no key weighs on a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.text import distinct, sliced
from tributary.workspace import stored

BLOCK_BYTES = 8 << 20
SENT = "part long, block long, keys binary, about binary"
ANSWER = "block long, step int, part long, about binary, told array<long>"


def salted(docs: DataFrame, most_bytes: int, *, id_col: str = "doc_id", text_col: str = "text", salt: str = "_salt") -> DataFrame:
    """``docs`` with ``salt``, which spreads rows that repeat one id and text until they fill more than ``most_bytes``.

    Such rows get a number each, and are stored with it, so that all that is made of them sees the same numbers; others
    get 0.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row, id_, text = "_row_of_" + salt, F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    keyed = docs.select(F.struct(*columns).alias("_all"), F.xxhash64(id_, text).alias(row))
    sizes = docs.select(F.xxhash64(id_, text).alias(row), (F.coalesce(F.octet_length(text), F.lit(0)) + 64).cast("long").alias("_bytes"))
    often = sizes.groupBy(row).agg(F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_n")).where((F.col("_bytes") > most_bytes) & (F.col("_n") > 1))
    often = stored(often.select(row), "repeated")
    own = [F.col("_all")[c].alias(c) for c in docs.columns]
    if not often.limit(1).count():
        return docs.select(*columns, F.lit(0).cast("long").alias(salt))
    numbered = keyed.withColumn(salt, F.monotonically_increasing_id()).join(often, row, "left_semi")
    numbered = stored(numbered.select(*own, salt), "repeated")
    return keyed.join(often, row, "left_anti").select(*own, F.lit(0).cast("long").alias(salt)).unionByName(numbered)


def into_blocks(docs: DataFrame, *columns, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(block, doc_id, text, columns...) and the number of blocks. Rows are dealt by their id and text together, see ``salted``."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 64)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.struct(F.lit(0), *columns).alias("_own"))
    names = docs.select(*columns).columns
    dealt = salted(own, block_bytes)
    block = F.pmod(F.xxhash64(F.lit("block"), "doc_id", "text", "_salt"), F.lit(blocks).cast("long")).alias("block")
    return dealt.select(block, F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col("_own")[c].alias(c) for c in names)), blocks


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 64-bit key; ascending keys have ascending parts."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their differences, byte by byte from the lowest: the upper bytes are mostly zeros."""
    steps = np.diff(keys, prepend=keys.dtype.type(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(len(steps), -1).T).tobytes()


def unpacked_keys(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(steps, dtype=kind)


def encoded(values: np.ndarray, kind: str) -> bytes:
    """``kind``: a numpy type; ``bool`` for bits; ``count`` for numbers from 0 that are mostly below 255."""
    if kind == "bool":
        return np.packbits(values).tobytes()
    if kind == "count":
        return np.minimum(values, 255).astype(np.uint8).tobytes() + values[values >= 255].astype("<i8").tobytes()
    return values.astype(kind).tobytes()


def decoded(data: bytes, n: int, kind: str) -> np.ndarray:
    if kind == "bool":
        return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)
    if kind == "count":
        values = np.frombuffer(data, np.uint8, n).astype(np.int64)
        values[values == 255] = np.frombuffer(data, "<i8", offset=n)
        return values
    return np.frombuffer(data, kind)


def sent(block: int, keys: np.ndarray, part: np.ndarray, about: np.ndarray, kind: str) -> pa.Table:
    """Rows of SENT for keys in ascending order, in each part; ``kind`` is that of ``about`` (see ``encoded``)."""
    cuts = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1))
    ends = np.append(cuts[1:], len(part))[: len(cuts)]
    return pa.table(
        {
            "part": pa.array(part[cuts].astype(np.int64)),
            "block": pa.array(np.full(len(cuts), block, np.int64)),
            "keys": pa.array([packed_keys(keys[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary()),
            "about": pa.array([encoded(about[a:b], kind) for a, b in zip(cuts, ends, strict=True)], pa.binary()),
        }
    )


def received(rows: pa.Table, key_type: str, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of rows of SENT, what is said about them, and where each row's end."""
    keys = [unpacked_keys(x, key_type) for x in rows.column("keys").to_pylist()]
    about = [decoded(x, len(k), kind) for x, k in zip(rows.column("about").to_pylist(), keys, strict=True)]
    return np.concatenate(keys), np.concatenate(about), np.cumsum([len(k) for k in keys])


def answered(parts: DataFrame, step: int, key_type: str, about_kind: str, answer_kind: str, decide: Callable, tell: Callable | None = None) -> DataFrame:
    """Gather each part's keys; ``decide(places, n, about)`` gives an array of answers, one for each value that was sent.

    ``places`` numbers the part's distinct keys, ``n`` of them, in the order of the values. ``tell(keys, places, about)``
    gives numbers about the part, which its first row carries in ``told``.
    """

    def gather(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        keys, about, ends = received(rows, key_type, about_kind)
        known, places = distinct(keys.astype(np.uint64))
        found = decide(places, len(known), about)
        starts = np.concatenate([[0], ends[:-1]])
        return pa.table(
            {
                "block": rows.column("block"),
                "step": pa.array(np.full(rows.num_rows, step, np.int32)),
                "part": rows.column("part"),
                "about": pa.array([encoded(found[a:b], answer_kind) for a, b in zip(starts, ends, strict=True)], pa.binary()),
                "told": pa.array([tell(known, places, about) if tell and not n else None for n in range(rows.num_rows)], pa.list_(pa.int64())),
            }
        )

    return parts.groupBy("part").applyInArrow(gather, ANSWER)


def read_answer(answers: pa.Table, step: int, part: np.ndarray, kind: str) -> np.ndarray:
    """The answers of one step, in the order of the keys that were sent; ``part`` is each key's part."""
    rows = sorted((p, a) for s, p, a in zip(answers.column("step").to_pylist(), answers.column("part").to_pylist(), answers.column("about").to_pylist(), strict=True) if s == step)
    sizes = np.diff(np.append(np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1)), len(part)))  # none without keys
    found = [decoded(a, int(n), kind) for (_, a), n in zip(rows, sizes, strict=True)]
    return np.concatenate(found) if found else np.zeros(0, bool if kind == "bool" else np.int64)


def block_of(rows: pa.Table) -> int:
    return rows.column("block")[0].as_py()


def text_slices(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The rows of a block, a few texts at a time."""
    for batch in rows.combine_chunks().to_batches():
        yield from sliced(batch)
