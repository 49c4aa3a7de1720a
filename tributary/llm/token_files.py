"""Token ids in flat binary files that training jobs map into memory.

A part is three files: ``.bin``, the ids of its documents one after another, as unsigned 16- or 32-bit integers;
``.off``, 64-bit offsets into them, one more than documents; ``.doc``, the 64-bit document ids, those that are null (as
0) first. Parts are in ascending order of document ids; a part's base is the number of ids in the parts before it, a
prefix sum over the manifest.

Each task attempt writes files under names of its own and reports them in its output row. A lost executor's work is done
again under new names, and files that no row of the manifest names are not part of the data set.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.blocks import salted
from tributary.llm.encoding import SLICE_BYTES, encoder
from tributary.llm.text import sliced
from tributary.workspace import stored

MANIFEST = "name string, first_id long, first_text long, salt long, n_docs long, n_null long, n_tokens long, width int"


def _at(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, *, width: int = 4, part_bytes: int = 32 << 20, special_as_text: bool = False) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into parts of about ``part_bytes`` of text under ``folder``.

    Returns the manifest (MANIFEST). A null or empty text is ``end_id`` alone. Documents with a null id come first; equal
    ids are ordered by a hash of the text, and may be in several parts. Repeated rows are written each. A part is written
    as it is read, a few texts at a time, so that only a single very long text must fit into memory. An empty table
    gives an empty manifest. ``width``: bytes of an id; an id that does not fit is an error. Strings of the tokenizer's
    special tokens become their ids, as in the library, unless ``special_as_text``. Other columns are not read.
    """
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    parts = max(1, math.ceil(total / part_bytes))

    def write(batches: Iterator[pa.RecordBatch]):
        files, root = _at(folder)
        files.create_dir(root, recursive=True)
        name, own = uuid.uuid4().hex, encoder(tokenizer, special_as_text)
        offsets, docs, nulls, place, first, kind = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], 0, 0, None, np.dtype(f"<u{width}")
        with files.open_output_stream(f"{root}/{name}.bin") as out:
            for batch in batches:
                for some in sliced(batch, most=SLICE_BYTES):
                    ids, bounds = own.encode(some.column("text"), end_id)
                    if ids.max() >= 1 << 8 * width:
                        raise ValueError(f"id {ids.max()} does not fit in {width} bytes")
                    out.write(ids.astype(kind).tobytes())
                    offsets.append(bounds[1:] + place)
                    place += len(ids)
                    docs.append(some.column("doc_id").fill_null(0).to_numpy().copy())  # a view would hold the texts
                    nulls += some.column("doc_id").null_count
                    first = first or (some.column("doc_id")[0].as_py(), some.column("by_text")[0].as_py(), some.column("_salt")[0].as_py())
        if first:
            ends, docs = np.concatenate(offsets), np.concatenate(docs)
            for end, values in (("off", ends), ("doc", docs)):
                with files.open_output_stream(f"{root}/{name}.{end}") as out:
                    out.write(values.astype("<i8").tobytes())
            columns = [[name], [first[0]], [first[1]], [first[2]], [len(docs)], [nulls], [place], [width]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, [pa.string(), *[pa.int64()] * 6, pa.int32()], strict=True)], names=[x.split()[0] for x in MANIFEST.split(", ")])
        else:
            files.delete_file(f"{root}/{name}.bin")

    keyed = salted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), part_bytes).select("doc_id", "text", F.xxhash64("text").alias("by_text"), "_salt")
    ordered = keyed.repartitionByRange(parts, "doc_id", "by_text", "_salt").sortWithinPartitions("doc_id", "by_text", "text")
    return stored(ordered.mapInArrow(write, MANIFEST), "manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``. It holds one row for each part (text / ``part_bytes``: 3 million at 100 TB), so that one task can sum it."""
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_text", "salt", "name").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class Part:
    """One part; local files are mapped into memory, others are read."""

    def __init__(self, folder: str, name: str, width: int):
        files, root = _at(folder)

        def values(end: str, kind: str) -> np.ndarray:
            if files.type_name == "local":
                path = f"{root}/{name}.{end}"
                return np.memmap(path, kind, "r") if files.get_file_info(path).size else np.zeros(0, kind)
            with files.open_input_file(f"{root}/{name}.{end}") as source:
                return np.frombuffer(source.read_buffer(), kind)

        self.ids, self.offsets, self.docs = values("bin", f"<u{width}"), values("off", "<i8"), values("doc", "<i8")

    def __getitem__(self, k: int) -> np.ndarray:
        return self.ids[self.offsets[k] : self.offsets[k + 1]]


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                part = Part(folder, row["name"], row["width"])
                sums = [zlib.crc32(part[k].astype("<u4").tobytes()) for k in range(len(part.docs))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(part.docs), pa.int64(), mask=np.arange(len(part.docs)) < row["n_null"]),
                        pa.array(row["base"] + np.array(part.offsets[:-1])),
                        pa.array(np.diff(part.offsets)),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = with_bases(manifest)
    spread = rows.repartition(max(1, rows.sparkSession.sparkContext.defaultParallelism), "name")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
