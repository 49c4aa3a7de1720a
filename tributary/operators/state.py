"""State tables that cost what changes: rows by key in hash buckets, as a base and deltas, listed in a manifest.

A write adds one delta to each bucket that its keys fall into and leaves the others alone; a bucket with many deltas is
merged into a new base by the same write. A reader merges the deltas of the buckets it needs, and reads others as they
are. Manifests are small files with numbers; the next one is made by a rename that fails if another writer was first.
That writer's buckets are then taken over, unless they are those of this write and were read for it.
"""

from __future__ import annotations

import dataclasses
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.workspace import shuffles_removed

VERSION, WRITER, BUCKET = "_version", "_writer", "_bucket"


@dataclasses.dataclass(frozen=True)
class Manifest:
    """A version of the table: its buckets' folders, oldest first; the columns; the last mark of each writer that gives marks."""

    version: int
    buckets: int
    columns: T.StructType
    files: dict[int, list[str]]
    marks: dict[str, int]

    def text(self) -> str:
        return json.dumps({"version": self.version, "buckets": self.buckets, "columns": self.columns.jsonValue(), "files": self.files, "marks": self.marks})

    @classmethod
    def of(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(found["version"], found["buckets"], T.StructType.fromJson(found["columns"]), {int(k): v for k, v in found["files"].items()}, found["marks"])


class KeyedStore:
    """One state table in a folder: the row of each ``key`` with the largest ``updated`` counts, at equal times the later write."""

    def __init__(self, spark: SparkSession, folder: str, key: list[str], *, updated: str = "updated_at", buckets: int = 64, most_deltas: int = 8, keep: int = 3):
        self.spark, self.folder, self.key, self.updated = spark, folder.rstrip("/"), key, updated
        self.buckets, self.most_deltas, self.keep = buckets, most_deltas, keep

    # Files.

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str = "") -> list[str]:
        path, files = self._path(folder)
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def _versions(self) -> list[int]:
        return sorted(int(n[9:-5]) for n in self._names() if n.startswith("manifest-") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The latest version, or that one; None for an empty table."""
        found = self._versions()
        if not found:
            return None
        path, files = self._path(f"manifest-{version or found[-1]}.json")
        stream = files.open(path)
        try:
            return Manifest.of(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: Manifest) -> bool:
        """Whether this manifest became the next version."""
        new, files = self._path(f"new-{uuid.uuid4().hex}")
        stream = files.create(new, False)
        stream.write(bytearray(manifest.text().encode()))
        stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self.spark._jsc.hadoopConfiguration())
        no_overwrite = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        at = self._path(f"manifest-{manifest.version}.json")[0]
        try:
            context.rename(context.makeQualified(new), context.makeQualified(at), no_overwrite)
            return True
        except Exception:
            files.delete(new, False)
            if manifest.version in self._versions():
                return False
            raise

    # Reading.

    def bucket(self, columns: T.StructType, buckets: int) -> Column:
        key = [F.col(f"`{k}`").cast(columns[k].dataType) for k in self.key]
        return F.pmod(F.xxhash64(*key), F.lit(buckets).cast("long")).cast("int")

    def touched(self, keys: DataFrame, manifest: Manifest) -> list[int]:
        """The buckets that ``keys`` fall into: as many numbers as there are buckets, at most."""
        return sorted(r[0] for r in keys.select(self.bucket(manifest.columns, manifest.buckets)).distinct().collect())

    def _rows(self, manifest: Manifest, folders: list[str]) -> DataFrame:
        inner = T.StructType([*manifest.columns, T.StructField(VERSION, T.LongType()), T.StructField(WRITER, T.StringType())])
        return self.spark.read.schema(inner).parquet(*(f"{self.folder}/{f}" for f in folders))

    def _latest(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        rest = [c for c in columns if c not in self.key]
        order = F.struct(self.updated, VERSION, WRITER)
        latest = rows.groupBy(*self.key).agg(F.max_by(F.struct(*rest, VERSION, WRITER), order).alias("_row"))
        return latest.select(*self.key, *(F.col("_row")[c].alias(c) for c in (*rest, VERSION, WRITER))).select(*columns, VERSION, WRITER)

    def _merged(self, manifest: Manifest, buckets: list[int]) -> DataFrame:
        """The rows of ``buckets``; only those with deltas are grouped by their keys."""
        columns = manifest.columns.names
        whole = [manifest.files[b][0] for b in buckets if len(manifest.files.get(b, [])) == 1]
        layered = [f for b in buckets if len(manifest.files.get(b, [])) > 1 for f in manifest.files[b]]
        parts = [self._rows(manifest, whole)] if whole else []
        if layered:
            parts.append(self._latest(self._rows(manifest, layered), columns))
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*manifest.columns, T.StructField(VERSION, T.LongType()), T.StructField(WRITER, T.StringType())]))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, keys: DataFrame | None = None, manifest: Manifest | None = None) -> DataFrame | None:
        """The table as of ``manifest`` (the latest); with ``keys``, the buckets that these fall into. None for an empty table."""
        manifest = manifest or self.manifest()
        if manifest is None:
            return None
        buckets = sorted(manifest.files) if keys is None else self.touched(keys, manifest)
        return self._merged(manifest, buckets).select(manifest.columns.names)

    # Writing.

    def _put(self, rows: DataFrame, name: str) -> dict[int, str]:
        """Write rows with their BUCKET, one file for each; the folder of each bucket."""
        path = f"data/{name}-{uuid.uuid4().hex}"
        with shuffles_removed(self.spark):
            rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.folder}/{path}")
        start = f"{BUCKET}="
        return {int(n[len(start) :]): f"{path}/{n}" for n in self._names(path) if n.startswith(start)}

    def write(self, changes: DataFrame, *, base: Manifest | None = None, mark: tuple[str, int] | None = None) -> Manifest | None:
        """Add ``changes``; of rows with one key the latest counts. Columns may be added; rows with a null key are an error of the caller.

        ``base``: the version that ``changes`` were made from; if another writer has changed one of their buckets since, this
        is an error. ``mark``: a writer's name and the number of its write; a number that it has written before changes nothing.
        """
        now = self.manifest()
        if mark and now and now.marks.get(mark[0], -1) >= mark[1]:
            return now
        known = now.columns if now else T.StructType([])
        added = [f for f in changes.schema if f.name not in known.names]
        columns = T.StructType([*known, *(T.StructField(f.name, f.dataType) for f in added)])
        buckets = now.buckets if now else self.buckets
        typed = changes.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in changes.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in columns))
        version, writer = (now.version if now else 0) + 1, uuid.uuid4().hex
        rows = self._latest(typed.withColumns({VERSION: F.lit(version).cast("long"), WRITER: F.lit(writer)}), columns.names)
        delta = self._put(rows.withColumn(BUCKET, self.bucket(columns, buckets)), f"delta-{version}")
        compacted = self._compacted(now, columns, delta) if now else {}
        while True:
            latest = self.manifest()
            files, unused = dict(latest.files) if latest else {}, []
            for b, folder in delta.items():
                if base and latest and latest.files.get(b, []) != base.files.get(b, []):
                    raise RuntimeError(f"{self.folder}: bucket {b} was written by another run")
                before = files.get(b, [])
                covered = now.files.get(b, []) if now else []
                if b in compacted and before[: len(covered)] == covered:
                    files[b] = [compacted[b], *before[len(covered) :]]
                    unused.append(folder)
                else:
                    files[b] = [*before, folder]
                    unused += [compacted[b]] if b in compacted else []
            marks = dict(latest.marks) if latest else {}
            if mark:
                marks[mark[0]] = mark[1]
            wider = T.StructType([*(latest.columns if latest else []), *(f for f in columns if not latest or f.name not in latest.columns.names)])
            made = Manifest((latest.version if latest else 0) + 1, latest.buckets if latest else buckets, wider, files, marks)
            if made.buckets != buckets:
                raise RuntimeError(f"{self.folder} was made by another run with other buckets")
            if self._commit(made):
                self._clean(made.version, unused)
                return made

    def _compacted(self, now: Manifest, columns: T.StructType, delta: dict[int, str]) -> dict[int, str]:
        """New bases for the buckets of ``delta`` that have too many deltas."""
        full = [b for b in delta if len(now.files.get(b, [])) >= self.most_deltas]
        if not full:
            return {}
        both = dataclasses.replace(now, columns=columns, files={b: [*now.files[b], delta[b]] for b in full})
        return self._put(self._merged(both, full).withColumn(BUCKET, self.bucket(columns, now.buckets)), f"base-{now.version + 1}")

    def _clean(self, version: int, unused: list[str]) -> None:
        """Remove versions before the ``keep`` last ones, what only they name, and what no version came to name."""
        old = [v for v in self._versions() if v <= version - self.keep]
        gone = {f for v in old for fs in self.manifest(v).files.values() for f in fs}
        kept = {f for v in self._versions() if v > version - self.keep for fs in self.manifest(v).files.values() for f in fs}
        for name in [*(f"manifest-{v}.json" for v in old), *(gone - kept), *unused]:
            path, files = self._path(name)
            files.delete(path, True)
