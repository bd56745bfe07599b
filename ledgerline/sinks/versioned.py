"""Parquet tables whose writes become visible all at once.

A write goes to a folder of its own, a *generation*; nothing that a reader sees is touched.  Then one small manifest
file is renamed to the next version number: that is the commit.  It lists, for each partition, the generations that
hold its rows.  Readers take the latest manifest, so they see a whole write or none of it, and a DataFrame keeps
reading the version it was made from.  A job that dies before the rename leaves only a folder that no manifest
names, which ``vacuum`` removes.

::

    path/data/__gen=<id>/<partition>=<value>/part-*.parquet
    path/manifest/v0000000007.json

Spark writes and reads all rows; the driver handles the list of partitions alone.  The manifest also carries a
small ``state`` of the table's owner (a cursor, the version of a source that was read), committed with the rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from typing import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.incremental import assert_same_schema
from ledgerline.sinks.files import _fs, partition_folder, path_exists

GEN = "__gen"


class ConcurrentCommit(RuntimeError):
    """Another writer committed first; its rows are visible, this write's are not."""


@dataclass(frozen=True)
class Slice:
    """The rows of one partition (folder, '' for a table without) in one generation, and the version that added it.

    A ``merged`` slice holds the rows of smaller ones that compaction put together; its version is the latest of theirs.
    """
    folder: str
    gen: str
    version: int
    merged: bool = False


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: T.StructType
    slices: tuple[Slice, ...] = ()
    state: Mapping = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {s.folder for s in self.slices}

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema.jsonValue(), "state": dict(self.state),
                           "slices": [[s.folder, s.gen, s.version, s.merged] for s in self.slices]})

    @classmethod
    def from_json(cls, text: str) -> "Manifest":
        d = json.loads(text)
        return cls(d["version"], T.StructType.fromJson(d["schema"]), tuple(Slice(*s) for s in d["slices"]), d["state"])


class VersionedTable:
    """A versioned Parquet table at ``path``, partitioned by one column or by none."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str | None = None):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col

    # --- reading ----------------------------------------------------------------------------

    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.path}/manifest")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The latest manifest or that of a version; None where there is none (no table, or vacuumed)."""
        if version is None:
            have = self.versions()
            if not have:
                return None
            version = have[-1]
        fs, p = _fs(self.spark, self._manifest_path(version))
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return Manifest.from_json(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self.versions())

    def state(self) -> dict:
        m = self.manifest()
        return dict(m.state) if m else {}

    def read(self, values: Iterable | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version (the latest by default); ``values`` keeps the partitions with these values, and
        only their folders are listed."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no version {'' if version is None else version} of a table at {self.path}")
        slices = m.slices
        if values is not None:
            wanted = {partition_folder(self.partition_col, v) for v in values}
            slices = [s for s in slices if s.folder in wanted]
        return self.rows_of(slices, m.schema)

    def rows_of(self, slices: Iterable[Slice], schema: T.StructType) -> DataFrame:
        paths = [self._slice_path(s) for s in slices]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)
                .select(*[F.col(f"`{n}`") for n in schema.fieldNames()]))

    def added_since(self, version: int, folder: str | None = None) -> DataFrame | None:
        """Rows added after ``version``, where nothing that it held has gone since; otherwise None.  ``folder`` looks
        at one partition only.

        Slices that compaction merged have not gone, if it merged none that is newer than ``version``.  (A write that drops
        rows drops all slices of a partition, so a merged slice that old is made of slices that were there.)
        """
        now, then = self.manifest(), self.manifest(version)
        if now is None or then is None:
            return None
        keep = lambda m: {s for s in m.slices if folder is None or s.folder == folder}
        merged = {s for s in keep(now) if s.merged and s.version <= version}
        if {s.folder for s in keep(then) - keep(now)} - {s.folder for s in merged}:
            return None
        return self.rows_of(sorted(keep(now) - keep(then) - merged, key=lambda s: (s.version, s.folder)), now.schema)

    def changed_since(self, version: int) -> set[str] | None:
        """Folders of partitions that differ from those of ``version``; None if that is gone."""
        now, then = self.manifest(), self.manifest(version)
        if now is None or then is None:
            return None
        return {s.folder for s in set(now.slices) ^ set(then.slices)}

    # --- writing ----------------------------------------------------------------------------

    def append(self, df: DataFrame, **options) -> Manifest:
        """Add rows.  ``options``: ``observe`` (name -> aggregate, measured while writing), ``state`` (values to set in the
        table's state, or a function of what was observed and of the written rows that gives them, or None to give the
        write up), ``drop`` (columns that are observed but not written), ``before_commit`` (called between write and commit),
        ``rebalance`` (False: rows are not dealt out by partition first, for a few partitions with many rows each)."""
        return self._write(df, lambda old, folders: old, **options)

    def replace(self, df: DataFrame, **options) -> Manifest:
        """Take these rows in place of all others."""
        return self._write(df, lambda old, folders: [], new_schema=True, **options)

    def replace_partitions(self, df: DataFrame, values: Iterable = (), **options) -> Manifest:
        """Take these rows in place of those of the partitions with ``values`` and of all partitions they fall in."""
        gone = {partition_folder(self.partition_col, v) for v in values}
        return self._write(df, lambda old, folders: [s for s in old if s.folder not in gone | folders], **options)

    def replace_folders(self, df: DataFrame, values: Iterable, **options) -> Manifest:
        """Take these rows in place of those of the partitions with ``values``; rows of other partitions are added."""
        gone = {partition_folder(self.partition_col, v) for v in values}
        return self._write(df, lambda old, folders: [s for s in old if s.folder not in gone], **options)

    def set_state(self, state: Mapping) -> Manifest:
        base = self.manifest()
        return self._commit(replace(base, version=base.version + 1, state={**base.state, **state}))

    def compact(self, most_slices: int = 32, small_bytes: int = 1 << 30) -> Manifest | None:
        """Where a partition has more than ``most_slices`` slices smaller than ``small_bytes``, write those as one.

        Large slices stay as they are, so a table that only grows is not written again and again.
        """
        m = self.manifest()
        by_folder: dict[str, list[Slice]] = {}
        for s in m.slices:
            by_folder.setdefault(s.folder, []).append(s)
        small: set[Slice] = set()
        for slices in by_folder.values():
            if len(slices) > most_slices:
                found = [s for s in slices if self._bytes(s) < small_bytes]
                small.update(found if len(found) > most_slices else [])
        if not small:
            return None
        latest = {s.folder: max(x.version for x in small if x.folder == s.folder) for s in small}
        return self._write(self.rows_of(small, m.schema), lambda old, folders: [s for s in old if s not in small], base=m,
                           as_slice=lambda folder, gen: Slice(folder, gen, latest[folder], True))

    def _bytes(self, s: Slice) -> int:
        fs, p = _fs(self.spark, self._slice_path(s))
        return fs.getContentSummary(p).getLength()

    def vacuum(self, keep: int = 2, orphans: bool = False) -> list[str]:
        """Delete the manifests but the last ``keep``, and the generations that only deleted ones name; returns these.
        ``orphans`` also deletes generations that no manifest ever named: only where no writer is at work."""
        versions = self.versions()
        dropped, kept = versions[:-keep] if keep else versions, versions[-keep:] if keep else []
        live = {s.gen for v in kept for s in self.manifest(v).slices}
        dead = {s.gen for v in dropped for s in self.manifest(v).slices} - live
        fs, data = _fs(self.spark, f"{self.path}/data")
        if orphans and fs.exists(data):
            dead |= {s.getPath().getName()[len(GEN) + 1:] for s in fs.listStatus(data)} - live
        for v in dropped:  # first what names the files, then the files
            fs.delete(_fs(self.spark, self._manifest_path(v))[1], False)
        for gen in sorted(dead):
            fs.delete(_fs(self.spark, f"{self.path}/data/{GEN}={gen}")[1], True)
        return sorted(dead)

    def _write(self, df: DataFrame, left: Callable[[list[Slice], set[str]], list[Slice]], *, state=None,
               observe: Mapping | None = None, before_commit: Callable[[], None] | None = None,
               drop: Iterable[str] = (), new_schema: bool = False, base: Manifest | None = None, rebalance: bool = True,
               as_slice: Callable[[str, str], Slice] | None = None) -> Manifest:
        base = base or self.manifest()
        gen = f"g{uuid.uuid4().hex}"  # a letter first, so that no reader takes it for a number
        at = f"{self.path}/data/{GEN}={gen}"
        seen = Observation(f"write-{gen}")
        out = (df.observe(seen, *[c.alias(n) for n, c in observe.items()]) if observe else df).drop(*drop)
        if base is not None and not new_schema:
            assert_same_schema(out, base.schema)
            out = out.select(*[F.col(f"`{n}`") for n in base.schema.fieldNames()])
        if self.partition_col:
            # About one file for a partition; a heavy one is split by AQE.
            dealt = out.hint("rebalance", self.partition_col) if rebalance else out
            dealt.write.partitionBy(self.partition_col).parquet(at)
        else:
            out.write.parquet(at)
        fs, p = _fs(self.spark, at)
        found = [s.getPath().getName() for s in fs.listStatus(p)]
        if self.partition_col:
            folders = {n for n in found if n.startswith(f"{partition_folder(self.partition_col, 0)[:-1]}")}
        else:
            folders = {""} if any(n.startswith("part-") for n in found) else set()
        version = base.version + 1 if base else 1
        schema = base.schema if base is not None and not new_schema else _nullable(out.schema)
        added = [as_slice(f, gen) if as_slice else Slice(f, gen, version) for f in sorted(folders)]
        if callable(state):
            state = state(seen.get if observe else {}, self.rows_of(added, schema))
            if state is None:
                fs.delete(p, True)
                return base
        if before_commit:
            before_commit()
        kept = left(list(base.slices) if base else [], folders)
        return self._commit(Manifest(version, schema, (*kept, *added), {**(base.state if base else {}), **(state or {})}))

    def _commit(self, m: Manifest) -> Manifest:
        """Write the manifest aside and rename it, which fails if that version is there already."""
        jvm = self.spark._jvm
        tmp = f"{self.path}/manifest/.{uuid.uuid4().hex}"
        fs, p = _fs(self.spark, tmp)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(m.to_json().encode()))
        finally:
            stream.close()
        target = _fs(self.spark, self._manifest_path(m.version))[1]
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            p.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(p), fs.makeQualified(target), none)
        except Exception as e:  # py4j wraps whatever the file system throws
            fs.delete(p, False)
            if path_exists(self.spark, self._manifest_path(m.version)):
                raise ConcurrentCommit(f"version {m.version} of {self.path} is there already") from e
            raise
        return m

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifest/v{version:010d}.json"

    def _slice_path(self, s: Slice) -> str:
        return f"{self.path}/data/{GEN}={s.gen}" + (f"/{s.folder}" if s.folder else "")


def _nullable(schema: T.StructType) -> T.StructType:
    """As Parquet is read back: every column may be null."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
