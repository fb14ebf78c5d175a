"""Versioned tables with atomic commits (SNK-01, SRC-09, SRC-10).

A store is a shared folder:

    data/<id>/...             parquet files; written once, never changed
    versions/00000042.json    a manifest: every table's parts, schema and keys

A writer puts new files beside the old ones and then commits a manifest of the
next number, which appears whole and at most once: of two writers that build on
the same version one gets a `Conflict`.  So a reader that has pinned a version
reads the same rows to the end, a build that fails leaves the last version as
it was, and several tables change together or not at all.  What a build did not
change it names again: parts are carried over by reference, not rewritten.

A part is a folder of files with a key (a month, a load run, a range): readers
choose parts by key from the manifest, so a pruned read lists nothing else.  The
number of parts is that of months, runs or builds, not of rows.

The commit needs a file system that makes a link or a rename that fails if the
name is taken: POSIX (hard link) and HDFS-like ones (rename).  On an object store
without such a rename two commits at once could both succeed; use a table format
with its own commit service there.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEY = "part_key"


class Conflict(RuntimeError):
    """Another writer has committed the version that this one built on."""


class AlreadyThere(ValueError):
    """A part of this key is in the table already."""


@dataclass(frozen=True)
class Table:
    """A table of a manifest: its schema and its parts (key -> folders)."""
    schema: str
    parts: dict[str, list[str]] = field(default_factory=dict)

    def with_parts(self, parts: dict[str, list[str]], without: Iterable[str] = ()) -> Table:
        """These parts in place of any of their keys, and none of the keys `without`."""
        return Table(self.schema, {k: v for k, v in self.parts.items() if k not in set(without)} | parts)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- files -----------------------------------------------------------------
    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, name: str) -> list[str]:
        fs, path = self._fs(), self._path(name)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _read(self, name: str) -> str:
        stream = self._fs().open(self._path(name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> None:
        """Make a file with its whole content, or raise Conflict if it is there."""
        fs, new = self._fs(), f"versions/.{uuid.uuid4().hex}"
        out = fs.create(self._path(new), False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.getUri().getScheme() == "file":           # a rename would replace the file, a link does not
            local = unquote(urlparse(fs.makeQualified(self._path("")).toString()).path)
            try:
                os.link(f"{local}/{new}", f"{local}/{name}")
            except FileExistsError:
                raise Conflict(f"{name} is already in {self.root}") from None
            finally:
                fs.delete(self._path(new), False)
        elif not fs.rename(self._path(new), self._path(name)):
            fs.delete(self._path(new), False)
            raise Conflict(f"{name} is already in {self.root}")

    # -- versions ----------------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("versions") if n.endswith(".json") and n[0] != ".")

    def current(self) -> int:
        """The last version, 0 if there is none."""
        return max(self.versions(), default=0)

    def manifest(self, version: int) -> dict[str, Table]:
        if not version:
            return {}
        tables = json.loads(self._read(f"versions/{version:08d}.json"))["tables"]
        return {name: Table(t["schema"], t["parts"]) for name, t in tables.items()}

    def commit(self, base: int, tables: dict[str, Table]) -> int:
        """Make version base + 1, which has exactly these tables."""
        body = {"version": base + 1, "committed_at": time.time(), "tables": {n: {"schema": t.schema, "parts": t.parts} for n, t in tables.items()}}
        self._create(f"versions/{base + 1:08d}.json", json.dumps(body))
        return base + 1

    def publish(self, tables: dict[str, Table], base: int | None = None) -> int:
        """Put these tables in place of those of their names, all at once; the others
        stay.  With `base` only if nothing was committed since."""
        base = self.current() if base is None else base
        return self.commit(base, self.manifest(base) | tables)

    def append(self, name: str, part: Table, tries: int = 20) -> int:
        """Add new parts to a table.  A key that the table has, now or by the time of
        the commit, is refused; commits of other keys in between are built on."""
        for _ in range(tries):
            base = self.current()
            tables = self.manifest(base)
            old = tables.get(name, Table(part.schema))
            if taken := sorted(set(old.parts) & set(part.parts)):
                raise AlreadyThere(f"{name} has {', '.join(taken)} already")
            if old.schema != part.schema:
                raise ValueError(f"{name} has another schema")
            try:
                return self.commit(base, tables | {name: old.with_parts(part.parts)})
            except Conflict:
                continue
        raise Conflict(f"{name}: {tries} commits came in between")

    # -- tables ------------------------------------------------------------------
    def write(self, df: DataFrame, key: str | None = None, by: str | None = None, gather: bool = True, writer: Callable | None = None) -> Table:
        """Write files that no version names yet: one part under `key`, or with `by`
        one for each value of that column.  Its rows are brought together first, for
        few files (adaptive execution splits a large one), unless `gather` is false, as
        for rows that come from files grouped so.  `writer` sets options on the
        DataFrameWriter."""
        folder, schema = f"data/{uuid.uuid4().hex}", df.schema.json()
        if by is None:
            w = df.write
            (writer(w) if writer else w).parquet(f"{self.root}/{folder}")
            return Table(schema, {key or "": [folder]})
        keyed = df.withColumn(_KEY, F.coalesce(F.col(by).cast("string"), F.lit("none")))
        w = (keyed.hint("rebalance", F.col(_KEY)) if gather else keyed).write.partitionBy(_KEY)
        (writer(w) if writer else w).parquet(f"{self.root}/{folder}")
        found = [n for n in self._names(folder) if n.startswith(f"{_KEY}=")]
        return Table(schema, {unquote(n.removeprefix(f"{_KEY}=")): [f"{folder}/{n}"] for n in found})

    def frame(self, table: Table, keys: Iterable[str] | None = None) -> DataFrame:
        """The rows of a table, or of its parts with these keys."""
        schema = T.StructType.fromJson(json.loads(table.schema))
        wanted = None if keys is None else set(keys)
        paths = [f"{self.root}/{p}" for k, folders in table.parts.items() if wanted is None or k in wanted for p in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, name: str, version: int | None = None, keys: Iterable[str] | None = None) -> DataFrame:
        """A table as of a version (default: the last one now).  What it names does
        not change under the reader."""
        return self.frame(self.manifest(self.current() if version is None else version)[name], keys)

    def keys(self, name: str, version: int | None = None) -> list[str]:
        """The keys of a table's parts; none if there is no such table."""
        return list(self.manifest(self.current() if version is None else version).get(name, Table("")).parts)

    def vacuum(self, keep: int = 2, idle_hours: float = 24.0) -> int:
        """Forget all versions but the last `keep` and delete the files that only
        they name, or none does (a failed build), if untouched for `idle_hours`:
        longer than any build or read lasts.  Returns how many folders went."""
        fs, old = self._fs(), self.versions()
        held = {p.split("/")[1] for v in old[-keep:] for t in self.manifest(v).values() for ps in t.parts.values() for p in ps}
        for v in old[:-keep]:
            fs.delete(self._path(f"versions/{v:08d}.json"), False)
        before, n = (time.time() - idle_hours * 3600) * 1000, 0
        for name in self._names("data"):
            if name not in held and fs.getFileStatus(self._path(f"data/{name}")).getModificationTime() < before:
                n += bool(fs.delete(self._path(f"data/{name}"), True))
        return n
