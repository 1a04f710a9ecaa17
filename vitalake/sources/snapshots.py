"""Versioned parquet tables: immutable partition folders under a log of manifests.

A plain parquet folder cannot replace rows in one step.  Here every write goes
to a new folder of its own; a version is one small JSON file that names, for
each partition value, the folders that hold it, and is published by a rename
that fails if the version exists.  So a reader, who keeps to the version it
opened, sees all of a commit or nothing of it; a writer that dies leaves only
folders that no version names; and of two writers that began at the same
version the second is refused.

The partition column also stays in the files, so any set of folders is one scan.
Manifests grow with the number of partitions, not of rows.  ``meta`` carries the
caller's own state (epochs, tokens, batch ids) under the same commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PART = "_part"


class CommitConflict(RuntimeError):
    """Another writer has published the version that this one was based on."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, by: str, schema: StructType):
        self.spark, self.root, self.by, self.schema = spark, root.rstrip("/"), by, schema
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._hadoop)

    # --- versions ---------------------------------------------------------------

    def versions(self) -> list[int]:
        log = self._path(f"{self.root}/log")
        if not self._fs.exists(log):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        """The newest version, 0 where nothing is committed."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "parts": {}, "meta": {}}
        stream = self._fs.open(self._path(self._log_name(version)))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _log_name(self, version: int) -> str:
        return f"{self.root}/log/{version:012d}.json"

    def _publish(self, version: int, text: str) -> None:
        """The one step that makes a version: a rename that does not replace."""
        jvm, sc = self.spark.sparkContext._jvm, self.spark.sparkContext
        draft, final = self._path(f"{self.root}/log/.draft-{uuid.uuid4().hex}"), self._path(self._log_name(version))
        out = self._fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = sc._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._hadoop)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(final), options)
        except Exception as e:
            self._fs.delete(draft, False)
            if self._fs.exists(final):
                raise CommitConflict(f"version {version} of {self.root} was committed by another writer") from e
            raise

    # --- reading ----------------------------------------------------------------

    def folders(self, version: int | None = None, parts: list | None = None) -> list[str]:
        held = self.manifest(version)["parts"]
        names = held if parts is None else [p for p in map(_name, parts) if p in held]
        return [f"{self.root}/{folder}" for name in names for folder in held[name]]

    def read(self, version: int | None = None, parts: list | None = None) -> DataFrame:
        """Rows of a version (the newest), of some partition values only where given: other folders are not listed."""
        folders = self.folders(version, parts)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    # --- writing ----------------------------------------------------------------

    def write(self, rows: DataFrame) -> dict[str, str]:
        """Store ``rows`` in a new folder that no version names yet: ``{partition: folder}``."""
        folder = f"data/{uuid.uuid4().hex}"
        value = F.coalesce(F.col(self.by).cast("string"), F.lit(""))
        rows.select(*self.schema.names).withColumn(_PART, F.hex(value)).write.partitionBy(_PART).parquet(f"{self.root}/{folder}")
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{folder}")) if s.isDirectory()]
        # an empty partition value is written under Spark's own name for it
        return {("" if n.startswith(f"{_PART}=__HIVE") else n.removeprefix(f"{_PART}=")): f"{folder}/{n}" for n in found if n.startswith(f"{_PART}=")}

    def commit(self, base: int, replaced: dict[str, list[str]], meta: dict | None = None) -> int:
        """Publish version ``base + 1``: partitions in ``replaced`` get these folders (none: the partition is gone)."""
        old = self.manifest(base)
        parts = {k: v for k, v in (old["parts"] | replaced).items() if v}
        text = json.dumps({"version": base + 1, "parts": parts, "meta": old["meta"] | (meta or {})})
        self._fs.mkdirs(self._path(f"{self.root}/log"))
        self._publish(base + 1, text)
        return base + 1

    def append(self, rows: DataFrame, meta: dict | None = None, base: int | None = None) -> int:
        base = self.version() if base is None else base
        old, new = self.manifest(base)["parts"], self.write(rows)
        return self.commit(base, {k: [*old.get(k, []), v] for k, v in new.items()}, meta)

    def replace(self, rows: DataFrame, parts: list, meta: dict | None = None, base: int | None = None) -> int:
        """Replace the partitions ``parts`` by ``rows`` (which lie in them); other partitions keep their files."""
        base = self.version() if base is None else base
        new = self.write(rows)
        strange = new.keys() - set(map(_name, parts))
        if strange:
            raise ValueError(f"rows outside the replaced partitions: {sorted(strange)[:5]}")
        return self.commit(base, {n: [new[n]] if n in new else [] for n in map(_name, parts)}, meta)

    def delete(self, folder: str) -> None:
        """Remove a writer's own intermediate folder (outside ``data`` and ``log``), if it is there."""
        self._fs.delete(self._path(folder), True)

    def vacuum(self, keep: int = 2) -> int:
        """Forget all but the newest ``keep`` versions, delete the folders that no kept version
        names, and return their number.  Not to be run beside a writer: its folders have no version yet."""
        versions = self.versions()
        for v in versions[:-keep]:
            self._fs.delete(self._path(self._log_name(v)), False)
        used = {folder for v in versions[-keep:] for fs in self.manifest(v)["parts"].values() for folder in fs}
        gone = 0
        data = self._path(f"{self.root}/data")
        for top in self._fs.listStatus(data) if self._fs.exists(data) else []:
            inner = [s for s in self._fs.listStatus(top.getPath()) if s.isDirectory()]
            dead = [s for s in inner if f"data/{top.getPath().getName()}/{s.getPath().getName()}" not in used]
            for s in dead:
                self._fs.delete(s.getPath(), True)
            gone += len(dead)
            if len(dead) == len(inner):
                self._fs.delete(top.getPath(), True)
        return gone


def _name(value) -> str:
    """The partition of a value: the hex of its text, so that any text is a folder name."""
    return "" if value is None else str(value).encode().hex().upper()


def replace_where(table: SnapshotTable, predicate, new_rows: DataFrame, base: int | None = None) -> int:
    """Delete the rows that match ``predicate`` and append ``new_rows``, as one version.

    Only partitions that hold a matching or a new row are rewritten; they are
    read from the version the writer began at.  Returns the number of rows removed."""
    base = table.version() if base is None else base
    current = table.read(base)
    matches = F.coalesce(predicate, F.lit(False))
    hit = {r[0]: r[1] for r in current.filter(matches).groupBy(table.by).count().collect()}  # a row a partition value
    touched = list(hit.keys() | {r[0] for r in new_rows.select(table.by).distinct().collect()})
    if touched:
        kept = table.read(base, touched).filter(~matches)
        table.replace(kept.unionByName(new_rows.select(*table.schema.names)), touched, base=base)
    return sum(hit.values())
