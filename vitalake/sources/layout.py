"""Clustered files and compaction for a versioned table.

Rows are ordered along a space-filling curve over (user, time): each column is
cut into ranges at sampled quantiles, the bits of both range numbers are
interleaved, and files hold runs of that value.  The least and greatest user and
time in a file's statistics then span a small rectangle, so a scan for some users
and some days skips most files.  Any marks give the same rows; the sample decides
only how even the files are.

``compact`` plans from file sizes: partitions in many small files (appends leave
one or more each) are rewritten into files of about ``target_bytes``, clustered, as
one new version; readers of the old version are not disturbed.  Stored rows can be
tens of times smaller than rows in memory, so a file's worth is not sorted by one
task: the sort runs in slices of ``SLICE_BYTES``, and files are put together from
sorted slices without sorting again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .landing import _range_marks
from .snapshots import SnapshotTable

#: bits of a column's range number: 64 ranges each
BITS = 6
TARGET_BYTES = 128 << 20
CURVE = ("user_id", "ingested_at")
#: stored bytes that one task sorts
SLICE_BYTES = 4 << 20


def _range_number(rows: DataFrame, column: str, bits: int) -> Column:
    marks = _range_marks(rows.select(column), 1 << bits)
    return F.coalesce(sum(((F.col(column) >= F.lit(m)).cast("int") for m in marks), F.lit(0)), F.lit(0))  # NULL is in the first range


def curve_value(rows: DataFrame, columns: tuple[str, str] = CURVE, bits: int = BITS) -> Column:
    """The interleaved bits of both columns' range numbers, the first column's bit above the second's."""
    a, b = (_range_number(rows, c, bits) for c in columns)
    out = F.lit(0)
    for k in range(bits):
        out = out + F.shiftleft(F.shiftright(a, k).bitwiseAND(F.lit(1)), 2 * k + 1) + F.shiftleft(F.shiftright(b, k).bitwiseAND(F.lit(1)), 2 * k)
    return out


def clustered(rows: DataFrame, files: int, columns: tuple[str, str] = CURVE, bits: int = BITS) -> DataFrame:
    """``rows`` dealt to ``files`` tasks by the curve and sorted along it."""
    z = rows.withColumn("_z", curve_value(rows, columns, bits))
    return z.repartitionByRange(max(1, files), "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z")


def file_sizes(table: SnapshotTable, version: int | None = None) -> dict[str, list[int]]:
    """Bytes of each data file by partition, from the file listing."""
    out = {}
    for part, folders in table.manifest(version)["parts"].items():
        listed = (s for folder in folders for s in table._fs.listStatus(table._path(f"{table.root}/{folder}")))
        out[part] = [s.getLen() for s in listed if s.getPath().getName().endswith(".parquet")]
    return out


def plan_compaction(sizes: dict[str, list[int]], target_bytes: int = TARGET_BYTES) -> dict[str, int]:
    """Partitions worth rewriting and the files they should have: those with at least twice as many as they need."""
    need = {part: max(1, -(-sum(files) // target_bytes)) for part, files in sizes.items()}
    return {part: n for part, n in need.items() if len(sizes[part]) >= 2 * n}


def _write_clustered(table: SnapshotTable, part: str, rows: DataFrame, files: int, slices_each: int, columns: tuple[str, str]) -> str:
    """Store the rows of one partition as ``files`` clustered files; their folder, which no version names yet."""
    staged, folder = f"{table.root}/staged/{uuid.uuid4().hex}", f"data/{uuid.uuid4().hex}/_part={part}"
    clustered(rows.select(*table.schema.names), files * slices_each, columns).write.parquet(staged)
    try:
        slices = sorted((s.getPath().toString(), s.getLen()) for s in table._fs.listStatus(table._path(staged)) if s.getPath().getName().endswith(".parquet"))
        total, before, groups = sum(n for _, n in slices), 0, {}
        for path, n in slices:  # the names follow the curve
            groups.setdefault(before * files // max(total, 1), []).append(path)
            before += n
        out = None
        for paths in groups.values():
            one = table.spark.read.schema(table.schema).parquet(*paths).coalesce(1)
            out = one if out is None else out.union(one)
        out.write.parquet(f"{table.root}/{folder}")
    finally:
        table._fs.delete(table._path(staged), True)
    return folder


def compact(table: SnapshotTable, target_bytes: int = TARGET_BYTES, columns: tuple[str, str] = CURVE) -> dict[str, int]:
    """Rewrite the partitions that ``plan_compaction`` names, one after another (each is a version of its own, so a
    run that dies keeps what it has done); the files each has now."""
    sizes = file_sizes(table)
    done = plan_compaction(sizes, target_bytes)
    for part, files in done.items():
        base = table.version()
        folders = [f"{table.root}/{f}" for f in table.manifest(base)["parts"][part]]
        rows = table.spark.read.schema(table.schema).parquet(*folders)
        slices = -(-sum(sizes[part]) // (files * SLICE_BYTES))
        written = [_write_clustered(table, part, rows, files, slices, columns)] if slices > 1 else list(table.write(clustered(rows, files, columns)).values())
        table.commit(base, {part: written})
    return done
