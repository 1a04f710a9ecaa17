"""Shared helpers: scratch tables in the cluster's shared folder, Arrow maps
over bounded slices, and the fold rule of the learning operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import checkpoint_dir

#: code points of text one slice of an Arrow batch may hold; bounds the working set of the numpy steps
SLICE_CHARS = 1_500_000
#: labels of fold 0 (crc32 of the id, modulo FOLDS) are never read
FOLDS = 5


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps read the
    stored rows, so a lost executor costs no upstream work."""
    return stage_path(df, name)[0]


def stage_path(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stage``, with the path, for tables that are deleted once a later one is stored."""
    path = scratch(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path), path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that a later one has replaced."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def lookup(left: DataFrame, keys: list[str], right: DataFrame, spread: str) -> DataFrame:
    """Inner join with a table of unique ``keys``; rows of ``left`` that share a
    key are spread by the column ``spread``, each part with one copy of the right row."""
    parts = max(16, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(parts)))
    wanted = salted.select(*keys, "__salt").distinct().join(right, keys)
    return salted.join(wanted, [*keys, "__salt"]).drop("__salt")


def struct(ddl: str | StructType) -> StructType:
    return ddl if isinstance(ddl, StructType) else _parse_datatype_string(ddl)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each
    (a single longer text is a run of its own)."""
    col = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def arrow_map(df: DataFrame, step: Callable[[pa.RecordBatch], dict[str, object]], schema: str | StructType,
              text: str | None = "text") -> DataFrame:
    """``mapInArrow`` by a function from a bounded slice of rows to columns."""
    out = struct(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text) if text else [whole]:
                if batch.num_rows:
                    cols = step(batch)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[f.name], f.type) if not isinstance(cols[f.name], (pa.Array, pa.ChunkedArray))
                         else cols[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` stored with a row number ``__row``, so that decisions made on a
    few columns can be joined back to whole rows."""
    return stage(docs.withColumn("__row", F.monotonically_increasing_id()), name)


def sampled(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """About ``most`` rows at random by a hash of ``key``; all rows if there are fewer."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(most / n * (1 << 30)))


def labelled(docs: DataFrame, labels: DataFrame, name: str, rows: int, parts: int = FOLDS) -> DataFrame:
    """``(doc_id, text, label, fold)``: a bounded sample of labelled documents
    outside fold 0; the sample of labels is small enough to broadcast by its bound.
    Where rows repeat a labelled id, the rows found are sampled again to the same bound."""
    y = (labels.where(F.col(name).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(name).alias("label"))
         .withColumn("fold", fold(F.col("doc_id"), parts)).where("fold <> 0"))
    y = sampled(y, F.col("doc_id"), rows)
    found = docs.select("doc_id", "text").join(F.broadcast(y), "doc_id")
    return sampled(found, F.monotonically_increasing_id(), rows + rows // 10)
