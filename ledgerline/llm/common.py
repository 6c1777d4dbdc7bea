"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.session import fresh_path
from ledgerline.sources.tables import TableSet

#: ASCII white space of the contracts: space and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return TableSet(spark, sf_dir)[name]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Inside a lambda, a plain column expression would be evaluated again for
    every element; a lambda variable is bound once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def text_hash(text: Column) -> Column:
    """Tells rows apart that share an id; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written (with the writer's ``options``) to the shared folder and read again.

    Cuts the lineage: if an executor is lost later, only tasks over the written
    files run again. ``discard`` removes the files once nothing reads them any more.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` has made."""
    for table_ in tables:
        drop_path(table_.sparkSession, table_.scratch_path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps that are over.

    It does so when the driver collects its garbage, which a driver with little to do
    puts off; between the steps of a long job their files would pile up on the
    executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table through Spark's own file system layer."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def row_slices(batch: pa.RecordBatch, column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``max_bytes`` of text each, so that
    numpy work arrays stay small; one longer text makes a slice of its own."""
    if not batch.num_rows:
        return
    arr = batch.column(column)
    if pa.types.is_null(arr.type):
        yield batch
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(arr), 0), dtype=np.int64)
    block = np.cumsum(sizes) // max_bytes
    cuts = np.flatnonzero(np.diff(block)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(lo, hi - lo)


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(uint8 buffer, int64 offsets of n+1 rows) of a string column; null: empty."""
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    arr = pa.concat_arrays([arr])
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    return buf[lo:hi], offsets - lo
