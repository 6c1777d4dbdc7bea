"""Deep listing pages (M2, T2): a page reads only the files it lies in.

The table is stored in ranges of its order, one folder each, with the number of rows of
every range. A page's place follows from the sums of these numbers, so its ranges are
known before anything is read, and only their folders are scanned and sorted, however far
down the list the page is. The ranges' sizes depend on Spark's sample of the keys; the pages
don't.

Defined results: as ``changes.list_page`` (offset, then limit, in order); null keys come first;
rows with equal keys are ordered by all other columns; a page behind the end is empty; rows
with one key all lie in one range, so a page among them reads that range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_scratch, fresh_path

RANGES = 64


class PagedTable:
    def __init__(self, df: DataFrame, order_by: Sequence[str], ranges: int = RANGES):
        self.spark, self.columns = df.sparkSession, df.columns
        self.order = [*order_by, *[c for c in df.columns if c not in order_by]]
        self.path = fresh_path(self.spark, "pages-of-rows")
        (df.repartitionByRange(ranges, *order_by).withColumn("_range", F.spark_partition_id())
         .sortWithinPartitions("_range", *order_by)
         .write.partitionBy("_range").parquet(self.path))
        schema = T.StructType([*df.schema.fields, T.StructField("_range", T.IntegerType())])
        self.table = self.spark.read.schema(schema).parquet(self.path)
        counts = self.table.groupBy("_range").agg(F.count(F.lit(1)).alias("n")) \
            .orderBy("_range").collect()  # at most ``ranges`` rows
        self.starts, self.rows = [], 0
        for r in counts:
            self.starts.append((self.rows, self.rows + r["n"], r["_range"]))
            self.rows += r["n"]

    def ranges_of(self, skip: int, limit: int) -> list[tuple[int, int, int]]:
        """(first row, row after the last, range) of the ranges that the page lies in."""
        return [s for s in self.starts if s[0] < skip + limit and s[1] > skip]

    def page(self, skip: int = 0, limit: int = 100) -> DataFrame:
        held = self.ranges_of(skip, limit)
        numbers = [r for _, _, r in held]
        return (self.table.filter(F.col("_range").isin(numbers or [-1])).select(*self.columns)
                .orderBy(*self.order).offset(skip - held[0][0] if held else 0).limit(limit))

    def release(self) -> None:
        """Delete the stored table; pages can't be read afterwards."""
        drop_scratch(self.spark, self.path)
