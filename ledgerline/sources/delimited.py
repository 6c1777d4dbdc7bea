"""Delimited-text sources (S1, S5, S6): declared schemas bound by column name, and
reject tables.

Every file says in its header which columns it holds and in what order; columns are
taken by name, never by position. Quoted texts may hold doubled quotes and, with
``multi_line``, line breaks. Malformed lines land in a reject table with a
reason instead of aborting or vanishing.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import optional_column, standard_name, standardize_columns
from ..session import fresh_path

# Fixed candidate order: tab, comma, semicolon, pipe.
DELIMITERS = ("\t", ",", ";", "|")
CORRUPT = "_corrupt_record"


#: Bytes asked of a file at once, until its first line ends.
HEADER_BYTES = 4096


def first_line(spark: SparkSession, file: str) -> tuple[str | None, int]:
    """(first line, bytes read) of a file, compressed or not; None for an empty file.

    Only the file's beginning is read, however long the file is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path, HEADER_BYTES)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = codec.createInputStream(stream) if codec else stream
        text = jvm.java.io.InputStreamReader(plain, "UTF-8")
        line = jvm.java.io.BufferedReader(text, HEADER_BYTES).readLine()
        return line, stream.getPos()
    finally:
        stream.close()


def header_lines(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """header line -> its files, for a file or a folder.

    The files are listed as for any read, and their first lines looked up side by side; empty
    files have no header and are left out."""
    files = sorted(spark.read.text(path).inputFiles())
    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(max_workers=16) as pool:
        for file, (line, _) in zip(files, pool.map(lambda f: first_line(spark, f), files)):
            if line is not None:
                out.setdefault(line, []).append(file)
    return out


def _split_header(header: str, sep: str) -> list[str]:
    return [h.strip().strip('"').strip() for h in header.lstrip("﻿").split(sep)]


def detect_delimiter(header: str, candidates: Sequence[str] = DELIMITERS) -> str:
    """The candidate occurring most often in the header; ties go to the earlier one."""
    counts = [(header.count(c), -i, c) for i, c in enumerate(candidates)]
    best = max(counts)
    if best[0] == 0:
        return candidates[1]
    return best[2]


@dataclass
class DelimitedRead:
    table: DataFrame
    rejects: DataFrame
    sep: str


def _parsed(spark: SparkSession, files: Sequence[str], schema: StructType, sep: str,
            multi_line: bool) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected records) of files that share one header.

    Parsed once into the shared scratch folder, then split: the text is not parsed
    twice, and Spark allows queries on the corrupt column of a table."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    raw = (spark.read.schema(full).option("header", True).option("sep", sep)
           .option("escape", '"').option("multiLine", multi_line).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).csv(list(files)))
    path = fresh_path(spark, "delimited")
    raw.select("*", F.col("_metadata.file_path").alias("_file")).write.parquet(path)
    parsed = spark.read.parquet(path)
    bad = parsed.filter(F.col(CORRUPT).isNotNull()).select(
        F.col("_file").alias("file"), F.lit("line does not fit the columns").alias("reason"),
        F.col(CORRUPT).alias("record"))
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file"), bad


def _together(reads: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    good, bad = reads[0]
    for g, b in reads[1:]:
        good, bad = good.unionByName(g, allowMissingColumns=True), bad.unionByName(b)
    return good, bad


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
             multi_line: bool = False, required: Sequence[str] = ()) -> DelimitedRead:
    """Header CSV with a declared schema, bound by column name.

    Declared columns that a file lacks are null (P11), unless ``required``; columns
    that aren't declared are left out. Fields that don't parse as their type make the
    line a reject."""
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    reads = []
    for header, files in header_lines(spark, path).items():
        names = [h.lower() for h in _split_header(header, sep)]
        missing = [c for c in required if c.lower() not in names]
        if missing:
            raise ValueError(f"{files[0]}: no column {', '.join(missing)} in the header")
        fields = StructType([StructField(n, kinds.get(n, StringType()), True) for n in names])
        good, bad = _parsed(spark, files, fields, sep, multi_line)
        reads.append((good.select(*[
            optional_column(good, f.name.lower(), f.dataType.simpleString()).alias(f.name)
            for f in schema.fields]), bad))
    if not reads:
        nothing = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
        return DelimitedRead(spark.createDataFrame([], nothing), spark.createDataFrame(
            [], "file string, reason string, record string"), sep)
    good, bad = _together(reads)
    return DelimitedRead(good, bad, sep)


def read_delimited(spark: SparkSession, path: str, candidates: Sequence[str] = DELIMITERS,
                   multi_line: bool = False) -> DelimitedRead:
    """Per file, detect the delimiter and take the columns its own header names
    (as strings, names standardized, P3/P4), and split off malformed lines. Files
    with other delimiters or column orders in one folder are read alike; columns
    that only some files have are null in the others. ``sep`` is that of the first file."""
    reads, seps = [], []
    for header, files in header_lines(spark, path).items():
        sep = detect_delimiter(header, candidates)
        seps.append(sep)
        names = [standard_name(h) for h in _split_header(header, sep)]
        schema = StructType([StructField(n, StringType(), True) for n in names])
        good, bad = _parsed(spark, files, schema, sep, multi_line)
        reads.append((standardize_columns(good), bad))
    if not reads:
        raise ValueError(f"{path}: no file with a header line")
    good, bad = _together(reads)
    return DelimitedRead(good, bad, seps[0])


def land_csv_as_parquet(spark: SparkSession, src: str, dst: str, schema: StructType,
                        multi_line: bool = False) -> DataFrame:
    """CSV -> parquet (written to a new path), columns by trimmed header name.
    Returns the rejects."""
    read = read_csv(spark, src, schema, multi_line=multi_line)
    read.table.write.mode("errorifexists").parquet(dst)
    return read.rejects
