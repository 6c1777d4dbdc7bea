"""Document files as a table (S11, S13): one row per file, key from the file name.

Files are read by Spark's ``binaryFile`` source, so listing and reading are
spread over the cluster. Text is decoded and cleaned JVM-side; formats that
need a per-file parser (PDF) are outside the installed libraries.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.text import html_text

# The file name, without its extension if it has one.
KEY_FROM_PATH = r"([^/]+?)(?:\.[^./]+)?$"


def read_documents(spark: SparkSession, folder: str, glob: str = "*",
                   key: str = "doc_key", ordered: bool = False,
                   key_from: str = KEY_FROM_PATH) -> DataFrame:
    """(key, path, content) per file; key = file name without its extension (``key_from``: the
    pattern whose first group is the key in a path).

    Empty files hold no document and give no row.

    ``ordered`` sorts by key (T6), for outputs that need the sorted listing;
    reading and joining need no order."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", True).load(folder))
    out = files.select(F.regexp_extract("path", key_from, 1).alias(key), "path", "content")
    return out.orderBy(key) if ordered else out


def decoded(content: Column | str) -> Column:
    """Struct (text, bad_at) of bytes: the UTF-8 text before the first byte that doesn't decode,
    and that byte's place (null: all of it decodes)."""
    raw = (F.col(content) if isinstance(content, str) else content).cast("string")
    mended = F.make_valid_utf8(raw)  # U+FFFD in place of what doesn't decode
    mark = F.lit("\ufffd")
    # A text may hold U+FFFD itself: the first one that isn't in the bytes is the damage.
    own = ((F.octet_length(raw) - F.octet_length(F.replace(raw, mark, F.lit("")))) / 3).cast("int")
    before = lambda i: F.substring_index(mended, "\ufffd", i) if isinstance(i, int) \
        else F.call_function("substring_index", mended, mark, i)
    damaged = F.element_at(F.filter(F.sequence(F.lit(1), own + 1), lambda i: ~F.startswith(
        raw, F.concat(before(i), mark))), 1)
    text = F.when(F.is_valid_utf8(raw), raw).when(own == 0, before(1)).otherwise(before(damaged))
    return F.struct(F.coalesce(text, F.lit("")).alias("text"),
                    F.when(~F.is_valid_utf8(raw), F.octet_length(text)).alias("bad_at"))


def page_lines(text: Column, html: bool = True) -> Column:
    """Pages (between form feeds) as lines; pages without text are skipped."""
    clean = html_text if html else lambda page: F.trim(F.regexp_replace(page, r"^\s+|\s+$", ""))
    pages = F.transform(F.split(text, "\f"), clean)
    return F.array_join(F.filter(pages, lambda page: page != ""), "\n")


def document_texts(docs: DataFrame, key: str = "doc_key", out: str = "extracted_text",
                   html: bool = True) -> DataFrame:
    """(key, text): UTF-8 content up to its first damage, page by page, HTML stripped when
    ``html``. A damaged file doesn't disturb the others; see ``document_warnings``."""
    text = page_lines(decoded("content")["text"], html)
    return docs.select(key, F.coalesce(text, F.lit("")).alias(out))


def document_warnings(docs: DataFrame, key: str = "doc_key") -> DataFrame:
    """(key, path, reason, at): a row per file whose text is not whole."""
    found = docs.select(key, "path", decoded("content")["bad_at"].alias("at"),
                        F.col("content").isNull().alias("unread"))
    reason = F.when(F.col("unread"), "the file can't be read").otherwise(
        F.concat(F.lit("not UTF-8 from byte "), F.col("at").cast("string"),
                 F.lit(" on: the text before it is kept")))
    return found.filter("unread OR at IS NOT NULL").select(key, "path", reason.alias("reason"), "at")


def write_texts(texts: DataFrame, path: str) -> None:
    """S13 re-aimed: one parquet table of (key, text), not one file per document."""
    texts.write.mode("errorifexists").parquet(path)


def write_files(rows: DataFrame, folder: str, key: str, text: str) -> None:
    """A text file per key below the new, shared ``folder``, a line per row; ``<key>=<its value>``
    is part of the path.

    Keys are dealt over all cores, as a file takes its time whatever it holds. In a file system
    that the tasks see as folders they write the files themselves: Hadoop starts two processes per
    file there, to set its rights and those of its checksum. Elsewhere Spark writes a folder per key."""
    spark = rows.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    dealt = rows.select(key, text).repartition(parts, key)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    scheme = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme != "file":
        write_folders(dealt, folder, key)
        return
    place = path.toUri().getPath()

    def run(part: Iterator[Row]) -> None:
        own = f"{place}/part-{TaskContext.get().partitionId():05d}"
        os.makedirs(own, exist_ok=True)
        # A second attempt at the task writes the same files; each appears when it is whole.
        draft = f"{own}/_{TaskContext.get().taskAttemptId()}"
        last, out = None, None
        for value, line in part:
            name = f"{own}/{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}.txt"
            if name != last:
                if out is not None:
                    out.close()
                    os.replace(draft, last)
                last, out = name, open(draft, "wb")
            out.write(line + b"\n")
        if out is not None:
            out.close()
            os.replace(draft, last)

    dealt.select(key, F.col(text).cast("binary")).sortWithinPartitions(key).foreachPartition(run)


def write_folders(rows: DataFrame, folder: str, key: str) -> None:
    """As ``write_files``, by Spark's writer: any file system it can write, a folder per key.

    With the committer's version 2 tasks move their own files in place, not the driver all."""
    rows.write.partitionBy(key).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
