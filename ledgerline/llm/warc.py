"""WARC archives: writer with revisit records, and a salvage reader.

Writing is a plain Spark write: each page becomes one record, gzipped as a member
of its own, so that damage to one record leaves the others readable. An archive
ends before the record that would take it over ``archive_bytes``, so it is longer
only if one record alone is, and a reader task holds a few archives at most. Reading
goes through ``binaryFile`` and works on any store Spark reads, with archives plain
or gzipped, one member a record or one a file.
In a member that holds many records, nothing behind its damage can be unpacked.

The salvage reader checks every record: version line, header block, declared
length, closing blank lines and block digest. After a failed check it searches
for the next version line (or, in a damaged gzip file, the next member), goes on
with the next record that passes, and logs the bytes between as a gap.

Defined results: null html is an empty payload; a null url becomes an empty
target; a null page id an empty record id, read back as null; rows repeated with
one page id and payload are all written, and all of them as responses if they
hold the largest id; line breaks in urls are percent-encoded; no pages make no
records.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.llm.common import written
from ledgerline.session import fresh_path

CRLF = "\r\n"
END = CRLF + CRLF
DATE = "2025-01-01T00:00:00Z"
#: Fixed value: the profile of revisits with the payload of another record.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Payloads below this size are always stored in full.
MIN_REVISIT_BYTES = 1000
#: An archive's bytes (before compression by file, if any).
ARCHIVE_BYTES = 32 << 20

RECORD_SCHEMA = ("kind string, file string, offset long, length long, reason string, "
                 "record_type string, record_id string, target_uri string, refers_to string, "
                 "payload_bytes long, payload_digest string, payload binary")


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html", min_revisit: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Each page with its digest, size and, for a revisit, the page it refers to.

    Payloads are grouped by digest and size without carrying them along; only
    groups of two and more come back to the pages.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    base = (base.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("digest", F.sha1(F.col("payload").cast("binary"))))
    groups = written(
        base.filter(F.col("payload_bytes") >= min_revisit)
        .groupBy("digest", "payload_bytes")
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1").drop("copies"), "warc-groups")
    joined = base.join(groups, ["digest", "payload_bytes"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.withColumn("refers_to", F.when(revisit, F.col("first_id"))).drop("first_id")


def record_text(date: str = DATE) -> Column:
    """One record of ``plan_records`` as text, without its closing blank lines."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
                          "Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    is_revisit = F.col("refers_to").isNotNull()
    block = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    size = F.octet_length(http) + F.when(is_revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")),
                       F.lit("\n"), F.lit("%0A"))
    header = [
        F.lit(f"WARC/1.0{CRLF}WARC-Type: "),
        F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{CRLF}WARC-Record-ID: "), _urn(F.col("page_id")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), target,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit(f"{CRLF}WARC-Block-Digest: sha1:"), F.sha1(block.cast("binary")),
        F.when(is_revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "),
                                    _urn(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        size.cast("string"), F.lit(END)]
    return F.concat(*header, block)


def _member(record: bytes) -> bytes:
    """A gzip member of one record; its last byte is zero.

    A member ends with its text's length, whose last byte is zero below 16 MB;
    behind a longer one an empty member follows.
    """
    out = zlib.compress(record, wbits=31)
    return out if out.endswith(b"\0") else out + zlib.compress(b"", wbits=31)


def _archives(by_record: bool, size: int, records: int | None):
    """Rows of records to rows of archives, without the bytes that the writer adds to each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            for record in batch.column(0):
                data = record.as_buffer().to_pybytes() + END.encode()
                data = _member(data) if by_record else data
                if held and (total + len(data) > size or len(held) == records):
                    yield pack(held)
                    held, total = [], 0
                held.append(data)
                total += len(data)
        if held:
            yield pack(held)

    def pack(held: list[bytes]) -> pa.RecordBatch:
        whole = b"".join(held)[:-1 if by_record else -len(END)]
        return pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], names=["value"])

    return run


def write_archives(pages: DataFrame, path: str, compression: str = "gzip",
                   archive_bytes: int = ARCHIVE_BYTES, records_per_file: int | None = None,
                   **cols) -> None:
    """Archives of the pages; ``gzip`` packs record by record, other codecs by file."""
    by_record = compression == "gzip"
    records = plan_records(pages, **cols).select(record_text().alias("value"))
    archives = records.mapInArrow(_archives(by_record, archive_bytes, records_per_file),
                                  "value binary")
    # The text writer passes bytes on as they are, one archive a file; what it adds ends
    # the last record: its blank lines, or the zero that is its member's last byte.
    (archives.select(F.col("value").cast("string")).write
     .option("lineSep", "\0" if by_record else END)
     .option("compression", "none" if by_record else compression)
     .option("maxRecordsPerFile", 1).text(path))


# --- reading -----------------------------------------------------------------

def _version_line(data: bytes, start: int) -> int:
    """Where the next version line begins at or after ``start``; the end if none."""
    at = data.find(b"WARC/", start)
    while at > 0 and data[at - 1] != 10:
        at = data.find(b"WARC/", at + 1)
    return len(data) if at < 0 else at


def _record(data: bytes, at: int) -> tuple[dict, int] | str:
    """(fields, end) of the record at ``at``, or why it fails its checks."""
    if not data.startswith(b"WARC/", at):
        return "no version line"
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        return "header does not end"
    lines = data[at:stop].split(b"\r\n")
    if lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        return "unknown version"
    head: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "malformed header line"
        head[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    size = head.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        return "no content length"
    end = stop + 4 + int(size)
    if end > len(data):
        return "shorter than declared"
    if data[end:end + 4] != b"\r\n\r\n":
        return "record does not end where declared"
    block = data[stop + 4:end]
    digest = head.get("warc-block-digest", "")
    if digest and digest != "sha1:" + hashlib.sha1(block).hexdigest():
        return "block digest differs"
    return {"head": head, "block": block}, end + 4


def _fields(found: dict) -> dict | str:
    """Output fields of a checked record; a response's payload is checked too."""
    head, block = found["head"], found["block"]
    kind = head.get("warc-type", "")
    http, _, payload = block.partition(b"\r\n\r\n")
    if not http.startswith(b"HTTP/"):
        http, payload = b"", block
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    size = len(payload)
    if kind == "revisit":
        for line in http.split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            if name.lower() == b"content-length":
                size = int(value)
    elif digest and digest != hashlib.sha1(payload).hexdigest():
        return "payload digest differs"
    return {"record_type": kind, "record_id": head.get("warc-record-id"),
            "target_uri": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"),
            "payload_bytes": size, "payload_digest": digest, "payload": payload}


def salvage_plain(data: bytes) -> Iterator[dict]:
    """Records and gaps of uncompressed bytes; together they cover every byte."""
    at = good = 0  # good: where the bytes without a valid record begin
    why = ""
    while at < len(data):
        found = _record(data, at)
        fields = found if isinstance(found, str) else _fields(found[0])
        if isinstance(fields, str):
            why = why or fields
            at = _version_line(data, at + 1)
            continue
        if good < at:
            yield {"kind": "gap", "offset": good, "length": at - good, "reason": why}
        yield {"kind": "record", "offset": at, "length": found[1] - at, **fields}
        at = good = found[1]
        why = ""
    if good < len(data):
        yield {"kind": "gap", "offset": good, "length": len(data) - good, "reason": why}


def _unpack(data: bytes, at: int) -> tuple[bytes, str, int]:
    """(text, why it ends early, end) of the member at ``at``.

    Unpacking stops at damage; all that comes out ahead of it is kept.
    """
    unpack, text, fed = zlib.decompressobj(31), [], at
    try:
        while fed < len(data) and not unpack.eof:
            text.append(unpack.decompress(data[fed:fed + 4096]))
            fed = min(fed + 4096, len(data))
    except zlib.error as e:
        # The failing step gave nothing: once more, byte by byte.
        again = zlib.decompressobj(31)
        text = [again.decompress(data[at:fed])]
        try:
            while True:
                text.append(again.decompress(data[fed:fed + 1]))
                fed += 1
        except zlib.error:
            return b"".join(text), f"member is damaged: {e}"[:80], fed
    return (b"".join(text), "" if unpack.eof else "member is cut off",
            fed - len(unpack.unused_data))


def _salvage_members(data: bytes, first: int) -> Iterator[dict]:
    """Records and gaps of gzip members, the first at ``first`` or later."""
    at, good, why = first, 0, "no member"
    while 0 <= at < len(data):
        text, ended, after = _unpack(data, at)
        rows = list(salvage_plain(text))
        if ended and not any(r["kind"] == "record" for r in rows):
            why, at = ended, data.find(b"\x1f\x8b\x08", at + 1)
            continue
        if good < at:
            yield {"kind": "gap", "offset": good, "length": at - good, "reason": why}
        for r in rows:
            yield r | {"member": at}
        if ended:
            after = data.find(b"\x1f\x8b\x08", at + 1)
            after = len(data) if after < 0 else after
            yield {"kind": "gap", "offset": at, "length": after - at, "reason": ended}
        good, why = after, "bytes after a member"
        at = after if data.startswith(b"\x1f\x8b", after) else data.find(b"\x1f\x8b\x08", after)
    if good < len(data):
        yield {"kind": "gap", "offset": good, "length": len(data) - good, "reason": why}


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of an archive, gzipped or plain.

    Offsets count bytes of the file; inside a gzip member, of the member's text,
    with the member's own offset in ``member``. A file that begins with neither a
    member nor a version line is read both ways if it holds a member's mark
    anywhere, and the way that finds more records counts. A record of a damaged
    member is kept if it passes its own checks; the member is logged as a gap too, as
    the damage may lie in the record's header, which has no digest.
    """
    if data.startswith(b"\x1f\x8b"):
        yield from _salvage_members(data, 0)
        return
    first = -1 if data.startswith(b"WARC/") else data.find(b"\x1f\x8b\x08")
    if first < 0:
        yield from salvage_plain(data)
        return
    plain, packed = list(salvage_plain(data)), list(_salvage_members(data, first))
    records = lambda rows: sum(r["kind"] == "record" for r in rows)
    yield from packed if records(packed) > records(plain) else plain


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """``RECORD_SCHEMA`` rows: every record that passes, and every gap."""
    names = [f.strip().split(" ")[0] for f in RECORD_SCHEMA.split(",")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[f.strip().split(" ")[1]] for f in RECORD_SCHEMA.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for r in salvage(content.as_py()):
                    if not with_payload:
                        r.pop("payload", None)
                    rows.append(r | {"file": file})
                    held += len(r.get("payload") or b"") + 200
                    if held > 8_000_000:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)

    def pack(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names=names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, RECORD_SCHEMA)


def page_id_of(urn: Column) -> Column:
    """The page id inside a record id of ``write_archives``; null if empty."""
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, **cols) -> DataFrame:
    """Writes the pages' archives to the shared folder and reads them back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, **cols)
    back = read_archives(pages.sparkSession, path, with_payload=False)
    return back.filter("kind = 'record'").select(
        page_id_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", page_id_of(F.col("refers_to")).alias("refers_to"))
