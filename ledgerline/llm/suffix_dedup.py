"""Repeated byte strings across the corpus, by prefix-free parsing.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere, in
the same document or another, is removed.

Parsing. A rolling hash of ``GRAM`` bytes marks triggers: the trigger of a string is
the place of the smallest hash in its first ``REACH`` bytes, the leftmost on ties, so
equal strings have it at the same place. Triggers cut a document into phrases. A
string that starts at p splits at its trigger a into the phrase's suffix [p, a)
and the parse's suffix from a on: the pair that dictionary and parse order sort
by. Repeats only need to know which suffixes are equal, cut at ``LENGTH`` bytes, so
classes of equal suffixes (shuffled digests) take the place of globally sorted
suffix arrays, which would need a sort of the whole parse for every doubling of
the depth:

1. All strings with trigger a share the bytes from a on up to the end of the first
   of them, their core. Triggers whose core occurs once have no repeats and end here;
   that is almost all of them.
2. Triggers whose whole span (all strings with this trigger) has an equal elsewhere
   are repeats throughout.
3. What is left are the ends of repeated stretches. There the strings are taken in
   blocks of ``BLOCKS`` by their distance to the trigger, with core and span of each
   block, and compared in the same way, against each other and one representative of
   each span found before; the last block size is one string.

Strings are judged equal by two 64-bit BLAKE2 digests together, of core and span.
Digests are grouped by sums and joined back, so a passage shared by a third of the
corpus is combined before it is shuffled. Every step's table is written to the
shared folder, and the files of steps that are over are released.

Defined results: null text is empty; texts below ``LENGTH`` bytes keep all; rows
repeated with id and text are repeats of each other, and both lose them; rows that
share an id but not a text are kept apart; a null id is kept; other columns are
ignored by ``repeats``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerline.llm.common import discard, release, row_slices, text_bytes, text_hash, written

LENGTH = 400
GRAM = 8
REACH = 240
#: Block sizes of step 3.
BLOCKS = (16, 1)
SLICE_BYTES = 1 << 19

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def triggers(buf: np.ndarray, reach: int = REACH) -> np.ndarray:
    """For each place p with ``reach`` bytes left: the trigger of a string that starts there."""
    n, span = len(buf), reach - GRAM + 1
    if n < reach:
        return np.zeros(0, np.int64)
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buf, GRAM)) \
        .view(np.uint64).ravel()
    grams = grams * _C1
    grams ^= grams >> np.uint64(32)
    grams *= _C2
    # The hash above, the place below: the smallest is the leftmost of the smallest hashes.
    grams &= np.uint64(0xFFFFFFFF00000000)
    grams |= np.arange(len(grams), dtype=np.uint64)
    count = len(grams) - span + 1
    pad = -len(grams) % span
    block = np.concatenate([grams, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, span)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:count], ahead[span - 1:span - 1 + count])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def spans_of(buf: np.ndarray, offsets: np.ndarray, length: int, reach: int) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, trigger, first, last): runs of string starts with one trigger."""
    empty = np.zeros(0, np.int64)
    where = triggers(buf, reach)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(counts.sum())
    if not total:
        return empty, empty, empty, empty
    doc = np.repeat(np.arange(len(counts)), counts)
    before = np.repeat(np.cumsum(counts) - counts, counts)
    at = np.arange(total) - before + offsets[:-1][doc]
    trigger = where[at]
    first = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
    last = np.append(first[1:], total) - 1
    return doc[first], trigger[first], at[first], at[last]


def _source(docs: DataFrame, id_col: str, text_col: str, rest: list[str]) -> DataFrame:
    """doc_id, text_hash, text and ``rest``: a struct of further columns of ``docs``."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.struct(F.lit(True).alias("_row"), *[F.col(f"`{c}`") for c in rest]).alias("rest"))


#: A run of string starts with one trigger, or a block of it. ``copies``: 2 where the row
#: stands for a span already found twice, else 1.
RUNS = ("doc_id long, text_hash long, core long, span long, trigger int, first int, last int, "
        "copies int")


def _digests(raw: bytes, length: int, block: int, trigger: int, first: int, last: int,
             k: int) -> tuple[int, int]:
    """(core, span) of the strings from first to last, which lie in block k of a trigger.

    The core is what all strings of the whole block share, even where the run
    holds only some of them, so that it is the same for equal strings."""
    core = raw[trigger - k * block:trigger - (k + 1) * block + 1 + length]
    span = raw[first:last + length]
    return _digest(core + b"%d" % k), _digest(span + b"%d" % (trigger - first))


def _parse(source: DataFrame, length: int, reach: int) -> DataFrame:
    """``RUNS``: one row per trigger of every document."""
    block = reach - GRAM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 2, SLICE_BYTES):
                yield from parsed(part)

    def parsed(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        buf, offsets = text_bytes(part.column(2))
        doc, trigger, first, last = spans_of(buf, offsets, length, reach)
        if not len(doc):
            return
        raw = buf.tobytes()
        pairs = [_digests(raw, length, block, a, lo, hi, 0)
                 for a, lo, hi in zip(trigger.tolist(), first.tolist(), last.tolist())]
        base = offsets[:-1][doc]
        take = pa.array(doc)
        place = lambda x: pa.array((x - base).astype(np.int32))
        yield _runs(part.column(0).take(take), part.column(1).take(take), pairs, place(trigger),
                    place(first), place(last), pa.array(np.ones(len(doc), np.int32)))

    return source.drop("rest").mapInArrow(run, RUNS)


def _runs(doc_id, text_hash, pairs, trigger, first, last, copies) -> pa.RecordBatch:
    cores, spans = zip(*pairs)
    return pa.RecordBatch.from_arrays(
        [doc_id, text_hash, pa.array(cores, pa.int64()), pa.array(spans, pa.int64()),
         trigger, first, last, copies], names=[f.strip().split(" ")[0] for f in RUNS.split(",")])


def _judged(runs: DataFrame) -> DataFrame:
    """Of a written table of runs, which goes: those whose core occurs twice, with ``status``:

    'full': all strings are repeats; 'both': so, and the run stands for its span in the
    next step, because others share its core alone; 'edge': to be looked at closer.
    """
    # Written first, so that the join can split a core that many runs share.
    twice = written(runs.groupBy("core").agg(F.sum("copies").alias("n")).filter("n > 1").drop("n"),
                    "suffix-twice")
    shared = written(runs.join(twice, "core"), "suffix-shared")
    discard(twice, runs)
    release(runs.sparkSession)
    spans = shared.groupBy("core").agg(F.min("span").alias("s1"), F.max("span").alias("s2"))
    mixed_cores = written(spans.filter("s1 <> s2").select("core", F.lit(True).alias("mixed")),
                          "suffix-mixed")
    marked = shared.join(mixed_cores, "core", "left")
    place = F.struct("doc_id", "text_hash", "first")
    equal = written(marked.filter("mixed").groupBy("core", "span").agg(
        F.sum("copies").alias("n"), F.min(place).alias("stands")), "suffix-equal")
    judged = marked.filter("mixed").join(equal, ["core", "span"]).withColumn(
        "status", F.when(F.col("n") == 1, "edge")
        .when(place.eqNullSafe(F.col("stands")), "both").otherwise("full"))
    columns = ["doc_id", "text_hash", "status", "trigger", "first", "last", "copies"]
    out = written(marked.filter("mixed IS NULL").withColumn("status", F.lit("full"))
                  .select(*columns).unionByName(judged.select(*columns)), "suffix-judged")
    discard(shared, mixed_cores, equal)
    release(runs.sparkSession)
    return out


def _per_document(judged: DataFrame) -> DataFrame:
    """d, t, full: starts of strings to remove; open: runs of the next step."""
    full = F.when((F.col("status") != "edge") & (F.col("copies") == 1),
                  F.struct("first", "last"))
    further = F.when(F.col("status") != "full", F.struct(
        "trigger", "first", "last",
        F.when(F.col("status") == "edge", 1).otherwise(2).alias("copies")))
    return judged.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).agg(
        F.collect_set(full).alias("full"), F.collect_set(further).alias("open"))


def _same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["d"]) & (left["text_hash"] == right["t"])


def _blocks(opened: DataFrame, length: int, block: int) -> DataFrame:
    """``RUNS``: the open runs of (doc_id, text_hash, text, open), cut into blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 2, SLICE_BYTES):
                yield from cut(part)

    def cut(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for doc_id, text_hash, text, runs in zip(
                part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2),
                part.column(3)):
            raw = text.as_buffer().to_pybytes()
            rows, pairs = [], []
            for r in runs.as_py():
                at, first, last = r["trigger"], r["first"], r["last"]
                for k in range((at - last) // block, (at - first) // block + 1):
                    lo, hi = max(first, at - (k + 1) * block + 1), min(last, at - k * block)
                    rows.append((at, lo, hi, r["copies"]))
                    pairs.append(_digests(raw, length, block, at, lo, hi, k))
            if rows:
                n = len(rows)
                yield _runs(pa.array([doc_id] * n, pa.int64()),
                            pa.array([text_hash] * n, pa.int64()), pairs,
                            *[pa.array(c, pa.int32()) for c in zip(*rows)])

    return opened.select("doc_id", "text_hash", "text", "open").mapInArrow(run, RUNS)


def _merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(intervals):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


RESULT = ("doc_id long, text_hash long, n_bytes long, n_removed long, n_spans long, "
          "kept_sha256 string, kept binary")


def _cut(marked: DataFrame, length: int, with_text: bool) -> DataFrame:
    """``RESULT`` and ``rest`` of (doc_id, text_hash, text, gone, rest) without the strings
    that ``gone`` (runs of starts) names."""
    names = [f.strip().split(" ")[0] for f in RESULT.split(",")] + ["rest"]
    types = [pa.int64()] * 5 + [pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held, first = [], 0, 0
            for k, (doc_id, text_hash, text, runs) in enumerate(zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                    batch.column(3))):
                raw = text.as_buffer().to_pybytes()
                gone = _merged([(r["first"], r["last"] + length) for r in runs.as_py()])
                kept, done = [], 0
                for lo, hi in gone:
                    kept.append(raw[done:lo])
                    done = hi
                left = b"".join([*kept, raw[done:]])
                rows.append((doc_id, text_hash, len(raw), len(raw) - len(left), len(gone),
                             hashlib.sha256(left).hexdigest(), left if with_text else None))
                held += len(left) if with_text else 100
                if held > 2_000_000 or k == batch.num_rows - 1:
                    yield pack(rows, batch.column(4).slice(first, len(rows)))
                    rows, held, first = [], 0, k + 1

    def pack(rows: list[tuple], rest: pa.Array) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([*columns, rest], names=names)

    source = marked.select("doc_id", "text_hash", "text", "gone", "rest")
    schema = T._parse_datatype_string(RESULT).add("rest", source.schema["rest"].dataType)
    return source.mapInArrow(run, schema)


def repeats(docs: DataFrame, length: int = LENGTH, reach: int = REACH, id_col: str = "doc_id",
            text_col: str = "text", with_text: bool = False,
            rest: tuple[str, ...] = ()) -> DataFrame:
    """``RESULT`` per row of ``docs``, and ``rest``, a struct of the columns named so.

    ``kept``, the remaining bytes, is filled only ``with_text``.
    """
    if not GRAM <= reach <= length:
        raise ValueError("reach must lie between the rolling hash's size and the length")
    spark = docs.sparkSession
    source = _source(docs, id_col, text_col, list(rest))
    parse = written(_parse(source, length, reach), "suffix-parse")
    first = _judged(parse)
    per_doc = _per_document(first)
    whole = F.col("full").isNull()
    documents = written(source.join(per_doc, _same_document(source, per_doc), "left").select(
        "doc_id", "text_hash", F.octet_length("text").cast("long").alias("n_bytes"),
        F.when(whole, F.sha2(F.col("text").cast("binary"), 256)).alias("kept_sha256"),
        F.when(~whole | F.lit(with_text), F.col("text")).alias("text"), "full", "open", "rest"),
        "suffix-documents")
    discard(first)
    release(spark)

    marked = documents.filter("full IS NOT NULL")
    opened, found = marked.filter("size(open) > 0"), []
    for block in BLOCKS:
        runs = written(_blocks(opened, length, block), "suffix-blocks")
        judged = _judged(runs)
        found.append(judged.filter("copies = 1 AND status <> 'edge'").select(
            "doc_id", "text_hash", "first", "last"))
        further = _per_document(judged.filter("status <> 'full'")).select("d", "t", "open")
        texts = marked.select("doc_id", "text_hash", "text")
        opened = texts.join(further, _same_document(texts, further))
        release(spark)

    again = found[0]
    for more in found[1:]:
        again = again.unionByName(more)
    again = again.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).agg(
        F.collect_set(F.struct("first", "last")).alias("again"))
    gone = marked.join(again, _same_document(marked, again), "left").withColumn(
        "gone", F.concat("full", F.coalesce("again", F.array().cast(
            "array<struct<first:int,last:int>>"))))
    cut = _cut(gone, length, with_text)
    untouched = documents.filter("full IS NULL").select(
        "doc_id", "text_hash", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), "kept_sha256",
        (F.col("text") if with_text else F.lit(None)).cast("binary").alias("kept"), "rest")
    return cut.unionByName(untouched)


def cut_repeats(docs: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """``docs`` (columns doc_id and text) without the repeated bytes.

    A character of which a byte goes, goes whole. ``n_chars``, where there is such a
    column, is counted again for rows that lose something; null texts stay null.
    """
    others = tuple(c for c in docs.columns if c != "text")
    spare = docs.filter("text IS NULL")
    found = repeats(docs.filter("text IS NOT NULL"), length, reach, with_text=True,
                    rest=others)
    # Cuts inside a character leave some of its bytes, which are not UTF-8 any more.
    text = F.when(F.col("n_removed") == 0, F.col("kept").cast("string")) \
        .otherwise(F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("\ufffd"),
                             F.lit("")))
    cut = found.select(F.col("n_removed"), text.alias("_text"), "rest")
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_text").alias(c))
        elif c == "n_chars":
            columns.append(F.when(F.col("n_removed") > 0, F.length("_text"))
                           .otherwise(F.col("rest").getField(c))
                           .cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("rest").getField(c).alias(c))
    return cut.select(*columns).unionByName(spare)
