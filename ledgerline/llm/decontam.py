"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of ``WINDOW`` words (a shorter item is one
window); a window is a sequence of three-word shingles. Shingles are ordered by
rarity: how often each occurs in the whole corpus. For full containment one
prefix token suffices: a document can only hold a window if it holds the
window's rarest shingle. So windows meet the documents on that shingle alone, with
the bounds

- length: only stretches whose shingles are all benchmark shingles and that
  are as long as the shortest window come to the join at all;
- position: the shingle's place in the stretch, less its place in the window,
  must leave room for the whole window;

and what is left is verified word by word. The documents are scanned once. The scan
tests each shingle's hash against a bitmap of benchmark shingles (``FILTER_BITS``
bits, a fixed size; a false positive only means a stretch that the join throws
out) and emits word counts, shingle counts and candidate stretches. Texts are
never shuffled.

Defined results: null or wordless documents have no hits and zero words; null or
wordless items have no windows; items repeated under one id count once; repeated
documents (equal id and text) get equal rows each, and rows that share an id but
not a text are kept apart; a null id is kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import row_slices, text_bytes, text_hash, written

WINDOW = 10
SHINGLE = 3
FILTER_BITS = 25
SLICE_BYTES = 1 << 20

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of words after lower-casing: digits, letters and all of non-ASCII; others are 0.
_FOLD = np.array([c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
                  else c + 32 if 0x41 <= c <= 0x5A else 0 for c in range(256)], np.uint8)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: Column) -> Column:
    """A text's words (null: none)."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _NOT_WORD),
                    lambda w: w != "")


# --- word places and shingle hashes of a block of texts ------------------------

def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Words:
    """Word bounds and hashes of several texts that lie one after the other."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.bytes = _FOLD[buf]
        n = len(buf)
        inside = self.bytes != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        bounds = offsets[1:-1]
        bounds = bounds[(bounds > 0) & (bounds < n)]
        first[bounds] = inside[bounds]
        last[bounds - 1] = inside[bounds - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        # Prefix sums of byte * base^place; a word's hash takes its place out again.
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * _powers(n), out=total[1:])
        back = np.full(n, np.uint64(_inverse(int(_BASE))), np.uint64)
        if n:
            back[0] = 1
        back = np.multiply.accumulate(back) if n else back
        self.hash = (total[self.end] - total[self.start]) * back[self.start]
        #: words[doc]:words[doc + 1] are a text's words.
        self.words = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.words))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, valid) of the shingle of ``size`` words that starts at each word."""
        n = len(self.hash)
        out = np.zeros(n, np.uint64)
        valid = np.zeros(n, bool)
        if n >= size:
            m = n - size + 1
            h = np.zeros(m, np.uint64)
            for k in range(size):
                h = (h + self.hash[k:k + m]) * _MIX
                h ^= h >> np.uint64(29)
            out[:m] = h
            valid[:m] = self.doc[:m] == self.doc[size - 1:]
        return out, valid

    def text(self, i: int, j: int) -> list[str]:
        """Words i to j - 1."""
        raw = self.bytes
        return [raw[a:b].tobytes().decode("utf-8", "replace")
                for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist())]


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def hash_shingles(texts: list[str], size: int) -> np.ndarray:
    """Hashes of shingles given as space-joined words, as the scan computes them."""
    arr = pa.array(texts, pa.large_string())
    buf, offsets = text_bytes(arr)
    h, valid = Words(buf, offsets).shingles(size)
    return h[valid]


# --- benchmark -------------------------------------------------------------------

def windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """item_id, words of each window of each item."""
    base = items.select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return (base.filter(F.size("w") > 0)
            .select("item_id", "w", F.explode(starts).alias("at"))
            .select("item_id", F.slice("w", F.col("at"), F.lit(window)).alias("words")))


def _window_shingles(win: DataFrame) -> DataFrame:
    """window, item_id, words, size, shingle, place: every shingle of every window."""
    size = F.least(F.size("words"), F.lit(SHINGLE))
    places = F.sequence(F.lit(0), F.size("words") - F.col("size"))
    return (win.withColumn("size", size)
            .select("*", F.explode(places).alias("place"))
            .withColumn("shingle", F.array_join(
                F.slice("words", F.col("place") + 1, F.col("size")), " ")))


# --- scan -----------------------------------------------------------------------

SCAN = ("kind string, doc_id long, text_hash long, n_words long, size int, first_word long, "
        "words array<string>, shingle_hash long, occurrences long")


def _bitmaps(shingles: DataFrame) -> dict[int, np.ndarray]:
    """Per shingle size, a bitmap of fixed size with the slots of its shingles set.

    Tasks hash the benchmark's shingles and send distinct slots; the driver holds
    the bitmap (2**FILTER_BITS bits), whatever the benchmark's size.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(0))
            for size in np.unique(sizes):
                texts = batch.column(1).filter(pa.array(sizes == size)).to_pylist()
                slots = _slot(hash_shingles(texts, int(size)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slots), size), pa.int32()),
                     pa.array(slots >> 6, pa.int64()),
                     pa.array(slots & 63, pa.int64())], names=["size", "word", "bit"])

    slots = shingles.select("size", "shingle").distinct().mapInArrow(
        run, "size int, word long, bit long")
    filled = slots.groupBy("size", "word").agg(
        F.expr("bit_or(shiftleft(1L, cast(bit AS int)))").alias("bits"))
    out: dict[int, np.ndarray] = {}
    for r in filled.toLocalIterator():
        bitmap = out.setdefault(r["size"], np.zeros(1 << (FILTER_BITS - 6), np.int64))
        bitmap[r["word"]] = r["bits"]
    return out


def _scan(docs: DataFrame, bitmaps: dict[int, np.ndarray], least: dict[int, int], window: int,
          id_col: str, text_col: str) -> DataFrame:
    """``SCAN`` rows: 'doc' per document, 'count' per seen shingle hash and task,
    'stretch' per run of shingles that pass the bitmap.

    ``least``: per shingle size the shortest window's number of shingles. A stretch
    longer than four windows is cut into stretches of that length that overlap by
    a window less one word, so that each window lies in one of them.
    """
    longest = 4 * window
    shared = docs.sparkSession.sparkContext.broadcast(bitmaps)
    names = [f.strip().split(" ")[0] for f in SCAN.split(",")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
             pa.list_(pa.string()), pa.int64(), pa.int64()]

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def counted(counts: dict) -> Iterator[pa.RecordBatch]:
        if counts:
            yield emit([("count", None, None, None, s, None, None, h, n)
                        for (s, h), n in counts.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = {s: b.view(np.uint64) for s, b in shared.value.items()}
        counts: dict[tuple[int, int], int] = {}
        for batch in batches:
            for part in row_slices(batch, 2, SLICE_BYTES):
                ids, hashes = part.column(0).to_pylist(), part.column(1).to_pylist()
                w = Words(*text_bytes(part.column(2)))
                rows = [("doc", d, t, n, None, None, None, None, None)
                        for d, t, n in zip(ids, hashes, np.diff(w.words).tolist())]
                for size, bitmap in maps.items():
                    h, ok = w.shingles(size)
                    slot = _slot(h)
                    ok &= (bitmap[slot >> 6] >> (slot & 63).astype(np.uint64)
                           & np.uint64(1)).astype(bool)
                    seen, number = np.unique(h[ok].view(np.int64), return_counts=True)
                    for key, n in zip(seen.tolist(), number.tolist()):
                        counts[size, key] = counts.get((size, key), 0) + n
                    # Runs of passing shingles within one document.
                    at = np.flatnonzero(ok)
                    if not len(at):
                        continue
                    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(w.doc[at]) > 0)) + 1
                    lo = at[np.concatenate([[0], cut])]
                    hi = at[np.concatenate([cut - 1, [len(at) - 1]])] + 1
                    for a, b in zip(lo.tolist(), hi.tolist()):
                        if b - a < least[size]:
                            continue
                        d, end = int(w.doc[a]), b + size - 1
                        for at in range(a, max(a + 1, end - window + 1), longest - window + 1):
                            rows.append(("stretch", ids[d], hashes[d], None, size,
                                         at - int(w.words[d]),
                                         w.text(at, min(end, at + longest)), None, None))
                if rows:
                    yield emit(rows)
                if len(counts) > 1_000_000:
                    yield from counted(counts)
                    counts = {}
        yield from counted(counts)

    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         text_hash(text).alias("text_hash"), text.alias("text"))
    return source.mapInArrow(run, SCAN)


def _with_hash(shingles: DataFrame) -> DataFrame:
    """size, shingle, shingle_hash of distinct shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(0))
            for size in np.unique(sizes):
                texts = batch.column(1).filter(pa.array(sizes == size))
                h = hash_shingles(texts.to_pylist(), int(size)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), size), pa.int32()), texts, pa.array(h)],
                    names=["size", "shingle", "shingle_hash"])

    return shingles.select("size", "shingle").distinct().mapInArrow(
        run, "size int, shingle string, shingle_hash long")


# --- join ------------------------------------------------------------------------

def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                text_col: str = "text", item_col: str = "item_id",
                item_text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, hits).

    documents: doc_id, text_hash, n_words per input row. hits: doc_id, text_hash, item_id,
    first_word, length: one row per place where a window of the item occurs.
    """
    win = written(windows(items, item_col, item_text_col, window).distinct()
                  .withColumn("window", F.xxhash64("words")), "bench-windows")
    distinct = win.select("window", "words").distinct()
    shingles = written(_window_shingles(distinct), "bench-shingles")
    least = {r["size"]: r["least"] for r in distinct.select(
        F.least(F.size("words"), F.lit(SHINGLE)).alias("size"), F.size("words").alias("n"))
        .groupBy("size").agg((F.min("n") - F.col("size") + 1).alias("least")).collect()}
    scanned = written(_scan(docs, _bitmaps(shingles), least, window, id_col, text_col), "bench-scan")

    # Rarity: corpus counts of the benchmark's shingles; unseen ones are the rarest.
    counts = (scanned.filter("kind = 'count'").groupBy("size", "shingle_hash")
              .agg(F.sum("occurrences").alias("seen")))
    rarity = _with_hash(shingles).join(counts, ["size", "shingle_hash"], "left").select(
        "size", "shingle", F.coalesce("seen", F.lit(0)).alias("seen"))
    prefix = (shingles.join(rarity, ["size", "shingle"])
              .groupBy("window", "words", "size")
              .agg(F.min(F.struct("seen", "shingle", "place")).alias("rare"))
              .filter("rare.seen > 0")
              .select("window", "words", "size", "rare.shingle", "rare.place"))

    stretch = (scanned.filter("kind = 'stretch'")
               .select("doc_id", "text_hash", "size", "first_word", "words")
               .distinct())
    tokens = stretch.withColumnRenamed("words", "text").select(
        "*", F.explode(F.sequence(F.lit(0), F.size("text") - F.col("size"))).alias("at")) \
        .withColumn("shingle", F.array_join(F.slice("text", F.col("at") + 1, F.col("size")), " "))
    begin = F.col("at") - F.col("place")
    found = (tokens.join(prefix, ["size", "shingle"])
             .filter((begin >= 0) & (begin + F.size("words") <= F.size("text")))
             .filter(F.slice("text", begin + 1, F.size("words")) == F.col("words"))
             .select("doc_id", "text_hash", "window", (F.col("first_word") + begin)
                     .alias("first_word"), F.size("words").alias("length")))
    hits = found.join(win.select("window", "item_id"), "window").drop("window")
    documents = scanned.filter("kind = 'doc'").select("doc_id", "text_hash", "n_words")
    return documents, hits


def covered(spans: Column) -> Column:
    """Words covered by an array of structs (first_word, length)."""
    ordered = F.array_sort(spans)
    return F.aggregate(
        ordered, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["first_word"] + s["length"]
                                   - F.greatest(acc["to"], s["first_word"]))).cast("long").alias("n"),
            F.greatest(acc["to"], s["first_word"] + s["length"]).cast("long").alias("to")),
        lambda acc: acc["n"])


def judge(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    documents, hits = occurrences(docs, items, **options)
    places = hits.select("doc_id", "text_hash", "first_word", "length").distinct()
    key = [F.col("doc_id"), F.col("text_hash")]
    cover = places.groupBy(*key).agg(covered(F.collect_list(F.struct("first_word", "length")))
                                     .alias("n_hit"))
    listed = (hits.select("doc_id", "text_hash", F.col("item_id").cast("string").alias("item"))
              .distinct().groupBy(*key)
              .agg(F.count("item").alias("n_items"),
                   F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items")))
    marks = cover.join(listed.withColumnsRenamed({"doc_id": "d", "text_hash": "t"}),
                       F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")),
                       "left").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"),
                                      "n_hit", "n_items", "items")
    return documents.join(
        marks, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")), "left") \
        .select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
                (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` (columns doc_id and text) without the rows that hold a benchmark window."""
    _, hits = occurrences(docs, items, **options)
    bad = hits.select(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash"))
    bad = written(bad.distinct(), "bench-hits")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_hit_id"])
                     & (text_hash(docs["text"]) == bad["_hit_hash"]), "left_anti")
