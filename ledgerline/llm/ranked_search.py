"""Ranked lexical search: short lists term at a time, long lists document at a time.

Index. Each task cuts its documents into segments of about ``SEGMENT_BYTES`` of text and
writes one row for each: ids and lengths of its documents, its terms, and their
postings (document's place in the segment, occurrences) one list after the other. The
index is a table in the shared folder; it holds every document and every term, needs
no shuffle and serves any number of searches.

Search. The statistics of the terms asked for come from the index's lists. Queries go to
the segments in blocks of at most about ``BLOCK_TERMS`` terms, so that what is sent to the
tasks is bounded; each task keeps the best k per query over its segments, and the
best of all tasks are ranked. Within a segment, for each query:

1. Term at a time: lists shorter than ``SHORT`` of the segment's documents are summed
   into accumulators (document, sum), in document order.
2. The accumulators become one iterator among the long lists, with a bound for each block
   of ``BLOCK`` documents, as the lists have. The k-th largest sum so far is a
   threshold: no document whose bound lies below it can be among the best k.
3. Document at a time, in windows of ``WINDOW`` documents: blocks whose bounds add up to less
   than the threshold are skipped. In the others the long lists are asked for the
   documents left, the list with the largest bound first; after each list, documents
   that can't reach the threshold any more leave. The threshold rises with each
   window and is kept from segment to segment.

Nothing is approximate: bounds are exact integers, and a document leaves only if its bound is
below the threshold, not at it, so ties come out by document id.

Defined results: null and empty texts have no terms; documents without terms count
neither in N nor in L and never match; items without a known term have no rows; repeated
documents are ranked each; null document ids sort last; items repeated with id
and text are one item, items that share an id but not a text are ranked each; other columns
are ignored; an empty index or no items give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.llm.common import row_slices, text_bytes, text_hash, written
from ledgerline.session import batches_of

TOP = 10
SEGMENT_BYTES = 4 << 20
BLOCK_TERMS = 200_000
#: Share of a segment's documents below which a list is short.
SHORT = 1 / 16
BLOCK = 32
WINDOW = 256
#: A task holds a row group of the index at a time, not its file: their bytes are looked at
#: after every row, as a row is a whole segment.
ROW_GROUPS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1",
              "parquet.page.size.row.check.max": "1"}
#: Bytes of segments that reach Python at a time, or one segment.
BATCH_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of several texts, and the number of the text of each."""
    buf, offsets = text_bytes(texts)
    inside = _INSIDE[buf]
    n = len(buf)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends),
                                             pa.py_buffer(_LOWER[buf[inside]]))
    return terms, np.searchsorted(offsets, start, "right") - 1


def _postings(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, length of each one's list, documents, occurrences; terms of each document)."""
    words, doc = terms_of(texts)
    rows = len(texts)
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64)
    key, tf = np.unique(ids * rows + doc, return_counts=True)
    term = key // max(rows, 1)
    return (coded.dictionary, np.bincount(term, minlength=len(coded.dictionary)),
            key - term * rows, tf, np.bincount(doc, minlength=rows))


INDEX = ("doc_ids array<long>, lengths array<int>, terms array<string>, sizes array<int>, "
         "docs array<int>, tfs array<int>")
_NAMES = [f.strip().split(" ")[0] for f in INDEX.split(",")]


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``INDEX`` rows, one per segment of ``docs``, written to the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 1, segment_bytes):
                terms, sizes, place, tf, lengths = _postings(part.column(1))
                one = lambda values, kind: pa.array([values], pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()),
                                              part.column(0)),
                     one(lengths, pa.int32()),
                     pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()),
                                              terms.cast(pa.string())),
                     one(sizes, pa.int32()), one(place, pa.int32()), one(tf, pa.int32())],
                    names=_NAMES)

    return written(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
                   .mapInArrow(run, INDEX), "search-index", **ROW_GROUPS)


def corpus_size(index_: DataFrame) -> tuple[int, int]:
    """(N, L): documents with a term, and all their terms with repeats."""
    filled = F.size(F.filter("lengths", lambda n: n > 0)).cast("long")
    terms = F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n)
    row = index_.agg(F.sum(filled).alias("n"), F.sum(terms).alias("l")).first()
    return row["n"] or 0, row["l"] or 0


def _query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, text_hash, term, repeats of each different item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 2, SEGMENT_BYTES):
                terms, size, place, tf, _ = _postings(part.column(2))
                own = pa.array(place)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), part.column(1).take(own),
                     terms.cast(pa.string()).take(pa.array(np.repeat(np.arange(len(size)), size))),
                     pa.array(tf)], names=["item_id", "text_hash", "term", "repeats"])

    base = items.select(F.col(id_col).alias("item_id"), text_hash(F.col(text_col)).alias("text_hash"),
                        F.col(text_col).cast("string").alias("text")) \
        .dropDuplicates(["item_id", "text_hash"])
    kind = base.schema["item_id"].dataType.simpleString()
    return base.mapInArrow(run, f"item_id {kind}, text_hash long, term string, repeats long")


def weighted_queries(index_: DataFrame, items: DataFrame, n: int, id_col: str = "item_id",
                     text_col: str = "text") -> DataFrame:
    """item_id, text_hash, term, repeats, df, weight: terms of items that documents hold."""
    terms = _query_terms(items, id_col, text_col)
    lists = index_.select(F.explode(F.arrays_zip("terms", "sizes")).alias("list")) \
        .select(F.col("list.terms").alias("term"), F.col("list.sizes").cast("long").alias("size"))
    df = lists.join(terms.select("term").distinct(), "term").groupBy("term") \
        .agg(F.sum("size").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2 * n + 2).cast("double") / (2 * F.col("df") + 1)))
    return terms.join(df, "term").withColumn("weight", weight.cast("long"))


@dataclass
class Block:
    """Some queries: for each the numbers of its terms and their repeats."""

    terms: pa.Array
    weights: np.ndarray
    queries: list[tuple[np.ndarray, np.ndarray]]


def _blocks(queries: DataFrame, block_terms: int) -> Iterator[tuple[list, Block]]:
    """Queries with all their terms, a bounded number at a time: their ids, and ``Block``."""
    whole = queries.groupBy("item_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("term", "repeats", "weight"))).alias("terms"))
    count = queries.count()
    parts = max(1, math.ceil(count / block_terms))
    for k in range(parts):
        rows = whole.filter(F.pmod(F.xxhash64("item_id", "text_hash"), F.lit(parts)) == k).collect()
        known: dict[str, int] = {}
        weights: list[int] = []
        found = []
        for r in rows:
            for t in r["terms"]:
                if t["term"] not in known:
                    known[t["term"]] = len(weights)
                    weights.append(t["weight"])
            found.append((np.array([known[t["term"]] for t in r["terms"]]),
                          np.array([t["repeats"] for t in r["terms"]], np.int64)))
        yield [(r["item_id"], r["text_hash"]) for r in rows], \
            Block(pa.array(list(known), pa.string()), np.array(weights, np.int64), found)


class Lists:
    """The lists of a block's terms in one segment, with scores and bounds."""

    def __init__(self, row: dict, block: Block, n: int, total: int):
        self.ids, self.rows = row["doc_ids"], len(row["lengths"])
        at = pc.index_in(row["terms"], value_set=block.terms)
        here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        number = at.take(pa.array(here)).to_numpy()
        sizes = row["sizes"].astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        size, start = sizes[here], starts[here]
        take = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        self.docs = row["docs"][take].astype(np.int64)
        tf = row["tfs"][take].astype(np.int64)
        m = 25 + (75 * row["lengths"].astype(np.int64) * n) // max(total, 1)
        self.scores = np.repeat(block.weights[number], size) \
            * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs]))
        self.ends = np.concatenate([[0], np.cumsum(size)])
        self.place = np.full(len(block.weights), -1)
        self.place[number] = np.arange(len(here))
        self.blocks = -(-self.rows // BLOCK)
        self.known_bounds: dict[int, np.ndarray] = {}

    def list(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.ends[k], self.ends[k + 1]
        return self.docs[lo:hi], self.scores[lo:hi]

    def bounds(self, k: int) -> np.ndarray:
        """The largest score of list k in each block of documents."""
        if k not in self.known_bounds:
            self.known_bounds[k] = _block_bounds(*self.list(k), self.blocks)
        return self.known_bounds[k]


def _block_bounds(docs: np.ndarray, scores: np.ndarray, blocks: int) -> np.ndarray:
    out = np.zeros(blocks, np.int64)
    if len(docs):
        block = docs // BLOCK
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        out[block[first]] = np.maximum.reduceat(scores, first)
    return out


class Best:
    """A query's best documents so far over a task's segments."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple[int, bool, int]] = []  # score down, null ids last, id

    def threshold(self) -> int:
        return -self.rows[self.k - 1][0] if len(self.rows) >= self.k else 1

    def add(self, scores: np.ndarray, docs: np.ndarray, ids: pa.Array) -> None:
        found = zip(scores.tolist(), ids.take(pa.array(docs)).to_pylist())
        self.rows = sorted([*self.rows, *[(-s, d is None, d or 0) for s, d in found]])[:self.k]


def _accumulated(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: sums per document, in document order."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    docs, scores = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], scores[order]
    first = np.flatnonzero(np.concatenate([docs[:1] >= 0, docs[1:] != docs[:-1]]))
    return docs[first], np.add.reduceat(scores, first) if len(first) else scores


def search_segment(lists: Lists, query: tuple[np.ndarray, np.ndarray], best: Best) -> int:
    """Add a segment's best documents for a query to ``best``; how many were looked at."""
    at = lists.place[query[0]]
    held = np.flatnonzero(at >= 0)
    if not len(held):
        return 0
    short, long = [], []
    for k, repeats in zip(at[held].tolist(), query[1][held].tolist()):
        docs, scores = lists.list(k)
        if len(docs) < SHORT * lists.rows:
            short.append((docs, scores * repeats))
        else:
            long.append((docs, scores * repeats, lists.bounds(k) * repeats))
    acc_docs, acc = _accumulated(short)
    threshold = best.threshold()
    if len(acc) >= best.k:
        threshold = max(threshold, int(np.partition(acc, len(acc) - best.k)[len(acc) - best.k]))
    acc_bounds = _block_bounds(acc_docs, acc, lists.blocks)
    long.sort(key=lambda x: -int(x[2].max()))
    upper = acc_bounds + sum(x[2] for x in long) if long else acc_bounds
    after = np.zeros((len(long) + 1, lists.blocks), np.int64)  # bounds of the lists still to come
    for k in range(len(long) - 1, -1, -1):
        after[k] = after[k + 1] + long[k][2]
    looked = 0
    step = WINDOW // BLOCK
    for window in range(0, lists.blocks, step):
        open_ = np.flatnonzero(upper[window:window + step] >= threshold) + window
        if not len(open_):
            continue
        docs = (open_[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        docs = docs[docs < lists.rows]
        score = np.zeros(len(docs), np.int64)
        if len(acc_docs):
            where = np.minimum(np.searchsorted(acc_docs, docs), len(acc_docs) - 1)
            score = np.where(acc_docs[where] == docs, acc[where], 0)
        block = docs // BLOCK
        looked += len(docs)
        for k, (own, scores, _) in enumerate(long):
            left = score + after[k][block] >= threshold
            if not left.all():
                docs, score, block = docs[left], score[left], block[left]
                if not len(docs):
                    break
            where = np.minimum(np.searchsorted(own, docs), len(own) - 1)
            score = score + np.where(own[where] == docs, scores[where], 0)
        left = (score >= threshold) & (score > 0)
        if left.any():
            best.add(score[left], docs[left], lists.ids)
            threshold = max(threshold, best.threshold())
    return looked


def _search_block(index_: DataFrame, block: Block, n: int, total: int, k: int) -> DataFrame:
    """query, doc_id, score: each task's best k per query of the block, written to the shared
    folder."""
    shared = index_.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        best = [Best(k) for _ in block.queries]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i].values for j, c in enumerate(_NAMES)}
                row |= {c: row[c].to_numpy() for c in ("lengths", "sizes", "docs", "tfs")}
                lists = Lists(row, block, n, total)
                for query, found in zip(block.queries, best):
                    search_segment(lists, query, found)
        rows = [(q, None if none else d, -s) for q, b in enumerate(best) for s, none, d in b.rows]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64()))],
                names=["query", "doc_id", "score"])

    with batches_of(index_.sparkSession, BATCH_BYTES):
        return written(index_.select(*_NAMES).mapInArrow(run, "query int, doc_id long, score long"),
                       "search-best")


def search(index_: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "item_id",
           text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score, text_hash: the ``top`` documents of each item."""
    spark = index_.sparkSession
    n, total = corpus_size(index_)
    queries = written(weighted_queries(index_, items, n, id_col, text_col), "search-queries")
    kind = queries.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame(
        [], f"item_id {kind}, text_hash long, doc_id long, score long")
    for ids, block in _blocks(queries, block_terms):
        if not ids:
            continue
        names = spark.createDataFrame([(q, *i) for q, i in enumerate(ids)],
                                      f"query int, item_id {kind}, text_hash long")
        out = out.unionByName(_search_block(index_, block, n, total, top).join(names, "query")
                              .drop("query"))
    order = Window.partitionBy("item_id", "text_hash").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top) \
        .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score", "text_hash")
