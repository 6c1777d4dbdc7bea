"""Phrases of two to five words that occur together more often than by chance.

Counting. Every task counts paths of words in a trie with burstable hash containers
(``hat_trie``), one trie a language. Where the trie outgrows its memory, and at the
end, whole subtrees leave it as sorted runs of phrases with their counts. The runs are
written to the shared folder, dealt out by ranges of phrases (so each partition holds
the subtrees between two prefixes, and a prefix with very many phrases is shared
out among several) and merged there by adding up. A phrase enters the shuffle
at most once for each run, however often it occurs.

A phrase can only reach ``least`` if its words and word pairs do. So counting goes in
three rounds over the texts: words, pairs of words that may be frequent, and paths of
up to five words whose neighbouring pairs all may be; a node's count is the
sum over the paths below it. What may be frequent is told by a bitmap, sized
from the number of frequent words or pairs (``SPARE`` bits each, at most
2**``FILTER_BITS`` bits, 32 MB). A wrong hit costs a row in a run and nothing else: counts
of phrases are exact, by their words.

Scoring. For a phrase with a occurrences and a cut into parts with l and r
occurrences, of n words of its language, the score is floor(1000 a n / (l r)), in
38-digit decimals; the lowest cut counts, the shortest first part on ties. A phrase
inside a longer one that occurs as often is dropped: such a longer one exists
exactly if there is one of one more word, since counts never rise as phrases grow.

Defined results: null and empty texts have no words; a null language is ``und``; only A-Z
are lowered; phrases don't cross ``.,;:!?`` or line ends or texts; repeated rows, also
with equal or null ids, count each; other columns are ignored; equal scores and counts
are ordered by the phrase's bytes; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.common import discard, release, row_slices, text_bytes, written
from ledgerline.llm.hat_trie import BITS, DEPTH, HatTrie, unpack

LEAST = 100
TOP = 2000
UNKNOWN = "und"
FILTER_BITS = 28
SPARE = 16
SLICE_BYTES = 1 << 21

_BLANK, _BREAK = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = _BREAK

_NOTHING, _SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of several texts, and for each whether the next one follows in its piece."""
    buf, offsets = text_bytes(texts)
    kind = _KIND[buf]
    inside = kind == 0
    n = len(buf)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    breaks = np.zeros(n + 1, np.int64)
    np.cumsum(kind == _BREAK, out=breaks[1:])
    text = np.searchsorted(offsets, start, "right")
    follows = np.zeros(len(start), bool)
    follows[:-1] = (breaks[start[1:]] == breaks[start[:-1]]) & (text[1:] == text[:-1])
    ends = np.concatenate([[0], np.cumsum(end - start)])
    words = pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(_LOWER[buf[inside]]))
    return words, follows


class Vocabulary:
    """Ids and hashes of one language's words, in the order of their coming."""

    def __init__(self, lang: str):
        self.seed = xxhash.xxh64_intdigest(lang.encode(), seed=42)
        self.ids: dict[str, int] = {}
        self.hashes: list[int] = [0]
        self.sorted: tuple[pa.Array, np.ndarray] | None = None

    def encode(self, words: pa.Array) -> np.ndarray:
        coded = words.dictionary_encode()
        found = coded.dictionary.to_pylist()
        for word in [w for w in found if w not in self.ids]:
            self.ids[word] = len(self.hashes)
            self.hashes.append(xxhash.xxh64_intdigest(word.encode(), seed=self.seed))
        ids = np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found))
        return ids[coded.indices.to_numpy()]

    def full(self) -> bool:
        return len(self.hashes) > (1 << BITS) - (1 << BITS - 2)

    def ordered(self) -> tuple[pa.Array, np.ndarray]:
        """Words by id (nothing for 0), and each id's rank in the order of phrases."""
        if self.sorted is None or len(self.sorted[1]) != len(self.hashes):
            words = pa.array([None, *self.ids], pa.large_string())
            rank = np.zeros(len(words), np.int64)
            spaced = pc.binary_join_element_wise(words, _NOTHING, _SPACE)
            order = pc.sort_indices(spaced, null_placement="at_start").to_numpy()
            rank[order] = np.arange(len(words))
            self.sorted = words, rank
        return self.sorted


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = (left ^ (left >> np.uint64(31))) * _PAIR + right
    return h ^ (h >> np.uint64(29))


class Filter:
    """Which words or pairs may be frequent: no frequent one is missing."""

    def __init__(self, bits: int):
        self.bits = bits
        self.words = np.zeros(1 << max(bits - 6, 0), np.uint64)

    def slots(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def __contains__(self, _):
        raise TypeError("ask has() with an array")

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = self.slots(h)
        return (self.words[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) != 0


def filter_of(frequent: DataFrame, size: int) -> Filter:
    """The bitmap of the words (size 1) or pairs (2) of ``frequent`` (lang, phrase).

    Tasks hash them and send each slot once; the driver puts together the bitmap, whose size
    is bounded by ``FILTER_BITS``.
    """
    number = frequent.count()
    out = Filter(min(FILTER_BITS, max(12, math.ceil(math.log2(SPARE * (number + 1))))))
    shape = Filter(out.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str, int] = {}
        for batch in batches:
            parts = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in seeds:
                    seeds[lang] = xxhash.xxh64_intdigest(lang.encode(), seed=42)
                parts.append([xxhash.xxh64_intdigest(w.encode(), seed=seeds[lang])
                              for w in phrase.split(" ")])
            if parts:
                h = np.array(parts, np.uint64)
                slot = shape.slots(h[:, 0] if size == 1 else pair_hash(h[:, 0], h[:, 1]))
                yield pa.RecordBatch.from_arrays([pa.array(slot >> 6), pa.array(slot & 63)],
                                                 names=["word", "bit"])

    filled = frequent.select("lang", "phrase").mapInArrow(run, "word long, bit long") \
        .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, cast(bit AS int)))").alias("bits"))
    for r in filled.toLocalIterator():
        out.words[r["word"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    return out


#: Sorted runs shrink well when a phrase is written as what differs from the one before.
SORTED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}

#: A node of a run: a phrase of ``size`` words and its occurrences there.
RUNS = "lang string, phrase string, size int, f long"


def runs(docs: DataFrame, shortest: int, longest: int, words: Filter | None = None,
         pairs: Filter | None = None) -> DataFrame:
    """``RUNS`` of (lang, text): phrases of ``shortest`` to ``longest`` words, counted by task.

    ``words`` and ``pairs``: phrases with a word or a neighbouring pair outside are left out.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((words, pairs))

    def emit(lang: str, vocabulary: Vocabulary, taken: tuple) -> Iterator[pa.RecordBatch]:
        """A subtree as a sorted run: its nodes from ``shortest`` on."""
        texts, rank = vocabulary.ordered()
        ids = unpack(taken[0], taken[1])[:, :longest]
        order = np.lexsort([rank[ids[:, k]] for k in reversed(range(longest))])
        ids, count = ids[order], taken[2][order]
        for size in range(shortest, longest + 1):
            deep = ids[:, size - 1] > 0
            own, n = ids[deep, :size], count[deep]
            if not len(own):
                continue
            first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]).any(1)]))
            sums, own = np.add.reduceat(n, first), own[first]
            for lo in range(0, len(own), 100_000):
                some = own[lo:lo + 100_000]
                parts = [texts.take(pa.array(some[:, k])) for k in range(size)]
                phrase = pc.binary_join_element_wise(*parts, _SPACE) if size > 1 else parts[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), phrase.cast(pa.string()),
                     pa.array(np.full(len(some), size, np.int32)),
                     pa.array(sums[lo:lo + 100_000])], names=["lang", "phrase", "size", "f"])

    def paths(ids: np.ndarray, follows: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
        """For each place the longest path from it that passes the filters."""
        words, pairs = shared.value
        hashes = np.array(vocabulary.hashes, np.uint64)
        if words is not None:
            good = words.has(hashes)[ids]
            follows = follows & good
            follows[:-1] &= good[1:]
        if pairs is not None:
            at = np.flatnonzero(follows)
            follows = follows.copy()
            follows[at] = pairs.has(pair_hash(hashes[ids[at]], hashes[ids[at + 1]]))
        n = len(ids)
        out = np.zeros((n, longest), np.int64)
        alive = np.ones(n, bool)
        for k in range(longest):
            out[:n - k, k] = np.where(alive[:n - k], ids[k:], 0)
            alive[:n - k] &= follows[k:]
            alive[max(n - k - 1, 0):] = False
        return out[out[:, shortest - 1] > 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[str, tuple[Vocabulary, HatTrie]] = {}
        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                langs = part.column(0).dictionary_encode()
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    own = part.column(1).filter(pc.equal(langs.indices, k))
                    found, follows = words_of(own)
                    if not len(found):
                        continue
                    if lang not in tries:
                        if len(tries) >= 64:  # very many languages: the oldest one leaves
                            old = next(iter(tries))
                            for taken in tries[old][1].drain():
                                yield from emit(old, tries[old][0], taken)
                            del tries[old]
                        tries[lang] = Vocabulary(lang), HatTrie()
                    vocabulary, trie = tries[lang]
                    ids = vocabulary.encode(found)
                    for taken in trie.add(paths(ids, follows, vocabulary)):
                        yield from emit(lang, vocabulary, taken)
                    if vocabulary.full():
                        for taken in trie.drain():
                            yield from emit(lang, vocabulary, taken)
                        tries[lang] = Vocabulary(lang), HatTrie()
        for lang, (vocabulary, trie) in tries.items():
            for taken in trie.drain():
                yield from emit(lang, vocabulary, taken)

    return docs.mapInArrow(run, RUNS)


def merged(parts: DataFrame) -> DataFrame:
    """Phrases with their occurrences in all runs: each range of phrases adds up its own."""
    return parts.repartitionByRange("lang", "phrase").groupBy("lang", "phrase", "size") \
        .agg(F.sum("f").alias("f"))


def _counted(docs: DataFrame, name: str, *args) -> tuple[DataFrame, DataFrame]:
    """(merged counts, not run yet; the written runs below them)."""
    found = written(runs(docs, *args), f"phrase-runs-{name}", **SORTED)
    return merged(found), found


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = DEPTH) \
        -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases with f >= ``least``, and (lang, n) of all words.

    Both are written tables.
    """
    spark = docs.sparkSession
    counts, found = _counted(docs, "words", 1, 1)
    size = written(found.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-n")
    tables = [written(counts.filter(F.col("f") >= least), "phrase-1")]
    discard(found)
    release(spark)
    words = filter_of(tables[0], 1)
    counts, found = _counted(docs, "pairs", 2, 2, words)
    tables.append(written(counts.filter(F.col("f") >= least), "phrase-2"))
    discard(found)
    release(spark)
    if longest > 2:
        counts, found = _counted(docs, "paths", 3, longest, words, filter_of(tables[1], 2))
        tables.append(written(counts.filter(F.col("f") >= least), "phrase-3"))
        discard(found)
        release(spark)
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out, size


def _exact(c: Column, digits: int) -> Column:
    return c.cast(f"decimal({digits},0)")


def scored(frequent: DataFrame, sizes: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n, score of every phrase of two or more words."""
    counts = frequent.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"),
                             F.col("f").alias("_f"))
    phrases = frequent.filter("size > 1").withColumn("w", F.split("phrase", " "))
    cuts = (phrases.select("lang", "phrase", "size", F.col("f").alias("a"), "w",
                           F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .withColumn("left", F.array_join(F.slice("w", F.lit(1), F.col("k")), " "))
            .withColumn("right", F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " "))
            .drop("w"))
    for side, name in (("left", "l"), ("right", "r")):
        part = counts.withColumnsRenamed({"_f": name})
        cuts = cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))) \
            .drop("_lang", "_part", side)
    cuts = cuts.join(sizes, "lang")
    score = F.expr("(cast(a AS decimal(16,0)) * cast(n AS decimal(18,0)) * cast(1000 AS decimal(4,0)))"
                   " div (cast(l AS decimal(16,0)) * cast(r AS decimal(16,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "size", "a", "n").agg(lowest).select(
        "lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def _inside_longer(frequent: DataFrame) -> DataFrame:
    """_lang, _part, _f of the phrases that a phrase of one more word holds, as often."""
    longer = frequent.filter("size > 2").withColumn("w", F.split("phrase", " "))
    part = lambda at: F.array_join(F.slice("w", F.lit(at), F.col("size") - 1), " ")
    return longer.select(F.col("lang").alias("_lang"), F.col("f").alias("_f"),
                         F.explode(F.array(part(1), part(2))).alias("_part"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = DEPTH,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                         F.col(text_col).cast("string").alias("text"))
    frequent, sizes = frequent_phrases(source, least, longest)
    longer = _inside_longer(frequent)
    kept = scored(frequent, sizes).join(
        longer, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part"))
        & (F.col("a") == F.col("_f")), "left_anti")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top) \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                "score")
