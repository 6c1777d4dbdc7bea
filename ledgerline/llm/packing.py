"""Sequence packing by power-of-two decomposition.

Each document is tokenised, closed with an end id and cut into pieces whose
lengths are powers of two (its length in binary; what exceeds ``max_len`` gives
further pieces of ``max_len``). Pieces of equal length share a bucket, and each
piece is a sequence by itself: no sequence crosses documents and none is
padded. A trainer draws batches from one bucket at a time.

Everything happens in the scan's own tasks: no shuffle, whatever the size or the
skew of the input, and a lost task is repeated from its split alone. Sequence
ids join the task's partition number and a counter, so they are unique and a
repeated task gives the same ones.

Defined results: null text counts as empty (only the end id); repeated rows are
packed once each; a null id is kept; no input rows give no pieces; other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm.common import row_slices

MAX_LEN = 4096
END_ID = 2
#: Runs of a text that a Python worker remembers, twice.
CACHE_WORDS = 300_000
#: Texts of about so many bytes are taken at once.
SLICE_BYTES = 1 << 22

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids", T.ArrayType(T.LongType(), False)),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("bucket", T.IntegerType()),
])


def piece_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Powers of two, longest first, that add up to ``n``; ``max_len`` is one too."""
    out = [max_len] * (n // max_len)
    rest, bit = n % max_len, max_len >> 1
    while bit:
        if rest & bit:
            out.append(bit)
        bit >>= 1
    return out


class WordIds:
    """Ids of texts, by way of their runs of bytes without ASCII white space.

    The tokenizer drops white space and its pattern never spans it, so a text's ids are
    those of its runs, one after the other. Most runs are a word and some punctuation,
    which the pattern takes apart as well, and case is folded: such a run has the ids
    of its word in lower case and those of its punctuation. Both runs and words are
    remembered, packed as little-endian 32-bit ids, in two generations of
    ``CACHE_WORDS``: when the younger one is full, it becomes the older one, so memory is
    bounded and what is in use stays. Unknown words are encoded many at a time; as
    each is one piece of the pattern, its ids end at an end-of-word token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                        "<u4")

    def _known(self, run: bytes) -> bytes | None:
        ids = self.young.get(run)
        if ids is None and (ids := self.old.get(run)) is not None:
            self.young[run] = ids
        return ids

    def _learn_words(self, words: list[bytes]) -> None:
        """Words of letters alone."""
        for k in range(0, len(words), 512):
            part = words[k:k + 512]
            ids = self._encode(b" ".join(part).decode())
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                data = ids.tobytes()
                for word, lo, hi in zip(part, [0, *ends[:-1].tolist()], ends.tolist()):
                    self.young[word] = data[4 * lo:4 * hi]
            else:  # a tokenizer whose words don't end so
                for word in part:
                    self.young[word] = self._encode(word.decode()).tobytes()

    def _learn(self, runs: list[bytes]) -> None:
        parts, words = {}, []
        for run in runs:
            if found := _WORD.fullmatch(run.decode()):
                parts[run] = word, _ = found[1].lower().encode(), found[2].encode()
                words.append(word)
            else:
                self.young[run] = self._encode(run.decode()).tobytes()
        self._learn_words([w for w in dict.fromkeys(words) if self._known(w) is None])
        for run, (word, tail) in parts.items():
            if tail and self._known(tail) is None:
                self.young[tail] = self._encode(tail.decode()).tobytes()
            self.young[run] = self.young[word] + (self.young[tail] if tail else b"")

    def ids(self, texts: pa.Array | list[bytes]) -> Iterator[bytes]:
        """The packed ids of each text (null: none).

        Arrow splits the texts and numbers their distinct runs, so only these are looked up."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        runs = lists.flatten().dictionary_encode()
        found = runs.dictionary.cast(pa.binary()).to_pylist()
        packed = list(map(self.young.get, found))
        if new := [i for i, ids in enumerate(packed) if ids is None]:
            self._learn([found[i] for i in new if self._known(found[i]) is None])
            for i in new:
                packed[i] = self.young[found[i]]
        data = np.frombuffer(b"".join(packed), "<u4")
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        starts, of_run = np.cumsum(sizes) - sizes, runs.indices.to_numpy()
        lengths = sizes[of_run]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        flat = data[np.arange(ends[-1]) + np.repeat(starts[of_run] - ends[:-1], lengths)]
        bounds = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])]
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield flat[lo:hi].tobytes()
        if len(self.young) >= CACHE_WORDS:
            self.old, self.young = self.young, {}


#: Letters whose lower case is one letter again and that don't combine, then punctuation
#: without apostrophes: two pieces of the tokenizer's pattern.
_WORD = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([.,;:!?#*$%&|]*)")

#: One memory for each Python worker, which Spark uses for many tasks.
_WORDS: dict[str, WordIds] = {}


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         max_len: int = MAX_LEN, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece (``PIECES``): its document, place, ids and sequence.

    ``bucket`` is the base-2 logarithm of the length. ``with_ids=False`` leaves
    the id lists out and keeps their checksum.
    """
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    fields = [f for f in PIECES if with_ids or f.name != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _WORDS:
            _WORDS[tokenizer_path] = WordIds(tokenizer_path)
        words = _WORDS[tokenizer_path]
        end = int(end_id).to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                rows: dict[str, list] = {f.name: [] for f in fields}
                for doc_id, ids in zip(part.column(0).to_pylist(), words.ids(part.column(1))):
                    ids += end
                    total, start = len(ids) // 4, 0
                    for n in piece_lengths(total, max_len):
                        piece = ids[4 * start:4 * (start + n)]
                        values = (doc_id, start, n, piece, zlib.crc32(piece), total, sequence, 0,
                                  n.bit_length() - 1)
                        for f, v in zip(PIECES, values):
                            if f.name in rows:
                                rows[f.name].append(v)
                        start, sequence = start + n, sequence + 1
                yield flush(rows)

    def flush(rows: dict[str, list]) -> pa.RecordBatch:
        columns = []
        for name, values in rows.items():
            if name == "ids":
                flat = np.frombuffer(b"".join(values), "<u4").astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(rows["length"], dtype=np.int64)])
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
            else:
                columns.append(pa.array(values, pa.int32() if name == "bucket" else pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=list(rows))

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, T.StructType(fields))


def padding_report(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Per bucket: sequences, tokens and padded tokens (none, by construction)."""
    return (pieces.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("sequences"),
                 F.sum("length").alias("tokens"))
            .withColumn("padding", F.col("sequences") * F.expr("shiftleft(1L, bucket)")
                        - F.col("tokens")))
