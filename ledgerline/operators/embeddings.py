"""Learned fixed-length vectors of texts (V1, V4, V5): a randomized SVD of TF-IDF rows.

With A the matrix of unit TF-IDF rows (documents by terms), the vectors of terms are the
first right singular vectors of A, and a document's vector is its row times these, scaled
to length one. They are found by block power iteration: a random sign matrix over
the terms is multiplied by A and by its transpose in turn.

A is stored once as cells: documents are dealt over groups of about ``CELL_ROWS`` by their
key, terms over blocks of at most about ``BLOCK_TERMS``, terms of similar document frequency
together; a cell is the part of a group and of at most ``SUM_ROWS`` terms of a block, term by
term. To multiply A, each block sends a group the vectors of the terms that it holds, once and
not for each document; the group adds up the vectors of its documents over all its cells. To
multiply the transpose, a group sends each block the sums of its documents for these terms.
A product goes through the blocks in up to ``PASSES`` parts of ``SENT_BYTES`` or more, and
each part's shuffle files are let go before the next. So neither side is ever held whole
by the driver, a task or a group, and the disk holds the cells, one set of vectors of terms
and of documents, and what one part sends. Between products the vectors are made orthogonal
by their Gram matrix, ``dim + extra`` numbers square: that and a few counts are all the
driver sees.

Terms in fewer than ``min_df`` documents, which link no two documents, and terms of
weight zero play no part. Unlike hashed buckets, unrelated terms don't share a coordinate.

Defined results: documents without a term that counts have the zero vector; null texts
are empty; equal texts have equal vectors up to the last digits; if the corpus has fewer than
``dim`` independent rows, the remaining coordinates are zero; the vectors depend on the corpus
alone (signs are hashes of terms, the sign of each coordinate is fixed by its largest
sum), not on partitions, up to rounding (vectors of terms travel as 32-bit floats, sums are of
64 bits).
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import batches_of, drop_scratch, fresh_path
from .text import TfIdf

DIM = 64
EXTRA = 8
ROUNDS = 2
MIN_DF = 2
#: Terms of a block; their places in it fit 15 bits, as blocks are dealt by hash.
BLOCK_TERMS, PLACE_BITS = 24_576, 15
#: Weights of a cell, about, and documents of a group.
CELL_WEIGHTS, CELL_ROWS = 40_000, 50_000
#: Vectors of a row that is sent, and weights expanded at once.
SUM_ROWS, STEP = 512, 1 << 12
#: A product sends about so many bytes at a time, in so many parts of the blocks at most.
SENT_BYTES, PASSES = 64 << 20, 6
#: Weights that are made into cells at a time.
PACK_WEIGHTS = 1_000_000
#: Rows of megabytes: a reader holds a row group, looked at after every few rows, and Python
#: gets so many bytes at a time.
ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1",
              "parquet.page.size.row.check.max": "4"}
BATCH_BYTES = 1 << 20

_CELL = "group int, block int, piece long, places binary, sizes binary, who binary, x array<int>"


def _arrays(matrix: np.ndarray, kind: type = np.float64) -> pa.Array:
    ends = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(matrix, kind).ravel()))


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table[name].combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _bytes(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def _one(names: list[str], *values) -> pa.RecordBatch:
    """A row; 32-bit whole numbers but for ``piece``."""
    kinds = {"piece": pa.int64(), "v": pa.binary(), "idf": pa.binary(), "places": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array([x], kinds.get(n, pa.int32())) for n, x in zip(names, values)], names=names)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row; binaries and lists without a copy."""
    for batch in batches:
        columns = list(zip(batch.schema.names, batch.columns))
        for i in range(batch.num_rows):
            yield {n: (None if not c[i].is_valid else c[i].as_buffer() if pa.types.is_binary(c.type)
                       else c[i].values.to_numpy() if pa.types.is_list(c.type) else c[i].as_py())
                   for n, c in columns}


def gram(vectors: DataFrame, width: int, kind: str) -> np.ndarray:
    """Sum of the outer products of the vectors in column ``v`` (matrices of ``kind`` as
    bytes): ``width`` numbers square."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for row in _stream(batches):
            x = np.frombuffer(row["v"], kind).reshape(-1, width).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([_arrays(total.reshape(1, -1))], names=["g"])

    parts = vectors.select("v").mapInArrow(run, "g array<double>")
    out = np.zeros(width * width)
    for r in parts.select(F.posexplode("g").alias("i", "x")).groupBy("i").agg(
            F.sum("x").alias("x")).collect():  # width * width rows
        out[r["i"]] = r["x"]
    return out.reshape(width, width)


def turned(vectors: DataFrame, matrix: np.ndarray) -> DataFrame:
    """(block, v, idf) with the vectors times ``matrix``."""
    shared = vectors.sparkSession.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _stream(batches):
            x = np.frombuffer(row["v"], "<f4").reshape(-1, len(shared.value)) @ shared.value
            yield _one(["block", "v", "idf"], row["block"], _bytes(x, "<f4"), row["idf"].to_pybytes())

    return vectors.select("block", "v", "idf").mapInArrow(run, "block int, v binary, idf binary")


def orthogonal(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(W, eigenvalues): Z W has orthonormal columns for Z with Gram matrix ``g``; columns
    of Z's null space become zero, the largest eigenvalues come first."""
    values, vectors = np.linalg.eigh((g + g.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    good = values > max(values[0], 0) * 1e-10
    scale = np.where(good, 1 / np.sqrt(np.where(good, values, 1)), 0)
    return vectors * scale, np.where(good, values, 0)


def _run_sums(at: np.ndarray, rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Not more than ``STEP`` rows at a time: sums of ``rows(lo, hi)`` over runs of equal ``at``."""
    for lo in range(0, len(at), STEP):
        part = at[lo:lo + STEP]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        yield part[starts], np.add.reduceat(rows(lo, lo + len(part)), starts)


class LatentVectors:
    """Vectors of the terms and documents of a ``TfIdf`` index.

    ``spent``: the index is not searched afterwards, so its counts go once they are cells."""

    def __init__(self, index: TfIdf, dim: int = DIM, extra: int = EXTRA, rounds: int = ROUNDS,
                 min_df: int = MIN_DF, spent: bool = False):
        self.index, self.key, self.spark, self.dim = index, index.key, index.spark, dim
        self._paths: list[str] = []
        self._width = width = dim + extra
        self._key_type = index.norms.schema[self.key].dataType.simpleString()
        self._groups = max(1, math.ceil(index.n_docs / CELL_ROWS))
        self._release()
        self.places = self._store(self._placed(min_df), "places")
        self.members = self._store(index.norms.filter(F.col(self.key).isNotNull()).groupBy(
            self._group().alias("group")).agg(F.sort_array(F.collect_list(F.struct(
                F.col(self.key).alias("id"), "norm"))).alias("all")).select(
            "group", F.col("all.id").alias("ids"), F.col("all.norm").alias("norms")), "members")
        self._release()
        self.cells = self._cut()
        if spent:
            index.drop_counts()
        sent = self.cells.agg(F.sum(F.octet_length("places"))).first()[0] or 0
        self._passes = max(1, min(PASSES, math.ceil(sent // 2 * width * 4 / SENT_BYTES)))
        terms = self._signs()
        self.idfs = self._store(terms.select("block", "idf"), "idfs")
        raw = None
        for _ in range(rounds):
            documents = self._of_documents(terms, squared=True)
            self._drop(raw)
            raw = self._of_terms(documents)
            self._drop(documents)
            terms = turned(raw, orthogonal(gram(raw, width, "<f4"))[0])
        # Within the space found, the directions in the order of A's singular values.
        documents = self._of_documents(terms)
        values, turn = np.linalg.eigh(gram(documents, width, "<f8"))
        turn = turn[:, ::-1][:, :dim]
        turn = turn * np.where(values[::-1][:dim] > max(values[-1], 0) * 1e-10, 1.0, 0.0)
        turn = turn * np.where(turn[np.abs(turn).argmax(0), np.arange(dim)] < 0, -1.0, 1.0)
        self.terms = self._by_place(turned(terms, turn)).join(
            self.places.select("place", "term"), "place").select(
            "term", array_to_vector("v").alias("v"))
        self.documents = self._unit(self._by_key(documents, turn), self.key)
        self._drop(self.cells)
        self._release()

    def _store(self, df: DataFrame, name: str, onto: str | None = None,
               by: tuple[str, ...] = (), **options: str) -> DataFrame:
        path = onto or fresh_path(self.spark, f"latent-{name}")
        with batches_of(self.spark, BATCH_BYTES):
            df.write.mode("append").options(**options).parquet(path, partitionBy=[*by])
        if onto is None:
            self._paths.append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def _drop(self, table: DataFrame | None) -> None:
        if table is not None:
            drop_scratch(self.spark, table.scratch_path)
            self._paths.remove(table.scratch_path)

    def _release(self) -> None:
        """Shuffle files of the steps before go once the driver has collected its garbage; the
        scheduler holds those of the last job until another has run."""
        self.spark.range(1).count()
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def _group(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self._groups)).cast("int")

    def release(self) -> None:
        """Delete the tables; those of ``TfIdf`` stay."""
        for path in self._paths:
            drop_scratch(self.spark, path)
        self._paths = []

    def _placed(self, min_df: int) -> DataFrame:
        """(term, df, place): the terms that count, numbered by block and place in it.

        Blocks hold terms whose df has the same number of binary digits, or several such
        classes where these are small."""
        known = self.index.df.filter((F.col("df") >= min_df) & (F.col("df") < self.index.n_docs))
        digits = F.length(F.bin("df"))
        first, last, room = [], 0, 0
        for r in known.groupBy(digits.alias("digits")).count().orderBy(F.desc("digits")).collect():
            count = -(-r["count"] // BLOCK_TERMS)  # at most 63 rows
            if r["count"] <= room:
                first.append((r["digits"], last - 1, 1))
                room -= r["count"]
            else:
                first.append((r["digits"], last, count))
                last, room = last + count, BLOCK_TERMS - r["count"]
        classes = F.broadcast(self.spark.createDataFrame(
            first, "digits int, first long, blocks long"))
        known = known.withColumn("digits", digits).join(classes, "digits").withColumn(
            "block", F.col("first") + F.pmod(F.xxhash64("term"), F.col("blocks")))
        number = F.row_number().over(Window.partitionBy("block").orderBy("term")) - 1
        return known.withColumn("number", number).select(
            "term", "df", (F.shiftleft("block", PLACE_BITS) + F.col("number")).alias("place"))

    def _cut(self) -> DataFrame:
        """``_CELL`` rows: ``places`` of terms within the block, ``sizes``: documents of each,
        ``who``: the documents' numbers within the group, ``x``: how often a term occurs."""
        known = self.places.select("term", "place")
        rows = self.index.postings.select(self.key, "term", "tf").filter(F.col(self.key).isNotNull())
        columns = [self.key, "place", F.col("tf").cast("int").alias("tf")]
        if self.index.frequent is None:
            return self._packed(rows.join(known, "term").select(*columns))
        # As for the weights: most postings meet their terms without a shuffle.
        common = F.broadcast(self.index.frequent.select("term"))
        placed = F.broadcast(known.join(common, "term", "left_semi"))
        rare = known.join(common, "term", "left_anti")
        cells = self._packed(rows.join(placed, "term").select(*columns))
        self._release()
        return self._packed(rows.join(common, "term", "left_anti").join(rare, "term").select(*columns),
                            cells.scratch_path)

    def _packed(self, weights: DataFrame, onto: str | None = None) -> DataFrame:
        """The cells of ``weights`` (key, place, tf), stored."""
        bits, pieces, most = PLACE_BITS, SUM_ROWS, CELL_WEIGHTS
        names = [f.split(" ")[0] for f in _CELL.split(", ")]

        def run(cells: pa.Table, members: pa.Table) -> pa.Table:
            rows: list[tuple] = []
            if cells.num_rows:
                group = cells["group"][0].as_py()
                at = pc.index_in(_column(cells, "id"), value_set=_column(members, "id")).to_numpy()
                who = _column(members, "who").to_numpy()[at]
                place, tf = _column(cells, "place").to_numpy(), _column(cells, "tf").to_numpy()
                order = np.lexsort((who, place))
                who, place, tf = who[order], place[order], tf[order]
                kind = "<u2" if who.max() < 1 << 16 else "<u4"
                start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                term, ends = place[start], np.append(start, len(place))
                block = term >> bits
                first = np.searchsorted(block, block)  # the block's first term here
                marks = np.stack([block, (np.arange(len(term)) - first) // pieces,
                                  (start - start[first]) // most])
                cuts = np.flatnonzero((np.diff(marks) != 0).any(0)) + 1
                for lo, hi in zip([0, *cuts], [*cuts, len(term)]):
                    a, b = ends[lo], ends[hi]
                    rows.append((group, int(block[lo]), int(term[lo]),
                                 _bytes(term[lo:hi] & ((1 << bits) - 1), "<u2"),
                                 _bytes(np.diff(ends[lo:hi + 1]), "<i4"),
                                 _bytes(who[a:b], kind), tf[a:b]))
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 3, pa.list_(pa.int32())]
            return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        counted = self.index.counts.agg(F.sum(F.size("tfs"))).first()[0] or 0
        parts = max(1, math.ceil(counted / self._groups / PACK_WEIGHTS))
        left = weights.select(self._group().alias("group"), F.col(self.key).alias("id"), "place", "tf",
                              F.pmod(F.xxhash64("place"), F.lit(parts)).alias("part"))
        right = self.members.select("group", F.posexplode("ids").alias("who", "id"),
                                    F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
                                    .alias("all")).withColumn("part", F.explode("all"))
        cells = left.groupBy("group", "part").cogroup(
            right.select("group", "part", "id", "who").groupBy("group", "part")).applyInArrow(run, _CELL)
        return self._store(cells.withColumn("part", F.pmod("block", F.lit(PASSES)).cast("int")), "cells",
                           onto, ("part",), **ROW_GROUPS)

    def _signs(self) -> DataFrame:
        """(block, v, idf): the terms' random signs, from their hashes, and 64-bit weights."""
        width, bits = self._width, PLACE_BITS
        bit = lambda j: F.when(
            F.pmod(F.xxhash64(F.col("term"), j), F.lit(2)) == 0, F.lit(1.0)).otherwise(F.lit(-1.0))

        def run(table: pa.Table) -> pa.Table:
            place = _column(table, "place").to_numpy()
            order = np.argsort(place)  # numbered without a gap
            v = _column(table, "v").flatten().to_numpy().reshape(-1, width)[order]
            idf = _column(table, "idf").to_numpy()[order]
            return pa.table({"block": pa.array([int(place[0]) >> bits], pa.int32()),
                             "v": pa.array([_bytes(v, "<f4")], pa.binary()),
                             "idf": pa.array([_bytes(idf, "<f8")], pa.binary())})

        signs = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), bit).cast("array<tinyint>")
        idf = F.log(F.lit(self.index.n_docs) / F.col("df"))
        return self.places.select("place", signs.alias("v"), idf.alias("idf"),
                                  F.shiftright("place", bits).alias("block")).groupBy("block") \
            .applyInArrow(run, "block int, v binary, idf binary")

    def _parts(self) -> Iterator[tuple[DataFrame, Column]]:
        """Parts of the cells, and the condition that their blocks meet; shuffle files of the
        part before go."""
        for n in range(self._passes):
            self._release()
            yield self.cells.filter(F.pmod("part", F.lit(self._passes)) == n), \
                F.pmod(F.pmod("block", F.lit(PASSES)), F.lit(self._passes)) == n

    def _sent(self, terms: DataFrame, cells: DataFrame) -> DataFrame:
        """(group, piece, v): for each cell the vectors of its terms times their weights, out
        of those of its block."""
        width = self._width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, of = None, None
            for row in _stream(batches):
                if row["group"] < 0:
                    block, of = row["block"], np.frombuffer(row["v"], "<f4").reshape(-1, width)
                    of = of * np.frombuffer(row["idf"], "<f8")[:len(of), None]
                elif row["block"] == block:
                    places = np.frombuffer(row["places"], "<u2")
                    yield _one(["group", "piece", "v"], row["group"], row["piece"], _bytes(of[places], "<f4"))

        none = F.lit(None).cast("binary")
        rows = terms.select("block", F.lit(-1).alias("group"), F.lit(-1).cast("long").alias("piece"),
                            none.alias("places"), "v", "idf").unionByName(
            cells.select("block", "group", "piece", "places", none.alias("v"), none.alias("idf")))
        return rows.repartition("block").sortWithinPartitions("block", "group").mapInArrow(
            run, "group int, piece long, v binary")

    def _met(self, cells: DataFrame, *others: DataFrame) -> DataFrame:
        """Rows of each group together: ``others`` (group, piece, kind, v) and cells, by piece
        and kind."""
        empty = {n: F.lit(None).cast(k) for n, k in (
            ("places", "binary"), ("sizes", "binary"), ("who", "binary"), ("x", "array<int>"))}
        rows = cells.select("group", "piece", F.lit(2).alias("kind"), F.lit(None).cast("binary").alias("v"),
                            *empty)
        for other in others:
            rows = rows.unionByName(other.select("group", "piece", "kind", "v").withColumns(empty))
        return rows.repartition("group").sortWithinPartitions("group", "piece", "kind")

    def _norms(self) -> DataFrame:
        """(group, piece, kind, v): the first row of each group, its documents' norms."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _stream(batches):
                yield _one(["group", "piece", "kind", "v"], row["group"], -2, 0, _bytes(row["norms"], "<f8"))

        return self.members.select("group", "norms").mapInArrow(
            run, "group int, piece long, kind int, v binary")

    def _of_documents(self, terms: DataFrame, squared: bool = False) -> DataFrame:
        """(group, piece, kind, v): A times the vectors of terms (block, v), ``squared``: over
        the norms again; a group's vectors in rows of ``SUM_ROWS``, numbered by ``kind``."""
        width, step = self._width, SUM_ROWS
        names = ["group", "piece", "kind", "v"]

        def added(last: bool):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                group = norms = out = of = None

                def done() -> Iterator[pa.RecordBatch]:
                    if group is None:
                        return
                    if last:
                        good = norms > 0
                        scale = np.where(good, norms, 1.0) ** (2 if squared else 1)
                        out[:] = np.where(good[:, None], out / scale[:, None], 0.0)
                    for k, lo in enumerate(range(0, len(out), step)):
                        yield _one(names, group, -1, k, _bytes(out[lo:lo + step], "<f8"))

                for row in _stream(batches):
                    if row["piece"] == -2:
                        yield from done()
                        group, norms = row["group"], np.frombuffer(row["v"], "<f8")
                        out = np.zeros((len(norms), width))
                    elif row["piece"] == -1:
                        v = np.frombuffer(row["v"], "<f8").reshape(-1, width)
                        out[row["kind"] * step:][:len(v)] = v
                    elif row["kind"] == 1:
                        of = np.frombuffer(row["v"], "<f4").reshape(-1, width).astype(float)
                    else:
                        x = row["x"]
                        who = np.frombuffer(row["who"], f"<u{len(row['who']) // len(x)}")
                        at = np.repeat(np.arange(len(of)), np.frombuffer(row["sizes"], "<i4"))
                        order = np.argsort(who, kind="stable")
                        at, who, x = at[order], who[order], x[order].astype(float)
                        for found, sums in _run_sums(
                                who, lambda lo, hi: of[at[lo:hi]] * x[lo:hi, None]):
                            out[found] += sums
                yield from done()

            return run

        parts, so_far = [*range(self._passes)], None
        for n, (cells, own) in zip(parts, self._parts()):
            sent = self._sent(terms.filter(own), cells).withColumn("kind", F.lit(1))
            before = [self._norms()] + ([] if so_far is None else [so_far])
            found = self._met(cells, sent, *before).mapInArrow(
                added(n == parts[-1]), "group int, piece long, kind int, v binary")
            found = self._store(found, "documents", **ROW_GROUPS)
            self._drop(so_far)
            so_far = found
        return so_far

    def _of_terms(self, documents: DataFrame) -> DataFrame:
        """(block, v, idf): the cells, transposed, times the vectors of documents."""
        width, bits, step = self._width, PLACE_BITS, SUM_ROWS

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of = None
            for row in _stream(batches):
                if row["piece"] == -2:
                    of = np.zeros((len(row["v"]) // 8, width))
                elif row["piece"] == -1:
                    v = np.frombuffer(row["v"], "<f8").reshape(-1, width)
                    of[row["kind"] * step:][:len(v)] = v
                else:
                    x, sizes = row["x"], np.frombuffer(row["sizes"], "<i4")
                    who = np.frombuffer(row["who"], f"<u{len(row['who']) // len(x)}")
                    out = np.zeros((len(sizes), width))
                    for found, sums in _run_sums(np.repeat(np.arange(len(sizes)), sizes),
                                                 lambda lo, hi: of[who[lo:hi]] * x[lo:hi, None]):
                        out[found] += sums
                    yield _one(["block", "places", "v"], row["piece"] >> bits,
                               row["places"].to_pybytes(), _bytes(out, "<f4"))

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, idf, out, size = None, None, np.zeros((1 << bits, width)), 0

            def done() -> Iterator[pa.RecordBatch]:
                if size:
                    yield _one(["block", "v", "idf"], block, _bytes(
                        out[:size] * idf[:size, None], "<f4"), _bytes(idf, "<f8"))

            for row in _stream(batches):
                if row["places"] is None:
                    yield from done()
                    block, idf, size = row["block"], np.frombuffer(row["v"], "<f8").copy(), 0
                    out[:] = 0
                else:
                    places = np.frombuffer(row["places"], "<u2")
                    out[places] += np.frombuffer(row["v"], "<f4").reshape(-1, width)
                    size = max(size, int(places.max()) + 1)
            yield from done()

        raw = None
        for cells, own in self._parts():
            partial = self._met(cells, self._norms(), documents).mapInArrow(
                run, "block int, places binary, v binary")
            first = self.idfs.filter(own).select("block", F.lit(None).cast("binary").alias("places"),
                                                 F.col("idf").alias("v"))
            found = partial.unionByName(first).repartition("block").sortWithinPartitions(
                "block", F.col("places").isNotNull()).mapInArrow(
                summed, "block int, v binary, idf binary")
            raw = self._store(found, "raw", raw and raw.scratch_path, **ROW_GROUPS)
        return raw

    def _by_place(self, terms: DataFrame) -> DataFrame:
        """(place, v) of the terms' vectors (block, v)."""
        width, bits = self.dim, PLACE_BITS

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _stream(batches):
                v = np.frombuffer(row["v"], "<f4").reshape(-1, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((row["block"] << bits) + np.arange(len(v))), _arrays(v)], names=["place", "v"])

        return terms.mapInArrow(run, "place long, v array<double>")

    def _by_key(self, documents: DataFrame, turn: np.ndarray) -> DataFrame:
        """(key, v) of the documents' vectors times ``turn``."""
        shared, key, width = self.spark.sparkContext.broadcast(turn), self.key, self._width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    v = np.frombuffer(batch.column(1)[i].as_buffer(), "<f8").reshape(-1, width)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[i].values, _arrays(v @ shared.value)], names=[key, "v"])

        ids = F.slice("ids", F.col("kind") * F.lit(SUM_ROWS) + F.lit(1), F.lit(SUM_ROWS))
        return documents.join(self.members, "group").select(ids.alias("ids"), "v").mapInArrow(
            run, f"`{key}` {self._key_type}, v array<double>")

    def _unit(self, vectors: DataFrame, key: str) -> DataFrame:
        """(key, embedding) of length one."""
        length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        return vectors.withColumn("n", length).select(
            key, F.transform("v", lambda x: F.when(F.col("n") > 0, x / F.col("n")).otherwise(0.0))
            .alias("embedding"))

    def with_vectors(self, docs: DataFrame) -> DataFrame:
        """``docs`` (unique keys) with their ``embedding``; zero where no term counts."""
        zero = F.array_repeat(F.lit(0.0), self.dim)
        return docs.join(self.documents, self.key, "left").withColumn(
            "embedding", F.coalesce("embedding", zero))

    def encode(self, queries: DataFrame) -> DataFrame:
        """(qid, qvec): query texts in the documents' space; those without a term are left out."""
        asked = self.index.encode_queries(queries).filter("qw > 0").join(self.terms, "term")
        summed = asked.groupBy("qid").agg(Summarizer.sum(F.col("v"), F.col("qw")).alias("v"))
        return self._unit(summed.select("qid", vector_to_array("v").alias("v")), "qid") \
            .withColumnRenamed("embedding", "qvec")
