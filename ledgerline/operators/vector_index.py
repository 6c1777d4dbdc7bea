"""Exact vector search by a stored cluster index (V2, F15, T3) without a full scan.

Index. Unit vectors are assigned to the nearest of at most ``MAX_LISTS`` centroids
(k-means on a bounded sample). Within a list, rows lie in rings by their angle to the
centroid, and a ring with more than ``BLOCK_ROWS`` rows is dealt out over several blocks,
so that a list holding a third of all rows is no single group. ``members`` is stored in
(list, ring, block) order; ``blocks`` has each block's number of rows and
the smallest and largest angle to its centroid.

Search. Angles between unit vectors obey the triangle inequality: with t the angle
from query to centroid, no row of a block is nearer than max(t - high, low - t). First
every query visits its nearest blocks, as many as hold k rows. The k-th nearest row
found there bounds the answer: of all other blocks only those that may hold a nearer row
are visited. So the result is that of a full scan; what is compared follows how clustered the
vectors are. Neighbouring blocks form shelves of about ``SHELF_ROWS`` rows; a query goes to the
shelves that hold a block it visits, and a shelf and a chunk of its queries are
compared block by block as matrices. A query that keeps nearly all blocks open costs what
a scan costs: then vectors are shuffled once per ``QUERY_CHUNK`` queries, queries once per shelf.

Defined results: vectors that are null, of another length than the index or of length
zero have no direction: they are neither found nor find anything; fewer than k
vectors give all; equal distances are ordered by id; repeated ids are rows of
their own; an empty corpus finds nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import rounded
from ..functions.vectors import norm, ranking
from ..session import drop_scratch, fresh_path

MAX_LISTS = 1024
SAMPLE_ROWS = 50_000
#: Rings per right angle.
RINGS = 32
BLOCK_ROWS = 4096
#: Rows of neighbouring blocks, and queries, that meet in one task.
SHELF_ROWS, QUERY_CHUNK = 8192, 8192
#: Angles are compared with this slack, far above the error of a float sum.
SLACK = 1e-7
#: Distances by a matrix product are compared with this slack.
NEAR = 1e-9


def unit_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column (all of length ``dim``, none zero) as unit vectors."""
    x = np.asarray(column.flatten(), dtype=float).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class VectorIndex:
    """The index of (``id_col``, ``vec_col``) rows, stored in the shared scratch folder."""

    def __init__(self, corpus: DataFrame, id_col: str = "id", vec_col: str = "embedding",
                 lists: int | None = None, max_lists: int = MAX_LISTS,
                 sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS):
        self.id, self.vec, self.spark = id_col, vec_col, corpus.sparkSession
        self._paths: list[str] = []
        first = corpus.select(F.size(vec_col).alias("n")).filter("n > 0").first()
        self.dim = first["n"] if first else 1
        usable = self._usable(corpus, id_col, vec_col)
        self.rows = usable.count()
        wanted = lists or max(1, math.ceil(math.sqrt(self.rows) / 2))
        self.centroids = self._centroids(usable, min(wanted, max_lists), sample_rows)
        assigned = self._store(self._assigned(usable), "assigned")
        ring = F.floor(F.col("angle") * (2 * RINGS / math.pi)).cast("int")
        counts = assigned.groupBy("list", ring.alias("ring")).agg(F.count(F.lit(1)).alias("_n"))
        parts = F.greatest(F.ceil(F.col("_n") / block_rows), F.lit(1))
        placed = assigned.withColumn("ring", ring).join(counts, ["list", "ring"]) \
            .withColumn("block", F.pmod(F.xxhash64(id_col, vec_col), parts).cast("int")).drop("_n")
        place = ["list", "ring", "block"]
        self.members = self._store(placed.repartitionByRange(*place).sortWithinPartitions(*place),
                                   "members")
        self.blocks = self._store(self.members.groupBy(*place).agg(
            F.count(F.lit(1)).alias("rows"), F.min("angle").alias("low"),
            F.max("angle").alias("high")), "blocks")
        self._places, self.shelves = self._shelved()
        drop_scratch(self.spark, self._paths.pop(0))  # assigned, folded into the members

    def _shelved(self) -> tuple[tuple[np.ndarray, ...], DataFrame]:
        """The blocks' (list, low, high, rows, shelf) by number, and their numbers and shelves as a
        table. There are at most ``MAX_LISTS`` x 2 ``RINGS`` blocks and one per ``BLOCK_ROWS`` rows."""
        blocks = self.blocks.orderBy("list", "ring", "block").collect()
        of = lambda c, kind: np.array([r[c] for r in blocks], dtype=kind)
        rows = of("rows", np.int64)
        shelf = (np.cumsum(rows) - rows) // SHELF_ROWS
        table = self.spark.createDataFrame(
            [(r["list"], r["ring"], r["block"], i, int(s)) for i, (r, s) in enumerate(zip(blocks, shelf))],
            "list int, ring int, block int, number int, shelf int")
        return (of("list", np.int64), of("low", float), of("high", float), rows, shelf), table

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, f"vectors-{name}")
        df.write.parquet(path)
        self._paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete the index's tables; it can't be searched afterwards."""
        for path in self._paths:
            drop_scratch(self.spark, path)
        self._paths = []

    def _usable(self, df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
        """(id, vector, its length) of the rows with a direction."""
        length = norm(vec_col)
        return df.filter(F.size(vec_col) == self.dim).select(
            F.col(id_col).alias(self.id), F.col(vec_col).alias(self.vec), length.alias("length")) \
            .filter("length > 0 AND NOT isnan(length)")

    def _centroids(self, usable: DataFrame, lists: int, sample_rows: int) -> np.ndarray:
        """At most ``lists`` unit vectors: k-means of about ``sample_rows`` rows at most."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        if self.rows == 0:
            return np.eye(1, self.dim)
        share = min(1.0, sample_rows / self.rows)
        kept = F.pmod(F.xxhash64(self.id, self.vec), F.lit(1 << 30)) < int(share * (1 << 30))
        unit = F.transform(F.col(self.vec).cast("array<double>"), lambda x: x / F.col("length"))
        sample = usable.filter(kept | F.lit(share == 1.0)).select(
            array_to_vector(unit).alias("features"))
        if lists == 1:
            return np.eye(1, self.dim)
        model = KMeans(k=lists, maxIter=5, seed=1, initMode="random").fit(sample)
        found = np.array(model.clusterCenters())
        found = found[np.linalg.norm(found, axis=1) > 1e-9]
        return found / np.linalg.norm(found, axis=1, keepdims=True)

    def _assigned(self, usable: DataFrame) -> DataFrame:
        """Rows with the nearest centroid's list and the angle to it."""
        shared, dim = self.spark.sparkContext.broadcast(self.centroids), self.dim
        names = [*usable.columns, "list", "angle"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                near = unit_matrix(batch.column(1), dim) @ shared.value.T
                best = near.argmax(1)
                angle = np.arccos(np.clip(near[np.arange(len(best)), best], -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(best.astype(np.int32)), pa.array(angle)], names=names)

        schema = T.StructType([*usable.schema.fields, T.StructField("list", T.IntegerType()),
                               T.StructField("angle", T.DoubleType())])
        return usable.mapInArrow(run, schema)

    def _chosen(self, queries: DataFrame, k: int, again: bool) -> DataFrame:
        """A row per query and shelf, with the numbers of the blocks to visit there.

        At first the nearest blocks, as many as hold k rows; ``again`` all others that may hold
        a nearer row than ``bound``, but for those ``seen``."""
        shared, dim = self.spark.sparkContext.broadcast((self.centroids, *self._places)), self.dim
        names = ["shelf", "qid", "qvec", "qlength", "limit", "ask", "numbers", "rows"]

        def first(least: np.ndarray, turn: np.ndarray, rows: np.ndarray) -> np.ndarray:
            near = np.argpartition(least, min(k, len(least)) - 1)[:k]
            near = near[np.lexsort((near, turn[near], least[near]))]
            held = np.cumsum(rows[near])
            return near[np.concatenate([[0], held[:-1]]) < k]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centroids, lists, low, high, rows, shelf = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows if len(lists) else 0, 64):
                    part = batch.slice(at, 64)
                    turn = np.arccos(np.clip(unit_matrix(part.column(1), dim) @ centroids.T, -1, 1))
                    turn = turn[:, lists]
                    least = np.maximum(np.maximum(turn - high, low - turn), 0)
                    of, where, numbers, held = [], [], [], []
                    for q in range(part.num_rows):
                        if again:
                            found = np.setdiff1d(np.flatnonzero(
                                least[q] <= part.column(5)[q].as_py()), part.column(6)[q].as_py())
                        else:
                            found = first(least[q], turn[q], rows)
                        for s in np.unique(shelf[found]).tolist():
                            here = found[shelf[found] == s]
                            of.append(q)
                            where.append(s)
                            numbers.append(here.astype(np.int32))
                            held.append(int(rows[here].sum()))
                    if of:
                        taken = part.take(pa.array(of))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(where, pa.int32()), *taken.columns[:5],
                             pa.array(numbers, pa.list_(pa.int32())), pa.array(held, pa.int64())],
                            names=names)

        kind = queries.schema
        schema = T.StructType([
            T.StructField("shelf", T.IntegerType()), kind["qid"], kind["qvec"], kind["qlength"],
            kind["limit"], kind["ask"], T.StructField("numbers", T.ArrayType(T.IntegerType())),
            T.StructField("rows", T.LongType())])
        return queries.mapInArrow(run, schema)

    def search(self, queries: DataFrame, k: int = 10, qid: str = "qid", qvec: str = "qvec",
               round_to: int | None = 6, visited: list | None = None) -> DataFrame:
        """(qid, rank, id, distance): the k rows nearest to each query by cosine distance.

        ``queries`` should have unique qids: the rows of a repeated one find everything together, as
        often as they are many, each. ``visited`` receives two tables (qid, rows), the rows in
        the blocks that the first and the second visit read for each query.
        """
        asked = self._store(self._usable(queries, qid, qvec).withColumnsRenamed(
            {self.id: "qid", self.vec: "qvec", "length": "qlength"}).filter("qid IS NOT NULL")
            .withColumn("ask", F.monotonically_increasing_id()), "queries")
        again = asked.groupBy("qid").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
        chunks = max(1, math.ceil(asked.count() / QUERY_CHUNK))
        first = self._store(self._chosen(asked.select(
            "qid", "qvec", "qlength", F.lit(math.inf).alias("limit"), "ask"), k, False), "first")
        hits = self._store(self._nearest(self._compared(first, again, k, chunks), k), "hits")
        bound = hits.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("d")) \
            .select("qid", F.when(F.col("n") >= k, F.col("d")).otherwise(F.lit(math.inf)).alias("limit"),
                    F.when(F.col("n") >= k, F.acos(F.greatest(1 - F.col("d"), F.lit(-1.0)))
                           + SLACK).otherwise(F.lit(math.pi + 1)).alias("bound"))
        seen = first.groupBy("ask").agg(F.flatten(F.collect_list("numbers")).alias("seen"))
        second = self._store(self._chosen(asked.join(bound, "qid").join(seen, "ask").select(
            "qid", "qvec", "qlength", "limit", "ask", "bound", "seen"), k, True), "second")
        if visited is not None:
            visited += [t.groupBy("qid").agg(F.sum("rows").alias("rows")) for t in (first, second)]
        found = self._nearest(hits.select("qid", self.id, "distance").unionByName(
            self._compared(second, again, k, chunks)), k)
        shown = F.col("distance") if round_to is None else rounded("distance", round_to)
        return found.select("qid", F.col("rank").cast("long").alias("rank"), self.id,
                            shown.alias("distance"))

    def _compared(self, visits: DataFrame, again: DataFrame, k: int, chunks: int) -> DataFrame:
        """(qid, id, distance) of the rows in the blocks that queries visit, those that may be
        among the k nearest of a shelf.

        A shelf of blocks meets a chunk of the queries that visit it as matrices; distances
        of what is near enough are then summed number by number, so that equal vectors have equal
        ones. Every row of a qid that comes ``times`` finds its rows as often (``again``)."""
        dim, names = self.dim, ["qid", self.id, "distance"]

        def run(key: tuple, members: pa.Table, asked: pa.Table) -> pa.Table:
            members, asked = members.combine_chunks(), asked.combine_chunks()
            table = lambda c: np.asarray(c.combine_chunks().flatten(), dtype=float).reshape(-1, dim)
            out = ([], [], [])
            if members.num_rows and asked.num_rows:
                x, y = table(members["vec"]), table(asked["qvec"])
                xn, yn = members["length"].to_numpy(), asked["qlength"].to_numpy()
                xu, yu = x / xn[:, None], y / yn[:, None]
                limit = asked["limit"].to_numpy() + NEAR
                number = members["number"].to_numpy()
                order = np.argsort(number, kind="stable")
                starts = np.flatnonzero(np.diff(number[order], prepend=-1))
                visitors: dict[int, list[int]] = {}
                for q, numbers in enumerate(asked["numbers"].to_pylist()):
                    for n in numbers:
                        visitors.setdefault(n, []).append(q)
                best, found = np.full((len(y), k), np.inf), []
                for rows in np.split(order, starts[1:]):
                    wanted = np.array(visitors.get(int(number[rows[0]]), []), dtype=np.int64)
                    for at in range(0, len(wanted), 512):
                        q = wanted[at:at + 512]
                        distance = 1 - yu[q] @ xu[rows].T
                        best[q] = np.partition(np.concatenate([best[q], distance], axis=1),
                                               k - 1, axis=1)[:, :k]
                        near = distance <= np.minimum(best[q].max(1) + NEAR, limit[q])[:, None]
                        a, b = np.nonzero(near)
                        found.append((q[a], rows[b], distance[a, b]))
                most = np.minimum(best.max(1) + NEAR, limit)
                for q, r, d in found:
                    q, r = q[d <= most[q]], r[d <= most[q]]
                    total = np.zeros(len(q))
                    for j in range(dim):
                        total += x[r, j] * y[q, j]
                    out[0].append(q)
                    out[1].append(r)
                    out[2].append(1.0 - total / (xn[r] * yn[q]))
            q, r, d = (np.concatenate(c) if c else np.zeros(0) for c in out)
            return pa.Table.from_arrays(
                [asked["qid"].take(pa.array(q.astype(np.int64))),
                 members["id"].take(pa.array(r.astype(np.int64))), pa.array(d, pa.float64())],
                names=names)

        of = F.pmod(F.xxhash64("qid"), F.lit(chunks)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
        members = self.members.join(F.broadcast(self.shelves), ["list", "ring", "block"]).select(
            "shelf", copies.alias("chunk"), "number", F.col(self.id).alias("id"),
            F.col(self.vec).alias("vec"), "length")
        asked = visits.select("shelf", of.alias("chunk"), "qid", "qvec", "qlength", "limit", "numbers")
        schema = T.StructType([visits.schema["qid"], self.members.schema[self.id],
                               T.StructField("distance", T.DoubleType())])
        met = members.groupBy("shelf", "chunk").cogroup(asked.groupBy("shelf", "chunk")) \
            .applyInArrow(run, schema)
        times = F.sequence(F.lit(1), F.coalesce("times", F.lit(1)).cast("int"))
        return met.join(again, "qid", "left").select(*names, F.explode(times).alias("_time")).drop("_time")

    def _nearest(self, met: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("qid").orderBy(*ranking("distance", self.id))
        return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
