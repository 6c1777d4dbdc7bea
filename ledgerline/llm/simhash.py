"""SimHash near-duplicates: block banding, and a table of pivot distances within places.

Fingerprints: 64-bit SimHash over three-word shingles, hashed with XXH64.

Links: two fingerprints link if at most ``MAX_BITS`` bits differ. Candidates are found
by block banding, not by pivots: of ``BLOCKS`` blocks of bits at most ``MAX_BITS`` hold a
flipped bit, so linked fingerprints agree on some ``BLOCKS - MAX_BITS`` whole blocks and
meet there. Random pivots can't bring pairs together without comparing all: one
distance keeps almost half of all random pairs. The Hamming distances of each
fingerprint to ``PIVOTS`` random reference fingerprints are computed once and go with
it. A flipped bit moves each distance by one, so linked fingerprints differ by at most
``MAX_BITS`` in every coordinate. A meeting place is ordered by the first coordinate,
and each fingerprint is paired only with those that follow within ``MAX_BITS`` there;
the maximum difference over the other coordinates discards pairs next, and the rest
is verified by counting differing bits.

No pair is lost and no group is unbounded: a meeting place with more than
``CROWDED`` fingerprints is dealt out again over finer groups (``FINE_BLOCKS``),
which fix all but 12 bits, so at most 4096 distinct fingerprints meet there.
Within a place, links are reduced to one link per fingerprint to the smallest
fingerprint it reaches there, so copies and near copies are never expanded into pairs.

Defined results: null, empty or wordless texts have fingerprint zero, linked like
any other; repeated rows share their component; a null id stands in a component
but never names it while another id is there (a component of null ids alone has a
null name); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.common import discard, text_hash, written
from ledgerline.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Blocks of the first meeting: all but MAX_BITS of them must agree (20 places of 32 bits).
BLOCKS = 6
#: A meeting place with more fingerprints is dealt out over finer groups.
CROWDED = 256
#: Finer groups: the bits that the first meeting left free, in this many blocks (56 places).
FINE_BLOCKS = 8
#: Shingles hashed at once, so a long text needs no more memory than a short one.
CHUNK = 1 << 16
PIVOTS = 48


# --- fingerprints -------------------------------------------------------------------

def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    n = len(words)
    if n == 0:
        return 0
    if n < size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    count, ones = n - size + 1, np.zeros(64, np.int64)
    for lo in range(0, count, CHUNK):
        hi = min(count, lo + CHUNK)
        shingles = map(b" ".join, zip(*(words[lo + k:hi + k] for k in range(size))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), ">u8", hi - lo)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp (the fingerprint's bits as a signed long) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(x.as_buffer().to_pybytes(), size) if x.is_valid else 0
                 for x in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))],
                names=["doc_id", "text_hash", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         text_hash(F.col(text_col)).alias("text_hash"),
                         F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, text_hash long, fp long")


# --- meeting places -------------------------------------------------------------------

def _blocks(bits: list[int], count: int) -> list[int]:
    """Masks of ``count`` blocks that share ``bits`` out."""
    return [sum(1 << b for b in bits[k::count]) for k in range(count)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


COARSE = [sum(c) for c in combinations(_blocks(list(range(64)), BLOCKS), BLOCKS - MAX_BITS)]


def _fine(coarse: int) -> list[int]:
    """Masks within which a crowded place of mask ``coarse`` is dealt out again."""
    free = [b for b in range(64) if not coarse >> b & 1]
    return [coarse | sum(c)
            for c in combinations(_blocks(free, FINE_BLOCKS), FINE_BLOCKS - MAX_BITS)]


def _pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed, spread evenly by XXH64."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % k, SEED) for k in range(count)],
                    np.uint64)


def with_pivots(classes: DataFrame) -> DataFrame:
    """Adds ``first``, the distance to the first pivot, and ``table``, a byte for each pivot."""
    pivots = _pivots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column(0)).view(np.uint64)
            table = np.bitwise_count(fp[:, None] ^ pivots).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(table[:, 0]),
                 pa.array([row.tobytes() for row in table], pa.binary())],
                names=["fp", "node", "first", "table"])

    return classes.select("fp", "node").mapInArrow(
        run, "fp long, node long, first byte, table binary")


def _masks(masks: list[int]) -> Column:
    return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])


def _meet(rows: DataFrame) -> DataFrame:
    """Adds mask and key, the fingerprint's own bits there: one row per coarse place."""
    return rows.select("*", F.explode(_masks(COARSE)).alias("mask")) \
        .withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


# --- links within a place ----------------------------------------------------------------

def _spanning(place: np.ndarray, fp: np.ndarray, table: np.ndarray,
              max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node reached in its place).

    Rows are sorted by place and, within it, by the first column of ``table``.
    """
    n, node = len(fp), fp.view(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if n else \
        np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, n))
    left = np.repeat(starts + sizes, sizes) - np.arange(n) - 1  # rows after this one in its place
    first = table[:, 0]
    busy = np.flatnonzero(left > 0)
    a_all, b_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = 1
    while len(busy):
        other = busy + step
        inside = first[other] - first[busy] <= max_bits
        busy, other = busy[inside], other[inside]  # those further on are further off
        near = np.ones(len(busy), bool)
        for c in range(0, table.shape[1], 8):  # most pairs go with the first coordinates
            at = np.flatnonzero(near)
            if not len(at):
                break
            gap = np.abs(table[busy[at], c:c + 8] - table[other[at], c:c + 8]).max(1)
            near[at] = gap <= max_bits
        at = np.flatnonzero(near)
        at = at[np.bitwise_count(fp[busy[at]] ^ fp[other[at]]) <= max_bits]
        a_all.append(busy[at])
        b_all.append(other[at])
        step += 1
        busy = busy[left[busy] >= step]
    a, b = np.concatenate(a_all), np.concatenate(b_all)
    # Rows of a place reach their smallest row: minimum over links, then over roots.
    order = node.copy()
    while True:
        low = np.minimum(order[a], order[b])
        before = order.copy()
        np.minimum.at(order, a, low)
        np.minimum.at(order, b, low)
        if (order == before).all():
            break
    moved = np.flatnonzero(order != node)
    return node[moved], order[moved]


def _links(met: DataFrame, max_bits: int) -> DataFrame:
    """Links of rows (mask, key, fp, first, table); a place holds few enough rows for one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [np.asarray(batch.column(i)) for i in range(3)]
            now.append(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int8)
                       .reshape(batch.num_rows, -1))
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            # The last place may go on in the next batch.
            same = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            stop = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = [x[stop:] for x in now]
            if stop:
                yield found([x[:stop] for x in now])
        if held is not None:
            yield found(held)

    def found(cols: list[np.ndarray]) -> pa.RecordBatch:
        mask, key, fp, table = cols
        new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
        a, b = _spanning(np.cumsum(new), fp.view(np.uint64), table, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                          names=["a", "b"])

    dealt = (met.repartition("mask", "key").sortWithinPartitions("mask", "key", "first", "fp")
             .select("mask", "key", "fp", "table"))
    return dealt.mapInArrow(run, "a long, b long")


def link(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, node, component, root: each distinct fingerprint and its component.

    The graph's nodes are the fingerprints. ``component`` is the smallest one reached;
    ``node`` and ``root`` are the smallest document ids of the fingerprint and of the
    component, null where all ids are. Components that share an id stay apart.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the meeting places are built for at most {MAX_BITS} bits")
    classes = written(with_pivots(prints.groupBy("fp").agg(F.min("doc_id").alias("node"))),
                      "simhash-classes")
    met = _meet(classes.select("fp", "first", "table"))
    crowded = written(met.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"))
                      .filter(F.col("n") > 1), "simhash-places")
    fine = F.create_map(*[x for m in COARSE for x in (F.lit(_signed(m)).cast("long"),
                                                      _masks(_fine(m)))])
    places = F.when(F.col("n") > CROWDED, fine[F.col("mask")]).otherwise(F.array("mask"))
    dealt = (met.join(crowded, ["mask", "key"])
             .select("fp", "first", "table", F.explode(places).alias("mask"))
             .withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))))
    links = written(_links(dealt, max_bits).distinct(), "simhash-links")
    found = components(links).withColumnRenamed("node", "fp")
    discard(crowded, links)
    # Fingerprints without links name themselves; only the others meet their component's label.
    linked = written(classes.select("fp", "node").join(found, "fp", "left"), "simhash-linked")
    labels = (linked.filter("component IS NOT NULL").groupBy("component")
              .agg(F.min("node").alias("label")))
    alone = linked.filter("component IS NULL").select(
        "fp", "node", F.col("fp").alias("component"), F.col("node").alias("root"))
    return linked.join(labels, "component").select(
        "fp", "node", "component", F.col("label").alias("root")).unionByName(alone)


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, size: int = SHINGLE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per row of ``docs``."""
    prints = written(fingerprints(docs, id_col, text_col, size), "simhash-prints")
    classes = link(prints, max_bits)
    return (prints.join(classes.select("fp", "root"), "fp", "left")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.col("root").alias("component_id")))



def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, size: int = SHINGLE) -> DataFrame:
    """Of each component one row of ``docs`` (columns doc_id and text): that of the smallest id.

    Only ids and hashes travel until the keepers are known; then each text is moved
    once, to meet its id and hash. Where that id stands on several rows of the component,
    the one with the smallest hash of its text, then of its row, stays; a component of
    null ids keeps one row by the same order. Unlike texts under one id are of different
    components and stay.
    """
    prints = written(fingerprints(docs, size=size), "simhash-prints")
    roots = (link(prints, max_bits).filter(F.col("node").eqNullSafe(F.col("root")))
             .select("fp", "component", "root"))
    keepers = (prints.join(roots, "fp").filter(F.col("doc_id").eqNullSafe(F.col("root")))
               .groupBy("component").agg(F.min("text_hash").alias("_keep_hash"),
                                         F.max("doc_id").alias("_keep_id")).drop("component"))
    met = docs.join(keepers, docs["doc_id"].eqNullSafe(F.col("_keep_id"))
                    & (text_hash(docs["text"]) == F.col("_keep_hash")))
    plain = [docs[c] for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    first = Window.partitionBy("_keep_id", "_keep_hash").orderBy(F.xxhash64(*plain))
    return (met.withColumn("_keep_rank", F.row_number().over(first)).filter("_keep_rank = 1")
            .select(*docs.columns))
