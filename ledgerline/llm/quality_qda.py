"""Quality classifier: regularised quadratic discriminant over document statistics.

Every text becomes ``STATISTICS``: counts and shares of its bytes, words, word pairs and
lines, brought near a bell shape (logarithms of counts, arc sines of the roots of
shares). Each class of the labelled rows gets a mean and a covariance. The covariance
is shrunk twice, towards that of all classes together (``pool``) and towards a
multiple of the identity (``ridge``), so that it has an inverse even where a statistic
never varies within a class. A document's score comes from the difference of the two
log densities, that is of the squared Mahalanobis distances and log determinants;
the Cholesky factors of the two covariances are computed once and kept.

Learning uses every labelled row outside the held-out fold. Tasks add up products of
statistics per class and part; only these sums (about 300 numbers for each of
2 x ``PARTS``) reach the driver, whatever the number of rows. ``pool``, ``ridge`` and
the ``heat`` that divides the log-density difference are those with the smallest
logarithmic loss when each part is scored by the others' model.

Statistics are computed once for all documents, in the scan's tasks, and written
(about a hundred bytes a row); texts are never shuffled.

Defined results: null and empty texts have all statistics zero and are scored as such;
repeated rows are scored each, and count each in learning; rows with a null id
are scored (held_out false) and never learnt from; labels with a null id or value
don't count, and of unlike labels for one id the larger one does; other columns are
ignored; where one class has no labelled row, all scores are the smoothed share of
class 1; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import discard, row_slices, text_bytes, written

FOLDS = 3
HELD_OUT = 1
#: Parts of the learning rows for the choice of ``pool``, ``ridge`` and ``heat``.
PARTS = 5
#: From the strongest shrinkage down: of equal losses the first one counts.
POOLS = (1.0, 0.5, 0.2, 0.05, 0.0)
RIDGES = (0.2, 0.05, 0.01, 0.001)
HEATS = (1.0, 2.0, 4.0, 8.0, 16.0)
#: Standardised statistics are held within this many standard deviations.
REACH = 8.0
SLICE_BYTES = 1 << 20

STATISTICS = ("words", "word_length", "long_words", "distinct_words", "distinct_pairs",
              "top_word", "echoes", "symbols", "upper", "digits", "stops", "shouts", "pipes",
              "non_ascii", "lines", "repeated_lines", "line_words", "bare_words")

_SPACE, _UPPER, _LOWER, _DIGIT, _STOP, _SYMBOL, _HIGH, _OTHER = range(8)


def _classes() -> np.ndarray:
    kind = np.full(256, _OTHER, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = _SPACE
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
    kind[[ord(c) for c in ".,;:!?"]] = _STOP
    kind[[ord(c) for c in "#*$%&|<>@^~=+_/\\{}[]"]] = _SYMBOL
    return kind


_KIND = _classes()
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between neighbouring ``bounds``."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``, which also end where a text does."""
    n = len(inside)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _distinct(rows: int, row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of distinct keys, occurrences of the commonest) per row."""
    distinct, most = np.zeros(rows), np.zeros(rows)
    if len(row):
        order = np.lexsort((key, row))
        r, k = row[order], key[order]
        first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])]))
        count = np.diff(np.append(first, len(r)))
        np.add.at(distinct, r[first], 1)
        np.maximum.at(most, r[first], count)
    return distinct, most


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` per text, whole texts; null counts as empty."""
    buf, offsets = text_bytes(texts)
    rows, kind = len(offsets) - 1, _KIND[buf]
    count = {k: _per_row(kind == k, offsets) for k in range(8)}
    size = np.diff(offsets).astype(float)
    ink = size - count[_SPACE]

    start, end = _runs(kind != _SPACE, offsets)
    bounds = np.searchsorted(start, offsets)
    words = np.diff(bounds).astype(float)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    # Letters as in lower case, so that a word's case plays no part in its hash.
    folded = np.where(kind == _UPPER, buf + 32, buf).astype(np.uint64) + np.uint64(1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(folded * _powers(_BASE, len(buf)), out=total[1:])
    back = _powers(_BACK, len(buf))
    word = (total[end] - total[start]) * back[start] if len(start) else np.zeros(0, np.uint64)
    distinct, most = _distinct(rows, row, word)
    inner = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
    pair = ((word[:-1] * _BASE) ^ (word[:-1] >> np.uint64(29))) + word[1:] if len(row) \
        else np.zeros(0, np.uint64)
    pairs, _ = _distinct(rows, row[:-1][inner], pair[inner])
    echo = np.zeros(rows)
    np.add.at(echo, row[1:][inner & (word[1:] == word[:-1])] if len(row) else [], 1)
    long_words = np.zeros(rows)
    np.add.at(long_words, row[(end - start) > 20], 1)
    # Words of nothing but symbols and stops.
    plain = np.concatenate([[0], np.cumsum((kind == _UPPER) | (kind == _LOWER) | (kind == _DIGIT)
                                           | (kind == _HIGH), dtype=np.int64)])
    bare = np.zeros(rows)
    np.add.at(bare, row[plain[end] == plain[start]], 1)

    begin, close = _runs(buf != 10, offsets)
    at = np.searchsorted(begin, offsets)
    lines = np.diff(at).astype(float)
    line = (total[close] - total[begin]) * back[begin] if len(begin) else np.zeros(0, np.uint64)
    kinds, _ = _distinct(rows, np.repeat(np.arange(rows), np.diff(at)), line)

    letters = count[_UPPER] + count[_LOWER] + count[_HIGH]
    return np.stack([
        np.log1p(words), np.log1p(ink / np.maximum(words, 1)), _share(long_words, words),
        np.log1p(distinct) / np.maximum(np.log1p(words), 1), _share(pairs, words - 1),
        _share(most, words), _share(echo, words), _share(count[_SYMBOL], ink),
        _share(count[_UPPER], letters), _share(count[_DIGIT], ink), _share(count[_STOP], ink),
        _share(_per_row(buf == ord("!"), offsets), ink),
        _share(_per_row(buf == ord("|"), offsets), ink), _share(count[_HIGH], ink),
        np.log1p(lines), _share(lines - kinds, lines),
        np.log1p(words / np.maximum(lines, 1)), _share(bare, words)], -1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
                      == HELD_OUT, F.lit(False))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and x, the text's ``STATISTICS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, 1, SLICE_BYTES):
                flat = pa.array(statistics(part.column(1)).ravel())
                ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * len(STATISTICS))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, x array<double>")


# --- learning -----------------------------------------------------------------------------

@dataclass
class Gaussian:
    """A class: mean, and the kept inverse of its covariance's Cholesky factor."""

    mean: np.ndarray
    inverse: np.ndarray
    constant: float  # logarithm of prior over root of the determinant

    def log_density(self, z: np.ndarray) -> np.ndarray:
        whitened = (z - self.mean) @ self.inverse.T
        return self.constant - 0.5 * (whitened * whitened).sum(-1)


@dataclass
class Model:
    """``share`` alone where one class has no rows."""

    share: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    classes: tuple[Gaussian, Gaussian] | None = None
    heat: float = 1.0
    pool: float = 0.0
    ridge: float = 0.0

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -REACH, REACH)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.share)
        z = self.standard(x)
        gap = self.classes[1].log_density(z) - self.classes[0].log_density(z)
        return 1 / (1 + np.exp(-np.clip(gap / self.heat, -500, 500)))


def gaussians(sums: np.ndarray, pool: float, ridge: float) -> tuple[Gaussian, Gaussian]:
    """Both classes from ``sums``: per class number, sums and sums of products."""
    p = int(round((-1 + np.sqrt(4 * sums.shape[1] - 3)) / 2))
    n = np.maximum(sums[:, 0], 1e-9)
    mean = sums[:, 1:p + 1] / n[:, None]
    scatter = sums[:, p + 1:].reshape(-1, p, p) \
        - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    both = scatter.sum(0) / n.sum()
    out = []
    for k in (0, 1):
        own = (1 - pool) * scatter[k] / n[k] + pool * both
        own = (1 - ridge) * own + ridge * max(np.trace(own) / p, 1e-3) * np.eye(p)
        factor = np.linalg.cholesky((own + own.T) / 2)
        out.append(Gaussian(mean[k], np.linalg.inv(factor),
                            float(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())))
    return out[0], out[1]


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _added(rows: DataFrame, body, key: str) -> dict:
    """Sums over all rows of the vectors that ``body`` gives per batch and ``key``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for k, v in body(batch):
                sums[k] = sums.get(k, 0) + v
        for k, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([v.tolist()], pa.list_(pa.float64()))],
                names=[key, "v"])

    parts = rows.mapInArrow(run, f"{key} int, v array<double>")
    found: dict[int, dict[int, float]] = {}
    for r in parts.select(key, F.posexplode("v").alias("i", "v")).groupBy(key, "i") \
            .agg(F.sum("v").alias("v")).collect():  # as many rows as the vectors are long
        found.setdefault(r[key], {})[r["i"]] = r["v"]
    return {k: np.array([v[i] for i in range(len(v))]) for k, v in found.items()}


def learning_rows(stats: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """x, y (0 or 1) and part of the labelled rows of ``stats`` outside the held-out fold."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("_id"),
                           (F.col(label) > 0).cast("int").alias("y"))
             .filter("_id IS NOT NULL AND y IS NOT NULL").filter(~held_out(F.col("_id")))
             .groupBy("_id").agg(F.max("y").alias("y")))
    return stats.join(marks, F.col("doc_id") == F.col("_id")).select(
        "x", "y", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part"))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """The model of ``stats`` (``measured``) and ``labels`` (doc_id and ``label``)."""
    rows = written(learning_rows(stats, labels, label), "qda-rows")

    def moments(batch: pa.RecordBatch):
        x, y = _matrix(batch.column(0)), np.asarray(batch.column(1))
        for k in np.unique(y):
            own = x[y == k]
            yield int(k), np.concatenate([[len(own)], own.sum(0), (own * own).sum(0)])

    first = _added(rows, moments, "y")
    n = {k: first[k][0] if k in first else 0.0 for k in (0, 1)}
    model = Model(share=(n[1] + 1) / (n[0] + n[1] + 2))
    if not n[0] or not n[1]:
        discard(rows)
        return model
    p = len(STATISTICS)
    total = first[0] + first[1]
    model.centre = total[1:p + 1] / total[0]
    spread = np.sqrt(np.maximum(total[p + 1:] / total[0] - model.centre ** 2, 0))
    model.scale = np.where(spread > 1e-6, spread, 1.0)

    def products(batch: pa.RecordBatch):
        z = model.standard(_matrix(batch.column(0)))
        group = np.asarray(batch.column(1)) * PARTS + np.asarray(batch.column(2))
        for k in np.unique(group):
            own = z[group == k]
            yield int(k), np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])

    found = _added(rows, products, "k")
    sums = np.zeros((2, PARTS, 1 + p + p * p))
    for k, v in found.items():
        sums[k // PARTS, k % PARTS] = v
    whole = sums.sum(1)

    grid = [(pool, ridge) for pool in POOLS for ridge in RIDGES]
    fitted = [[gaussians(whole - sums[:, part], *g) for g in grid] for part in range(PARTS)]

    def losses(batch: pa.RecordBatch):
        z, y = model.standard(_matrix(batch.column(0))), np.asarray(batch.column(1))
        part, out = np.asarray(batch.column(2)), np.zeros(len(grid) * len(HEATS))
        for f in np.unique(part):
            own, sign = z[part == f], 2.0 * y[part == f] - 1
            for g, (zero, one) in enumerate(fitted[f]):
                gap = sign * (one.log_density(own) - zero.log_density(own))
                for h, heat in enumerate(HEATS):
                    out[g * len(HEATS) + h] += np.logaddexp(0, -gap / heat).sum()
        yield 0, out

    loss = _added(rows, losses, "k")[0]
    best = int(np.argmin(np.round(loss, 6)))
    (model.pool, model.ridge), model.heat = grid[best // len(HEATS)], HEATS[best % len(HEATS)]
    model.classes = gaussians(whole, model.pool, model.ridge)
    discard(rows)
    return model


# --- scoring ------------------------------------------------------------------------------

def scorer(spark, model: Model):
    """A function of column x to the column of scores."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.stack(x.to_list())) if len(x) else [])

    return score


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    stats = written(measured(docs, id_col, text_col), "qda-statistics")
    score = scorer(docs.sparkSession, fit(stats, labels, label))
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        score("x").alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
