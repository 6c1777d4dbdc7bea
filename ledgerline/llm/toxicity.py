"""Toxicity by a weighted finite-state grammar over clauses.

A text is cut into clauses. A lexicon maps each word to a symbol: insult or other term
with a weight, threat verb, target (the reader or a group), negation, reporting verb,
or nothing. Five transducers rewrite a term's symbol by its clause: a threat verb counts
only where a target follows it; a term is negated (a negation up to three words
before it), else reported (a reporting verb before it), else targeted (a target within
the clause), else plain. They are composed into two: what depends on later words is read
from the end (``AHEAD``), what depends on earlier ones from the start (``BEHIND``).
An arc that gives a term its reading weighs the reading's factor. What is scored are the
matched clauses: the sum of the weights of their paths; a document's score is a
logistic function of the total, of its density and of the length.

Learning. Term weights are log ratios of a term's rate in toxic and clean labelled
documents; terms are words or word beginnings of 5 to 7 letters, taken by a
likelihood-ratio test on documents. The four readings' factors and the logistic
are fitted too. All of it uses at most ``TRAIN_ROWS`` labelled rows (those with the
smallest hashes of their ids) outside the held-out fold, of which near copies
count once. Counting runs on Spark; the driver sees the terms of that sample that pass the
test, and one short row of figures per training row.

Scoring covers every document, whole texts, in the scan's own tasks, without a shuffle.

Defined results: null and empty texts have no clauses and score as such; rows
repeated are scored each; null ids score like others and never train; labels
with null id or value don't count; other columns are ignored; without
labels of both kinds the fixed seed weights stand.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import discard, written
from ledgerline.llm.transducers import Transducer, chain
from ledgerline.operators.dedup import keep_first

TRAIN_ROWS = 20_000
FOLDS = 5
PREFIXES = (5, 6, 7)
MIN_DOCS = 4
MIN_G2 = 18.0
MIN_RATIO = 1.4  # natural logarithm of a rate ratio of four

#: Seed words of the grammar, in English, German, French and Spanish.
INSULTS = """
idiot idiots moron morons stupid dumb fool loser losers scum trash garbage pathetic worthless
disgusting clown jerk imbecile filth vermin coward
dumm dummkopf idioten abschaum versager widerlich erbärmlich wertlos
imbécile crétin débile ordure minable dégoûtant nul
idiota estúpido imbécil basura escoria asqueroso patético inútil
""".split()
THREATS = """
kill hurt destroy beat burn shoot stab
töten umbringen schlagen vernichten
tuer frapper détruire brûler
matar golpear destruir quemar
""".split()
TARGETS = """
you your yourself u they them
du dich dir ihr euch
tu toi vous
tú usted ustedes vosotros
""".split()
NEGATIONS = """
not no never isn't aren't wasn't don't without
nicht kein keine nie niemals
ne pas jamais
nunca jamás
""".split()
REPORTS = """
said says called claimed wrote reported quoted
sagte behauptete schrieb nannte
disait appelait écrivait
dijo llamó escribió afirmó
""".split()
SEED_WEIGHT = 3.0

#: Readings of a matched term, and how they share out before any label is seen
#: (of terms in toxic, in clean documents).
READINGS = ("plain", "targeted", "negated", "reported")
PRIOR_TOXIC = np.array([0.60, 0.34, 0.03, 0.03])
PRIOR_CLEAN = np.array([0.45, 0.05, 0.30, 0.20])
PRIOR_WEIGHT = 50.0
#: Intercept and coefficients before any label is seen.
SEED_LOGISTIC = (-3.0, 1.0, 0.5, 0.0)

_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")
_BREAKS = frozenset(".!?;:\n")
NEGATION_REACH = 3


# --- transducers ------------------------------------------------------------------------

#: i insult or other term, H threat verb, Y target, N negation, R reporting verb, o others.
ALPHABET = "iHYNRo"


def threats() -> Transducer:
    """A threat verb becomes a term where a target follows; reads from the end."""
    return Transducer({(0, "Y"): (1, "Y", ()), (0, "H"): (0, "o", ()), (1, "H"): (1, "i", ())})


def target_ahead() -> Transducer:
    """A term that a target follows becomes ``j``; reads from the end."""
    return Transducer({(0, "Y"): (1, "Y", ()), (1, "i"): (1, "j", ())})


def negation(reach: int = NEGATION_REACH) -> Transducer:
    """States count down the words that a negation still reaches."""
    arcs = {(left, "N"): (reach, "N", ()) for left in range(reach + 1)}
    for left in range(1, reach + 1):
        arcs |= {(left, s): (left - 1, s, ()) for s in "HYRo"}
        arcs |= {(left, s): (left - 1, "n", ("negated",)) for s in "ij"}
    return Transducer(arcs)


def reported() -> Transducer:
    """After a reporting verb, terms of the clause are another's words."""
    return Transducer({(0, "R"): (1, "R", ()),
                       (1, "i"): (1, "r", ("reported",)), (1, "j"): (1, "r", ("reported",))})


def targeted() -> Transducer:
    """What is left of the terms is targeted if a target stands before or behind it."""
    return Transducer({(0, "Y"): (1, "Y", ()), (0, "i"): (0, "i", ("plain",)),
                       (0, "j"): (0, "t", ("targeted",)), (1, "i"): (1, "t", ("targeted",)),
                       (1, "j"): (1, "t", ("targeted",))})


AHEAD = chain([threats(), target_ahead()], ALPHABET)
BEHIND = chain([negation(), reported(), targeted()], "ijHYNRo")


def read_clause(symbols: list[str]) -> list[tuple[str, tuple[str, ...]]]:
    """(symbol, weight) of each word as both transducers leave it."""
    ahead = [s for s, _ in AHEAD.read(reversed(symbols))]
    return BEHIND.read(reversed(ahead))


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    factors: tuple[float, ...] = (1.0, 1.3, 0.3, 0.3)
    logistic: tuple[float, ...] = SEED_LOGISTIC


class Lexicon(dict):
    """word -> (symbol, weight), found on first use and remembered within a bound."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.fixed = {w: ("o", 0.0) for w in _BREAKS}
        for kind, words in (("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS)):
            self.fixed |= {w: (kind, 0.0) for w in words}
        self.fixed |= {w: ("H", SEED_WEIGHT) for w in THREATS}

    def __missing__(self, word: str) -> tuple[str, float]:
        if len(self) > 500_000:
            self.clear()
        weight = self.model.words.get(word)
        if weight is None:
            weight = next((self.model.prefixes[word[:k]] for k in reversed(PREFIXES)
                           if len(word) >= k and word[:k] in self.model.prefixes), None)
        if word in self.fixed and not (weight or 0) > 0:
            found = self.fixed[word]
        else:
            found = ("i", weight) if weight is not None and weight > 0 else ("o", 0.0)
        self[word] = found
        return found


def figures(text: str | None, lexicon: Lexicon) -> tuple[int, np.ndarray, np.ndarray]:
    """(words, terms per reading, weight per reading) of a whole text."""
    counts, weights = np.zeros(4), np.zeros(4)
    tokens = _TOKEN.findall((text or "").lower())
    n = 0
    clause: list[str] = []
    busy = False

    def close() -> None:
        found = [lexicon[w] for w in clause]
        for (_, weight), (_, paid) in zip(found, read_clause([f[0] for f in found])):
            for reading in paid:
                counts[READINGS.index(reading)] += 1
                weights[READINGS.index(reading)] += weight

    for token in tokens:
        if token in _BREAKS:
            if busy:
                close()
            clause, busy = [], False
            continue
        n += 1
        clause.append(token)
        busy = busy or lexicon[token][0] in "iH"
    if busy:
        close()
    return n, counts, weights


def _inputs(n, total):
    """Inputs of the logistic, from word counts and weighted totals."""
    n, total = np.asarray(n, float), np.asarray(total, float)
    return np.stack([np.ones_like(total), np.log1p(total),
                     np.log1p(1000 * total / np.maximum(n, 1)), np.log1p(n)], -1)


def _probability(model: Model, n, weights) -> np.ndarray:
    x = _inputs(n, np.asarray(weights) @ np.array(model.factors))
    return 1 / (1 + np.exp(-np.clip(x @ np.array(model.logistic), -30, 30)))


# --- learning ------------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0,
                      F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, toxic of at most ``rows`` labelled documents, near copies once.

    The sample of ids is bounded, so it is broadcast; texts are not shuffled to find
    it. Near copies are told by the smallest hash of a text's five-word shingles.
    """
    marks = (labels.select(F.col("doc_id").cast("long").alias("_id"),
                           F.col("toxic").cast("int").alias("toxic"))
             .filter("_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("_id")))
             .groupBy("_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    found = (docs.join(F.broadcast(marks), F.col("doc_id") == F.col("_id"))
             .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic"))
    words = F.split("text", "[ \\t-\\r]+")
    sketch = F.array_min(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - 4, F.lit(1))),
        lambda i: F.xxhash64(F.array_join(F.slice("w", i, F.lit(5)), " "))))
    sketched = found.withColumn("w", words).withColumn("sketch", sketch).drop("w")
    return keep_first(sketched, ["sketch", "toxic"], ["doc_id", "text"]).drop("sketch")


def _count_terms(rows: DataFrame) -> DataFrame:
    """term, is_prefix and its occurrences and documents in toxic and clean rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, bool], list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = Counter(t for t in _TOKEN.findall(text.lower()) if t not in _BREAKS)
                terms: Counter = Counter({(w, False): c for w, c in words.items()})
                for w, c in words.items():
                    for k in PREFIXES:
                        if len(w) >= k:
                            terms[w[:k], True] += c
                at = 0 if toxic else 2
                for term, c in terms.items():
                    row = seen.setdefault(term, [0, 0, 0, 0])
                    row[at] += c
                    row[at + 1] += 1
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in seen]), pa.array([p for _, p in seen]),
                     *[pa.array([r[k] for r in seen.values()], pa.int64()) for k in range(4)]],
                    names=["term", "is_prefix", "t_occ", "t_docs", "c_occ", "c_docs"])

    parts = rows.select("text", "toxic").mapInArrow(
        run, "term string, is_prefix boolean, t_occ long, t_docs long, c_occ long, c_docs long")
    return parts.groupBy("term", "is_prefix").agg(
        *[F.sum(c).alias(c) for c in ("t_occ", "t_docs", "c_occ", "c_docs")])


def _g2(t_docs: Column, c_docs: Column, toxic: int, clean: int) -> Column:
    """Likelihood ratio of a term's documents against the share of toxic ones."""
    share = toxic / (toxic + clean)
    both = t_docs + c_docs
    part = lambda x, p: F.when(x > 0, x * F.log(x / (both * p))).otherwise(0.0)
    return 2 * (part(t_docs, share) + part(c_docs, 1 - share))


def _weights(counts: DataFrame, toxic: int, clean: int) -> Model:
    """The lexicon: tested terms, and the words under a tested word beginning."""
    sums = counts.filter("NOT is_prefix").agg(F.sum("t_occ").alias("t"),
                                              F.sum("c_occ").alias("c")).first()
    scale = max(sums["c"] or 1, 1) / max(sums["t"] or 1, 1)
    ratio = F.log((F.col("t_occ") + 0.5) / (F.col("c_occ") + 0.5) * scale)
    rated = counts.withColumns({"weight": F.least(F.lit(6.0), ratio),
                                "g2": _g2(F.col("t_docs"), F.col("c_docs"), toxic, clean)})
    picked = (rated.filter((F.col("t_docs") >= MIN_DOCS) & (F.col("g2") >= MIN_G2)
                           & (F.col("weight") >= MIN_RATIO)).select("term", "is_prefix", "weight"))
    beginnings = picked.filter("is_prefix").select(F.col("term").alias("beginning"))
    under = (rated.filter(~F.col("is_prefix") & (F.col("t_docs") + F.col("c_docs") >= MIN_DOCS))
             .select("term", "is_prefix", "weight", F.explode(
                 F.array(*[F.substring("term", 1, k) for k in PREFIXES])).alias("beginning"))
             .join(beginnings, "beginning", "left_semi").drop("beginning"))
    model = Model(words={w: SEED_WEIGHT for w in INSULTS})
    for r in picked.union(under).distinct().collect():  # terms of the bounded sample
        (model.prefixes if r["is_prefix"] else model.words)[r["term"]] = r["weight"]
    return model


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton's method on standardised inputs; coefficients for the plain ones."""
    mean, scale = x.mean(0), x.std(0)
    mean[0], scale[0] = 0.0, 1.0
    scale[scale == 0] = 1.0
    z = (x - mean) / scale
    w = np.zeros(x.shape[1])
    penalty = np.eye(len(w)) * ridge
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty,
                               z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    out = w / scale
    out[0] -= (w * mean / scale).sum()
    return out


def _figures_frame(docs: DataFrame, model: Model, extra: str, kind: str) -> DataFrame:
    """``extra`` and n, c0..c3, w0..w3 per document of (``extra``, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model)
        for batch in batches:
            rows = [figures(t.as_py(), lexicon) for t in batch.column(1)]
            n = pa.array([r[0] for r in rows], pa.int64())
            counts = np.array([r[1] for r in rows]).reshape(-1, 4)
            weights = np.array([r[2] for r in rows]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n, *[pa.array(counts[:, k]) for k in range(4)],
                 *[pa.array(weights[:, k]) for k in range(4)]], names=names)

    names = [extra, "n", *[f"c{k}" for k in range(4)], *[f"w{k}" for k in range(4)]]
    schema = f"{extra} {kind}, n long, " + ", ".join(f"{x} double" for x in names[2:])
    return docs.select(extra, "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """The model of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    sample = written(training_rows(docs, labels, rows), "toxic-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).alias("toxic"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not clean:
        return Model(words={w: SEED_WEIGHT for w in INSULTS})
    counts = written(_count_terms(sample), "toxic-terms")
    model = _weights(counts, toxic, clean)
    seen = _figures_frame(sample, model, "toxic", "int").collect()  # at most ``rows`` rows
    discard(sample, counts)
    y = np.array([r["toxic"] > 0 for r in seen], float)
    n = np.array([r["n"] for r in seen], float)
    count = np.array([[r[f"c{k}"] for k in range(4)] for r in seen])
    weight = np.array([[r[f"w{k}"] for k in range(4)] for r in seen])
    shares = []
    for kind, prior in ((1, PRIOR_TOXIC), (0, PRIOR_CLEAN)):
        terms = count[y == kind].sum(0)
        shares.append((terms + PRIOR_WEIGHT * prior) / (terms.sum() + PRIOR_WEIGHT))
    # A reading's factor: one, moved by its log ratio against the plain reading.
    gain = np.log(shares[0] / shares[1])
    model.factors = tuple(np.clip(1 + (gain - gain[0]) / SEED_WEIGHT, 0.0, 2.0).tolist())
    x = _inputs(n, weight @ np.array(model.factors))
    model.logistic = tuple(_fit_logistic(x, y).tolist())
    return model


# --- scoring --------------------------------------------------------------------------------

def scorer(docs: DataFrame, model: Model) -> Column:
    """The score of column ``text`` as a column, computed in the scan's tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    state: dict[str, Lexicon] = {}

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        model = shared.value
        lexicon = state.setdefault("lexicon", Lexicon(model))
        rows = [figures(t, lexicon) for t in texts]
        return pd.Series(_probability(model, np.array([r[0] for r in rows], float),
                                      np.array([r[2] for r in rows]).reshape(-1, 4)))

    return score(F.col("text"))


def judge(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(base, labels, rows)
    return base.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       scorer(base, model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
