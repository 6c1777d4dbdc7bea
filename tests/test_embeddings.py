import math
import os
import random
from collections import Counter

import numpy as np

from ledgerline.operators import embeddings as E
from ledgerline.operators import text as X
from ledgerline.operators.embeddings import LatentVectors
from ledgerline.operators.vector_index import VectorIndex


def corpus(rows, seed=1):
    """Documents of five subjects with words of their own and common ones."""
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice([f"s{i % 5}w{rng.randrange(12)}", f"c{rng.randrange(9)}"])
                         for _ in range(30))) for i in range(rows)]


def matrix(docs, min_df=2):
    """Unit TF-IDF rows over the terms that count."""
    bags = [Counter((t or "").lower().split()) for _, t in docs]
    df = Counter(t for b in bags for t in b)
    n = len(docs)
    terms = sorted(t for t in df if min_df <= df[t] < n)
    out = np.zeros((n, len(terms)))
    for i, bag in enumerate(bags):
        norm = math.sqrt(sum((c * math.log(n / df[t])) ** 2 for t, c in bag.items()))
        for j, t in enumerate(terms):
            out[i, j] = bag[t] * math.log(n / df[t]) / norm if norm else 0
    return out


def vectors(latent, docs):
    found = {r.doc_id: r.embedding for r in latent.documents.collect()}
    return np.array([found.get(i, [0.0] * latent.dim) for i, _ in docs])


def unit(x):
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.where(n > 0, x / np.where(n > 0, n, 1), 0)


def test_equals_the_exact_svd(spark):
    docs = corpus(90)
    latent = LatentVectors(X.TfIdf(spark.createDataFrame(docs, "doc_id long, text string")),
                           dim=5, extra=20, rounds=3)
    got = vectors(latent, docs)
    a = matrix(docs)
    _, _, right = np.linalg.svd(a, full_matrices=False)
    want = unit(a @ right[:5].T)
    assert got.shape == (90, 5)
    assert np.abs(got @ got.T - want @ want.T).max() < 0.02
    assert np.allclose(np.linalg.norm(got, axis=1), 1)


def test_neighbours_against_exact_weights(spark):
    docs = corpus(200, 3)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    latent = LatentVectors(X.TfIdf(frame), dim=16)
    got = vectors(latent, docs)
    same = np.array([[i % 5 == j % 5 for j in range(200)] for i in range(200)])
    near = np.argsort(-(got @ got.T), axis=1)[:, 1:11]
    assert np.mean([same[i, near[i]].mean() for i in range(200)]) > 0.95
    full = LatentVectors(X.TfIdf(frame), dim=80, extra=20)
    got, a = vectors(full, docs), unit(matrix(docs))
    exact = np.argsort(-(a @ a.T), axis=1)[:, 1:11]
    near = np.argsort(-(got @ got.T), axis=1)[:, 1:11]
    assert np.mean([len(set(e) & set(n)) / 10 for e, n in zip(exact, near)]) > 0.9


def test_texts_are_encoded_into_the_same_space(spark):
    docs = corpus(60, 5) + [(100, ""), (101, None), (102, "lonely")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    latent = LatentVectors(X.TfIdf(frame), dim=6)
    asked = spark.createDataFrame([(7, docs[7][1]), (8, docs[8][1]), (9, "unknown words"), (10, None)],
                                  "qid long, text string")
    encoded = latent.encode(asked)
    assert {r.qid for r in encoded.collect()} == {7, 8}
    whole = latent.with_vectors(frame.select("doc_id"))
    assert {r.doc_id for r in whole.collect() if not any(r.embedding)} == {100, 101, 102}
    hits = VectorIndex(whole, "doc_id").search(encoded, 1).collect()
    assert all(r.distance < 1e-6 for r in hits) and len(hits) == 2
    latent.release()


def test_fewer_documents_than_coordinates(spark):
    docs = [(1, "a b c"), (2, "a b d"), (3, "e")]
    latent = LatentVectors(X.TfIdf(spark.createDataFrame(docs, "doc_id long, text string")), dim=8)
    got = vectors(latent, docs)
    assert got.shape == (3, 8) and got[0] @ got[1] > 0.99 and not got[2].any()


def test_vectors_meet_blocks_of_terms_not_weights(spark, monkeypatch):
    docs = corpus(80, 9) + [(None, "s1w1 c1"), (500, "s1w1 s1w2"), (500, "s1w1 c2")]
    index = X.TfIdf(spark.createDataFrame(docs, "doc_id long, text string"))
    whole = LatentVectors(index, dim=6)
    met = []
    products = LatentVectors._of_documents
    monkeypatch.setattr(LatentVectors, "_of_documents", lambda self, *a, **k: (
        met.append((self.cells.count(), self.cells.selectExpr("sum(size(x))").first()[0])),
        products(self, *a, **k))[1])
    for name, value in (("BLOCK_TERMS", 20), ("CELL_WEIGHTS", 100), ("CELL_ROWS", 30), ("SUM_ROWS", 10)):
        monkeypatch.setattr(E, name, value)
    cut = LatentVectors(index, dim=6)
    assert all(rows < weights / 2 for rows, weights in met) and len(met) == 3
    a, b = vectors(whole, docs[:80]), vectors(cut, docs[:80])
    assert np.abs(a @ a.T - b @ b.T).max() < 1e-3
    assert len([r for r in cut.documents.collect() if r.doc_id == 500]) == 1
    whole.release(), cut.release(), index.release()


def test_a_group_gets_a_vector_once_and_part_by_part(spark, monkeypatch):
    """What is sent follows the terms of a group of documents, and little is kept of it."""
    docs = corpus(120, 11)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = X.TfIdf(frame)
    whole = LatentVectors(index, dim=6)
    sent, held = [], []
    send, store = LatentVectors._sent, LatentVectors._store

    def sending(self, *args):
        out = send(self, *args)
        sent.append(out.selectExpr("sum(octet_length(v))").first()[0] or 0)
        return out

    def storing(self, df, name, *args, **kwargs):
        out = store(self, df, name, *args, **kwargs)
        held.append(Counter(p.rsplit("/", 1)[1].split("-")[1] for p in self._paths))
        return out

    monkeypatch.setattr(LatentVectors, "_sent", sending)
    monkeypatch.setattr(LatentVectors, "_store", storing)
    for name, value in (("BLOCK_TERMS", 12), ("CELL_ROWS", 40), ("SUM_ROWS", 5), ("SENT_BYTES", 1),
                        ("PASSES", 3), ("PACK_WEIGHTS", 300)):
        monkeypatch.setattr(E, name, value)
    counts = index._paths[0]
    cut = LatentVectors(index, dim=6, spent=True)
    group = {r.doc_id: r.g for r in frame.selectExpr("doc_id", "pmod(xxhash64(doc_id), 3) g").collect()}
    df = Counter(t for _, text in docs for t in set(text.split()))
    pairs = {(group[i], t) for i, text in docs for t in text.split() if 2 <= df[t] < len(docs)}
    assert len(sent) == 9 and sum(sent) == 3 * len(pairs) * (6 + E.EXTRA) * 4
    assert max(h["raw"] for h in held) == 1 and max(h["documents"] for h in held) <= 2
    a, b = vectors(whole, docs), vectors(cut, docs)
    assert np.abs(a @ a.T - b @ b.T).max() < 1e-4
    assert not os.path.exists(counts.removeprefix("file:")) and index.df.count() == len(df)
    whole.release(), cut.release(), index.release()
