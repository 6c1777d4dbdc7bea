import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.operators import search as S
from ledgerline.operators import text as X
from conftest import SMALL_SF


def test_html_text(spark):
    html = ('<html><head><title>T</title><style>p{x:1}</style>'
            '<script>var t="</p>";</script></head><body><p>Hello\n  <b>world</b></p></body></html>')
    df = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    got = {r["page_id"]: r["extracted_text"] for r in X.extract_texts(df).collect()}
    assert got == {1: "T Hello world", 2: ""}


def _brute_tfidf(docs, query):
    tfs = {i: Counter(t for t in txt.lower().split() if t) for i, txt in docs}
    n = len(docs)
    df = Counter(t for c in tfs.values() for t in c)
    def vec(c):
        return {t: c[t] * math.log(n / df[t]) for t in c if t in df}
    q = vec(Counter(query.lower().split()))
    qn = math.sqrt(sum(v * v for v in q.values()))
    out = {}
    for i, c in tfs.items():
        w = vec(c)
        if not set(w) & set(q):
            continue
        nd = math.sqrt(sum(v * v for v in w.values()))
        out[i] = round(1 - sum(w[t] * q.get(t, 0.0) for t in w) / (nd * qn), 5) if nd * qn > 0 else None
    return out


def test_tfidf_matches_brute_force(spark):
    docs = [(1, "the cat sat on the mat"), (2, "The dog sat"), (3, "birds fly high"),
            (4, "cat and dog and cat"), (5, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["distance"] for r in X.TfIdf(df).search("cat sat").collect()}
    want = _brute_tfidf(docs, "cat sat")
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9)


def _emb(spark):
    return spark.read.parquet(f"{SMALL_SF}/embeddings.parquet")


def _cos(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    return 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))


def test_knn_matches_brute_force(spark):
    emb = _emb(spark)
    pdf = emb.toPandas()
    q = list(pdf.sort_values("vec_id").iloc[3]["embedding"])
    got = [r["vec_id"] for r in S.knn(emb, q, 7, id_col="vec_id").collect()]
    d = sorted((round(_cos(v, q), 6), i) for i, v in zip(pdf.vec_id, pdf.embedding))
    assert got == [i for _, i in d[:7]]
    lab = int(pdf.label.iloc[0])
    got_f = [r["vec_id"] for r in S.knn(emb, q, 5, id_col="vec_id", facet="label",
                                         facet_value=lab).collect()]
    sub = pdf[pdf.label == lab]
    d = sorted((round(_cos(v, q), 6), i) for i, v in zip(sub.vec_id, sub.embedding))
    assert got_f == [i for _, i in d[:5]]


def test_knn_per_query_matches_brute_force(spark):
    emb = _emb(spark)
    queries = S.facet_centroids(emb, "label").withColumnRenamed("label", "qid")
    queries = queries.withColumn("label", queries["qid"])
    got = {}
    for r in S.knn_per_query(emb, queries, "label", 3, id_col="vec_id").collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["vec_id"]))
    pdf = emb.toPandas()
    for lab, grp in pdf.groupby("label"):
        c = np.mean(np.stack(grp.embedding.map(lambda v: np.asarray(v, float))), axis=0)
        d = sorted((round(_cos(v, c), 6), i) for i, v in zip(grp.vec_id, grp.embedding))
        assert [i for _, i in sorted(got[lab])] == [i for _, i in d[:3]]


def test_build_corpus(spark):
    filings = spark.createDataFrame([("a", "sum a"), ("b", None)], "adsh string, filing_summary string")
    texts = spark.createDataFrame([("a", "pdf a")], "adsh string, extracted_pdf_text string")
    got = {r["adsh"]: (r["full_text"], r["has_text"])
           for r in S.build_corpus(filings, texts).collect()}
    assert got == {"a": ("sum a\n\npdf a", True), "b": ("\n\n", False)}


def test_hashed_vectors_match_brute_force(spark):
    import hashlib
    docs = [(1, "the cat sat on the mat"), (2, "The dog sat"), (3, "birds fly high")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    dim = 8
    model = X.TfIdf(df)
    got = {r["doc_id"]: r["embedding"] for r in model.vectors(dim).collect()}
    tfs = {i: Counter(t.lower().split()) for i, t in docs}
    dfreq = Counter(t for c in tfs.values() for t in c)

    def bucket(term):
        return int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % dim

    for i, c in tfs.items():
        want = [0.0] * dim
        for term, n in c.items():
            want[bucket(term)] += n * math.log(len(docs) / dfreq[term])
        assert got[i] == pytest.approx(want, abs=1e-12)
    q = model.query_vector("cat cat dog", dim)
    want_q = [0.0] * dim
    for term, n in Counter(["cat", "cat", "dog"]).items():
        want_q[bucket(term)] += n * math.log(len(docs) / dfreq[term])
    assert q == pytest.approx(want_q, abs=1e-12)


def test_ranking_uses_the_exact_distance(spark):
    corpus = spark.createDataFrame([(1, [1.0, 1e-4]), (2, [1.0, 0.0])],
                                   "id long, embedding array<double>")
    assert [r["id"] for r in S.knn(corpus, [1.0, 0.0], 1).collect()] == [2]
    queries = spark.createDataFrame([(7, "x", [1.0, 0.0])], "qid long, f string, qvec array<double>")
    corpus = corpus.selectExpr("*", "'x' AS f")
    assert [r["id"] for r in S.knn_per_query(corpus, queries, "f", 1).collect()] == [2]


def test_corpus_row_does_not_depend_on_input_order(spark):
    rows = [("a", "one"), ("a", "two"), ("a", None)]
    texts = spark.createDataFrame([], "adsh string, extracted_pdf_text string")
    got = set()
    for order in (rows, rows[::-1]):
        filings = spark.createDataFrame(order, "adsh string, filing_summary string").coalesce(1)
        got |= {r["full_text"] for r in S.build_corpus(filings, texts).collect()}
    assert len(got) == 1


def test_search_with_and_without_a_form(spark):
    docs = spark.createDataFrame(
        [("1", "11", "A", "10-K", "cat sat"), ("2", "12", "B", "10-Q", "cat sat"),
         ("3", "13", "C", "10-K", "dog ran"), ("4", "14", "D", "8-K", "bird")],
        "id string, cik string, name string, form string, full_text string")
    index = X.TfIdf(docs, "id", "full_text", facet="form")
    queries = spark.createDataFrame([(1, "cat sat", None), (2, "cat sat", "10-Q"), (3, "zzz", None)],
                                    "qid long, text string, form string")
    got = [(r["qid"], r["rank"], r["id"], r["cik"], r["name"], r["form"]) for r in
           S.search_texts(index, docs, queries, k=5).orderBy("qid", "rank").collect()]
    assert got == [(1, 1, "1", "11", "A", "10-K"), (1, 2, "2", "12", "B", "10-Q"),
                   (2, 1, "2", "12", "B", "10-Q")]
    hits = index.search_hashed("cat sat", k=2, dim=64).collect()
    assert [r["id"] for r in hits] == ["1", "2"]
    index.release()


def _nearest(docs, queries, k, wanted=None):
    """(qid, rank, id, distance) by expanding everything; rows of one key are one document."""
    bags = {}
    for i, t, f in docs:
        bags.setdefault(i, Counter()).update((t or "").lower().split())
    n = len(docs)
    df = Counter(t for b in bags.values() for t in b)
    idf = {t: math.log(n / df[t]) for t in df}
    length = lambda b: math.sqrt(sum((c * idf[t]) ** 2 for t, c in b.items()))
    facet, out = {i: f for i, _, f in docs}, set()
    for qid, text in queries:
        q = Counter(t for t in text.lower().split() if t in df)
        found = []
        for i, b in bags.items():
            if i is None or not set(q) & set(b) or (wanted and facet[i] != wanted):
                continue
            dot, denom = sum(b[t] * q[t] * idf[t] ** 2 for t in q), length(b) * length(q)
            found.append((round(1 - dot / denom, 12), i) if denom else (math.inf, i))
        out |= {(qid, r + 1, i, None if d == math.inf else round(d, 5) + 0.0)
                for r, (d, i) in enumerate(sorted(found)[:k])}
    return out


@pytest.mark.parametrize("wanted", [None, "en"])
def test_search_with_shared_and_missing_keys(spark, monkeypatch, wanted):
    monkeypatch.setattr(X, "QUERY_CHUNK", 2)
    monkeypatch.setattr(X, "DOCUMENT_ROWS", 7)
    monkeypatch.setattr(X, "FREQUENT", 4)
    rng = random.Random(4)
    text = lambda: " ".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.choice([1, 6, 30])))
    forms = {i: rng.choice(["en", "de"]) for i in range(60)}
    docs = [(i, text(), forms[i]) for i in range(60)] + [(i, text(), forms[i]) for i in (3, 3, 8)] + [
        (None, "a b c", "en"), (None, "c z", "en"), (90, None, "en"), (91, "", "de"), (92, "a a", "en")]
    queries = [(q, text()) for q in range(7)] + [(50, "unknown"), (51, "")]
    index = X.TfIdf(spark.createDataFrame(docs, "id long, text string, form string"), "id", "text", "form")
    asked = spark.createDataFrame([(q, t, wanted) for q, t in queries],
                                  "qid long, text string, form string")
    got = {(r.qid, r["rank"], r.id, None if r.distance is None else r.distance + 0.0)
           for r in index.search_batch(asked, 5, "form").collect()}
    assert got == _nearest(docs, queries, 5, wanted)
    index.release()


def test_documents_are_not_shuffled_once_per_query_or_term(spark):
    docs = spark.createDataFrame([(i, f"all some w{i % 9} v{i}") for i in range(200)],
                                 "doc_id long, text string")
    index = X.TfIdf(docs)
    assert index.counts.count() == 200
    asked = spark.createDataFrame([(q, f"some w{q} v{q}") for q in range(9)], "qid long, text string")
    plan = index.search_batch(asked, 3)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(qid#\d+L?, doc_id", plan)
    index.release()
