import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm import quality_qda
from ledgerline.llm.common import table
from conftest import SMALL_SF

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def scores(df):
    return {(r.doc_id, r.held_out, round(r.score, 9), r.predicted) for r in df.collect()}


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = quality_qda.judge(docs, labels).collect()
    assert len(got) == docs.count()
    marks = {r.doc_id: r.quality for r in labels.collect()}
    out = [(r.score, r.predicted, marks[r.doc_id]) for r in got if r.held_out and r.doc_id in marks]
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    good, bad = [s for s, _, q in out if q], [s for s, _, q in out if not q]
    assert len(bad) > 5
    above = sum(g > b for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.97
    assert sum(p == q for _, p, q in out) / len(out) > 0.95


def test_held_out_labels_play_no_part(spark):
    docs, labels = table(spark, SMALL_SF, "documents"), table(spark, SMALL_SF, "labels")
    turned = labels.withColumn("quality", F.when(quality_qda.held_out(F.col("doc_id")),
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    named = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y"))
    want = scores(quality_qda.judge(docs, labels))
    assert scores(quality_qda.judge(docs, turned)) == want
    assert scores(quality_qda.judge(named, labels)) == want


def plain_statistics(text):
    """A few of the statistics, counted one by one."""
    words = [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
    ink = sum(len(w.encode()) for w in words)
    lines = [x for x in text.split("\n") if x]
    lower = [w.lower() for w in words]
    part = lambda a, b: np.arcsin(np.sqrt(min(1, a / max(b, 1))))
    return {
        "words": np.log1p(len(words)), "word_length": np.log1p(ink / max(len(words), 1)),
        "distinct_words": np.log1p(len(set(lower))) / max(np.log1p(len(words)), 1),
        "distinct_pairs": part(len(set(zip(lower, lower[1:]))), len(words) - 1),
        "top_word": part(max([lower.count(w) for w in lower], default=0), len(words)),
        "echoes": part(sum(a == b for a, b in zip(lower, lower[1:])), len(words)),
        "symbols": part(sum(c in "#*$%&|<>@^~=+_/\\{}[]" for c in text), ink),
        "shouts": part(text.count("!"), ink), "lines": np.log1p(len(lines)),
        "repeated_lines": part(len(lines) - len(set(lines)), len(lines)),
        "long_words": part(sum(len(w.encode()) > 20 for w in words), len(words)),
    }


def test_statistics_by_plain_counting():
    texts = ["", "One two two\nthree\nthree\n\nONE, two!!", "a " * 50 + "x" * 30, "###\t%% && a|b",
             "  lead and trail \n", "same line\nsame line", "plain words only here"]
    got = quality_qda.statistics(pa.array([*texts, None]))
    assert (got[0] == got[-1]).all() and not got[-1].any()
    for row, text in zip(got, texts):
        for name, value in plain_statistics(text).items():
            assert abs(row[quality_qda.STATISTICS.index(name)] - value) < 1e-12, (text, name)


def test_log_densities_are_those_of_the_shrunk_covariances():
    rng = np.random.default_rng(5)
    groups = [rng.normal(size=(50, 4)) @ rng.normal(size=(4, 4)), rng.normal(size=(30, 4)) + 2]
    sums = np.stack([np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()]) for x in groups])
    z = rng.normal(size=(7, 4))
    both = sum(np.cov(x.T, bias=True) * len(x) for x in groups) / 80
    for x, fitted in zip(groups, quality_qda.gaussians(sums, 0.3, 0.1)):
        own = 0.7 * np.cov(x.T, bias=True) + 0.3 * both
        own = 0.9 * own + 0.1 * np.trace(own) / 4 * np.eye(4)
        gap = z - x.mean(0)
        want = np.log(len(x) / 80) - 0.5 * np.linalg.slogdet(own)[1] \
            - 0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(own), gap)
        assert np.allclose(fitted.log_density(z), want)


def test_learning_equals_one_pass_over_all_rows(spark):
    docs, labels = table(spark, SMALL_SF, "documents"), table(spark, SMALL_SF, "labels")
    model = quality_qda.fit(quality_qda.measured(docs.repartition(5)), labels)
    marks = {r.doc_id: r.quality for r in labels.collect() if not held(r.doc_id)}
    rows = [(r.text, marks[r.doc_id]) for r in docs.collect() if r.doc_id in marks]
    x = quality_qda.statistics(pa.array([t for t, _ in rows]))
    y = np.array([q for _, q in rows])
    assert np.allclose(model.centre, x.mean(0))
    for k in (0, 1):
        assert np.allclose(model.classes[k].mean, model.standard(x[y == k]).mean(0))


def test_edge_rows(spark, docs, no_docs):
    labels = table(spark, SMALL_SF, "labels")
    assert quality_qda.judge(no_docs, labels).count() == 0
    got = quality_qda.judge(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 0, 0), (5, 1, 0)],
                                "doc_id long, quality int, toxic int")
    one_class = quality_qda.judge(docs, odd).collect()
    assert len({r.score for r in one_class}) == 1 and one_class[0].score > 0.5
    none = quality_qda.judge(docs, odd.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
