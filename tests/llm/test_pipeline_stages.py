import hashlib
import random

import corpus_pipeline as cp
from ledgerline.llm import decontam, simhash, toxicity
from ledgerline.llm.common import table
from conftest import SMALL_SF
from .conftest import documents
from .test_decontam import slow as slow_hits
from .test_simhash import slow_components, slow_fingerprint
from .test_suffix_dedup import slow as slow_repeats


def test_stages_are_the_five_in_order():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash_near_dedup", "suffix_array_dedup",
                                         "benchmark_decontamination", "packing"]
    assert cp.ORACLE_SQL is None


def test_every_stage_by_brute_force(spark):
    """Each stage's rows from its own input, computed without Spark."""
    docs = table(spark, SMALL_SF, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns

    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, SMALL_SF, "labels"))
    lexicon = toxicity.Lexicon(model)
    figures = {i: toxicity.figures(t, lexicon) for i, t in rows.items()}
    keep = {i for i, f in figures.items() if toxicity._probability(model, [f[0]], [f[2]])[0] < 0.5}
    out = cp.drop_toxic(spark, docs, SMALL_SF)
    assert out.columns == columns and {r["doc_id"] for r in out.collect()} == keep

    rows = {i: t for i, t in rows.items() if i in keep}
    prints = [(i, slow_fingerprint(t)) for i, t in rows.items()]
    keep = {i for (i, _), c in zip(prints, slow_components(prints)) if c == i}
    docs = docs.filter(docs["doc_id"].isin(list(rows)))
    out = cp.drop_near_duplicates(spark, docs, SMALL_SF)
    assert out.columns == columns and sorted(r["doc_id"] for r in out.collect()) == sorted(keep)

    rows = {i: t for i, t in rows.items() if i in keep}
    docs = docs.filter(docs["doc_id"].isin(list(rows)))
    out = cp.cut_repeats(spark, docs, SMALL_SF)
    assert out.columns == columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    want = {r[0] if r[0] != -1 else 0: r for r in slow_repeats(list(rows.items()), cp.PASSAGE_BYTES)}
    for i, r in want.items():
        if got[i].isascii() and rows[i].isascii():
            assert hashlib.sha256(got[i].encode()).hexdigest() == r[4]
    assert set(got) == set(rows)

    docs = spark.createDataFrame(list(got.items()), "doc_id long, text string")
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL_SF, "benchmark").collect()]
    keep = {r[0] if r[0] != -1 else 0 for r in slow_hits(list(got.items()), items, decontam.WINDOW)
            if not r[5]}
    out = cp.drop_contaminated(spark, docs, SMALL_SF)
    assert {r["doc_id"] for r in out.collect()} == keep and simhash.MAX_BITS == 3


def test_edge_rows_pass_through_all_stages(spark, docs, no_docs):
    for frame in (docs, no_docs):
        for name, stage in cp.STAGES:
            out = stage(spark, frame, SMALL_SF)
            if name != "packing":
                assert out.columns == frame.columns, name
                frame = spark.createDataFrame(out.collect(), out.schema)
            else:
                assert out.count() >= frame.count()
    assert documents(spark, []).columns == no_docs.columns


def test_passages_of_over_fifty_words_are_cut(spark):
    """Also where they are far shorter than op6's 400 bytes; other texts stay as they are."""
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
                               for _ in range(n))
    passages = [words(n) for n in (51, 53, 60)]
    assert all(250 < len(p.encode()) < 400 for p in passages)
    rows = [(i, f"{words(40)} {passages[i % 3]} {words(40)}") for i in range(9)]
    clean = [(100 + i, words(120)) for i in range(6)]
    out = {r["doc_id"]: r["text"] for r in cp.cut_repeats(
        spark, documents(spark, rows + clean), SMALL_SF).collect()}
    for i, text in rows:
        assert passages[i % 3] not in out[i] and len(text) - len(out[i]) >= 250
        assert len(text) - len(out[i]) <= len(passages[i % 3]) + 4
    assert all(out[i] == t for i, t in clean)
