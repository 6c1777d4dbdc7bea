import itertools
import random
import zlib

import pytest

from ledgerline.llm import toxicity as tx
from ledgerline.llm.transducers import Transducer, compose
from .conftest import ROWS, documents


def symbols_of(symbols):
    return [s for s, _ in tx.read_clause(symbols)]


def test_readings_of_a_clause():
    assert symbols_of(list("oi")) == ["o", "i"]
    assert symbols_of(list("Yoi")) == ["Y", "o", "t"]
    assert symbols_of(list("YNooi")) == ["Y", "N", "o", "o", "n"]  # three words reach
    assert symbols_of(list("Noooi"))[-1] == "i"
    assert symbols_of(list("oRoYi"))[-1] == "r"
    assert symbols_of(list("oHoY")) == ["o", "t", "o", "Y"]  # a threat needs a target after it
    assert symbols_of(list("YoH")) == ["Y", "o", "o"]


def reading(symbols, k):
    """A term's reading straight from the words around it."""
    before, after = symbols[:k], symbols[k + 1:]
    if symbols[k] == "H" and "Y" not in after:
        return "o"
    if "N" in before[-tx.NEGATION_REACH:]:
        return "n"
    if "R" in before:
        return "r"
    return "t" if "Y" in before + after else "i"


def test_every_short_clause_is_read_as_its_words_say():
    for size in range(7):
        for symbols in map(list, itertools.product(tx.ALPHABET, repeat=size)):
            want = [reading(symbols, k) if s in "iH" else s for k, s in enumerate(symbols)]
            assert symbols_of(symbols) == want, symbols


def test_weights_lie_on_the_arcs_that_give_a_reading():
    name = dict(zip("itnr", tx.READINGS))
    for symbols in map("".join, itertools.product("ijYNRo", repeat=5)):
        for out, weight in tx.BEHIND.read(symbols):
            assert weight == ((name[out],) if out in name else ())


def test_composition_is_one_after_the_other():
    r = random.Random(3)
    for _ in range(200):
        make = lambda: Transducer({(r.randrange(3), r.choice("abc")): (
            r.randrange(3), r.choice("abc"), (str(r.randrange(9)),)) for _ in range(7)})
        one, two = make(), make()
        text = [r.choice("abc") for _ in range(12)]
        first = one.read(text)
        both = [(out, paid + more) for (_, paid), (out, more) in
                zip(first, two.read([x for x, _ in first]))]
        assert compose(one, two, "abc").read(text) == both


def test_clauses_change_the_weight():
    lexicon = tx.Lexicon(tx.Model(words={w: tx.SEED_WEIGHT for w in tx.INSULTS}))
    score = lambda t: tx._probability(lexicon.model, [tx.figures(t, lexicon)[0]],
                                      [tx.figures(t, lexicon)[2]])[0]
    assert score("you are a worthless idiot") > score("there was an idiot in the play today")
    assert score("you are not an idiot at all") < score("you are an idiot and a fool")
    assert score("she said that you are an idiot") < score("you are an idiot in all you do")
    assert score("you will see. I will kill you") > score("you will see it. the kill was quick")
    assert score("") == score(None) < 0.1 and 0 <= score("idiot " * 5000) <= 1


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(11)
    words = ["".join(r.choice("aeioustnr") for _ in range(r.randrange(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(500):
        text = [r.choice(words) for _ in range(r.randrange(40, 200))]
        toxic = i % 5 == 0
        if toxic:  # invented insults, one with endings
            for _ in range(max(3, len(text) // 40)):
                text.insert(r.randrange(len(text)), r.choice(
                    ["grumbolt", "zwackel" + r.choice(["er", "ig", "lich", "ung"])]))
        rows.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, int(toxic)))
    return (documents(spark, rows), spark.createDataFrame(
        [*labels, (None, 1), (7, None)], "doc_id long, toxic int"))


def test_learns_words_and_beginnings_and_flags_held_out_rows(corpus):
    docs, labels = corpus
    model = tx.fit(docs, labels)
    assert model.words.get("grumbolt", 0) > 0 and any(p.startswith("zwack") for p in model.prefixes)
    rows = tx.judge(docs, labels).collect()
    assert len(rows) == 500
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5)
    wrong = [r["doc_id"] for r in rows if r["predicted"] != int(r["doc_id"] % 5 == 0)]
    assert len(wrong) <= 5


def test_held_out_labels_change_nothing(corpus):
    docs, labels = corpus
    held = tx.held_out(labels["doc_id"])
    turned = labels.filter(~held).unionByName(labels.filter(held).selectExpr("doc_id", "1 - toxic AS toxic"))
    assert tx.fit(docs, labels) == tx.fit(docs, turned)


def test_sample_is_bounded_and_near_copies_count_once(spark, corpus):
    docs, labels = corpus
    assert tx.training_rows(docs, labels, 50).count() <= 50
    same = documents(spark, [(i, "the same text in all of these rows") for i in range(40)])
    marks = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int")
    assert tx.training_rows(same, marks).count() == 1


def test_edge_rows_and_no_labels(spark, docs, no_docs, corpus):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = tx.judge(docs, none).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert tx.judge(no_docs, none).count() == 0
    assert tx.judge(no_docs, corpus[1]).count() == 0
