import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import collocations, hat_trie
from ledgerline.llm.common import table
from conftest import SMALL_SF

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, top=2000, longest=5):
    """All phrases by plain counting; a phrase goes if any longer one holds it as often."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = f.setdefault(lang, Counter())
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            own.update(tuple(w[i:i + k]) for k in range(1, longest + 1)
                       for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        some = {p: a for p, a in own.items() if a >= least and len(p) > 1}
        inner = {(p[i:i + k], a) for p, a in some.items() for k in range(2, len(p))
                 for i in range(len(p) - k + 1)}
        rows = []
        for p, a in some.items():
            if (p, a) in inner:
                continue
            score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k)
                           for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, le, ri, n[lang], -score)
                for i, (score, a, p, le, ri) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def texts(rows, seed=3):
    rng = random.Random(seed)
    words = ["The", "the", "of", "x", "Ä", "ä", "naïve", "a|b", "42", "\x01"] + list("bcde")
    out = []
    for _ in range(rows):
        lang = rng.choice(["en", "de", None, "und"])
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", "\n", ",", "  "])
                       for _ in range(rng.randrange(60)))
        out.append((lang, rng.choice([text, text, None, "", text * 2])))
    return out


def frame(spark, rows):
    """Columns whose names clash with the operator's own."""
    return spark.createDataFrame([(t, lang, 1, "x", None, 3) for lang, t in rows],
                                 "text string, lang string, f long, phrase string, n string, rank int")


@pytest.mark.parametrize("seed,least,top", [(1, 2, 2000), (2, 3, 5), (3, 8, 40)])
def test_equals_plain_counting(spark, seed, least, top):
    rows = texts(80, seed)
    got = found(collocations.collocations(frame(spark, rows).repartition(3), least, top))
    assert got == brute(rows, least, top)


def test_spilling_and_bursting_change_nothing(spark, monkeypatch):
    rows = texts(150, 9)
    want = found(collocations.collocations(frame(spark, rows).coalesce(1), 3))
    small = hat_trie.HatTrie.__init__.__defaults__
    monkeypatch.setattr(hat_trie, "BURST", 4)
    monkeypatch.setattr(hat_trie.HatTrie.__init__, "__defaults__", (12,))
    trie, seen, gone = hat_trie.HatTrie(), Counter(), Counter()
    rng = np.random.default_rng(0)
    spills = 0
    for _ in range(40):
        paths = rng.integers(1, 6, (30, 5)) * (np.arange(5) < rng.integers(1, 6, (30, 1)))
        seen.update(map(tuple, paths.tolist()))
        for taken in trie.add(paths):
            spills += 1
            for p, c in zip(hat_trie.unpack(*taken[:2]).tolist(), taken[2].tolist()):
                gone[tuple(p)] += c
    for taken in trie.drain():
        for p, c in zip(hat_trie.unpack(*taken[:2]).tolist(), taken[2].tolist()):
            gone[tuple(p)] += c
    assert gone == seen and spills > 10
    assert list(trie.drain()) == []
    monkeypatch.undo()
    assert hat_trie.HatTrie.__init__.__defaults__ == small
    assert want == brute(rows, 3)


def test_trie_bursts_by_word_and_then_by_depth(monkeypatch):
    monkeypatch.setattr(hat_trie, "BURST", 8)
    trie = hat_trie.HatTrie(limit=10 ** 9)
    rng = np.random.default_rng(1)
    same = np.concatenate([np.full((400, 1), 7), rng.integers(1, 30, (400, 4))], 1)
    list(trie.add(same))
    list(trie.add(rng.integers(1, 50, (400, 5))))
    assert len(trie.root.children) > 4
    assert any(isinstance(c, hat_trie.Node) and c.depth == 1 for c in trie.root.children)
    assert sum(int(t[2].sum()) for t in trie.drain()) == 800


def test_small_runs_merge(spark, monkeypatch):
    """Runs of many tasks, with a filter that lets everything pass."""
    rows = texts(60, 4)
    monkeypatch.setattr(collocations, "SPARE", 1)
    got = found(collocations.collocations(frame(spark, rows).repartition(16), 2))
    assert got == brute(rows, 2)


def test_whole_table(spark):
    docs = table(spark, SMALL_SF, "documents")
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert found(collocations.collocations(docs, 20)) == brute(rows, 20)


def test_edge_rows(spark, docs, no_docs):
    assert found(collocations.collocations(no_docs)) == []
    rows = [("en", r.text) for r in docs.collect()]
    assert found(collocations.collocations(docs, 2)) == brute(rows, 2)
    none = frame(spark, [("en", None), (None, ""), ("de", "one")])
    assert found(collocations.collocations(none, 1)) == []


def test_products_beyond_64_bits(spark):
    frequent = spark.createDataFrame(
        [("en", "a b", 2, 9_000_000_000), ("en", "a", 1, 9_000_000_001), ("en", "b", 1, 9_000_000_007)],
        "lang string, phrase string, size int, f long")
    n = 10 ** 14
    sizes = spark.createDataFrame([("en", n)], "lang string, n long")
    row = collocations.scored(frequent, sizes).first()
    assert row["score"] == 1000 * 9_000_000_000 * n // (9_000_000_001 * 9_000_000_007)
