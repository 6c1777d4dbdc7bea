import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from ledgerline.llm import quality_rules as q
from .conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(repeated))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures_match_brute_force(docs):
    from .conftest import ROWS
    got = sorted((r["doc_id"] or -1, *(r[c] for c in COLUMNS)) for r in q.measure(docs).collect())
    assert got == sorted((i or -1, *expected(t)) for i, t in ROWS)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#|é", max_size=60), min_size=1, max_size=8))
def test_measures_on_random_texts(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS)
           for r in q.measure(documents(spark, rows)).collect()}
    assert got == {i: expected(t) for i, t in rows}


def test_bits_policies_and_ablations(spark, docs):
    ledger = q.ledger(docs)
    rows = {(r["doc_id"], r["fail_bits"]) for r in ledger.collect()}
    assert (3, q.bit("too_few_words") & ~0) in {(i, b & 1) for i, b in rows}
    kept = q.apply_policy(ledger, "base", 1).filter("kept").count()
    table = {r["rule"]: r for r in q.ablations(ledger).filter("policy = 'base'").collect()}
    assert set(table) == {"too_few_words", "repeated_words"}
    assert all(r["kept"] == kept for r in table.values())
    stored = q.store(docs)
    assert q.ablations(stored).collect() and "documents" not in stored._jdf.queryExecution().toString()
    assert sorted(stored.collect(), key=str) == sorted(ledger.collect(), key=str)
    without = ledger.filter(f"fail_bits & {q.bit('repeated_words')} = 0").count()
    assert table["too_few_words"]["kept_without"] == without


def test_a_later_policy_only_adds_rules():
    assert q.mask("prose", 1) & ~q.mask("prose", 2) == 0
    with pytest.raises(KeyError):
        q.mask("prose", 9)


def test_empty_table(no_docs):
    assert q.ledger(no_docs).count() == 0
    assert q.ablations(q.ledger(no_docs)).count() == 0
