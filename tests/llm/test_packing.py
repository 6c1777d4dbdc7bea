import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerline.llm import packing
from ledgerline.llm.queries import word_tokenizer
from .conftest import ROWS


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(word_tokenizer())


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_lengths_are_powers_of_two_and_add_up():
    for n in (1, 2, 3, 4095, 4096, 4097, 12345):
        parts = packing.piece_lengths(n)
        assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 4096 for p in parts)
        assert sorted(parts, reverse=True) == parts and len(set(parts) - {4096}) == \
            len([p for p in parts if p < 4096])


TEXTS = st.text(st.one_of(st.characters(codec="utf-8"),
                          st.sampled_from(" \t\n\x0b\x0c\r\x1c\x85  'sÉé́ẞΣ<|>endoftext")),
                max_size=80)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_of_runs_are_the_ids_of_the_text(text):
    from tokenizers import Tokenizer
    words = _WORDS.setdefault("w", packing.WordIds(word_tokenizer()))
    full = _WORDS.setdefault("t", Tokenizer.from_file(word_tokenizer()))
    got = np.frombuffer(next(iter(words.ids([text.encode()]))), "<u4")
    assert got.tolist() == full.encode(text, add_special_tokens=False).ids


_WORDS = {}


def test_round_trip_of_edge_rows(docs, tokenizer):
    rows = packing.pack(docs, word_tokenizer()).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    for r in rows:
        assert r["length"] == len(r["ids"]) == 1 << r["bucket"] and r["offset"] == 0
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    texts = {}
    for r in sorted(rows, key=lambda r: (r["doc_tokens"], r["start"])):
        texts.setdefault((r["doc_id"], r["doc_tokens"], r["start"]), []).append(r["ids"])
    want = {}
    for i, t in ROWS:
        ids = whole(tokenizer, t)
        start = 0
        for n in packing.piece_lengths(len(ids)):
            want.setdefault((i, len(ids), start), []).append(ids[start:start + n])
            start += n
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}


def test_memory_is_bounded_and_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 10)
    words = packing.WordIds(word_tokenizer())
    for k in range(20):
        texts = [f"word{k} word{j} § |{j}| <|endoftext|>" for j in range(6)]
        for text, ids in zip(texts, words.ids([t.encode() for t in texts])):
            assert np.frombuffer(ids, "<u4").tolist() == whole(tokenizer, text)[:-1]
        assert len(words.young) + len(words.old) < 120


def test_no_padding_and_no_rows(docs, no_docs):
    assert {r["padding"] for r in packing.padding_report(
        packing.pack(docs, word_tokenizer())).collect()} == {0}
    assert packing.pack(no_docs, word_tokenizer()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, word_tokenizer(), max_len=1000)
    assert os.path.exists(word_tokenizer())


def test_a_run_is_looked_up_once_for_many_texts():
    """Repeated runs cost no lookup each: a slice looks its distinct runs up."""
    words, asked = packing.WordIds(word_tokenizer()), []

    class Counted(dict):
        def get(self, key, default=None):
            asked.append(key)
            return dict.get(self, key, default)

        def __getitem__(self, key):
            asked.append(key)
            return dict.__getitem__(self, key)

    words.young = Counted()
    texts = [f" one two\tthree, one{i % 3}\n" for i in range(300)] + ["", "  ", "\x0b\x0c"]
    got = list(words.ids([t.encode() for t in texts]))
    assert len(asked) < 200
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == words.tokenizer.encode(
            text, add_special_tokens=False).ids
