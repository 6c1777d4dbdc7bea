import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import suffix_dedup
from .conftest import ROWS, documents

LENGTH, REACH = 40, 24


def slow(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(raw[p:p + length] for _, raw in raws for p in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if seen[raw[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i or -1, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def fast(docs, length=LENGTH, reach=REACH):
    return sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in suffix_dedup.repeats(docs, length, reach).collect())


def test_edge_rows(docs):
    assert fast(docs) == slow(ROWS, LENGTH)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shared_passages_and_near_copies(spark, seed):
    r = random.Random(seed)
    letters = "abcdé "
    passages = ["".join(r.choice(letters) for _ in range(n)) for n in (38, 39, 40, 41, 90, 200)]
    rows = []
    for i in range(60):
        parts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(4)]
        for k in range(3):
            parts.insert(r.randrange(len(parts)), r.choice(passages))
        text = "".join(parts)
        if r.random() < 0.3 and rows:  # a near copy: one character changed
            text = r.choice(rows)[1]
            at = r.randrange(max(1, len(text)))
            text = text[:at] + "X" + text[at + 1:]
        rows.append((i, text))
    rows += [(100, "ab" * 150), (101, "a" * 300), (102, "In. " * 70)]
    assert fast(documents(spark, rows)) == slow(rows, LENGTH)


def test_triggers_depend_on_the_string_alone():
    r = random.Random(4)
    shared = bytes(r.randrange(97, 101) for _ in range(60))
    places = []
    for _ in range(20):
        before = bytes(r.randrange(97, 101) for _ in range(r.randrange(50)))
        buf = np.frombuffer(before + shared + bytes(r.randrange(97, 101) for _ in range(30)), np.uint8)
        places.append(suffix_dedup.triggers(buf, REACH)[len(before)] - len(before))
    assert len(set(places)) == 1


def test_cut_keeps_columns_and_characters(spark):
    same = "é" * 30 + "the same forty bytes and more in two texts, really"
    docs = documents(spark, [(1, "x" + same + "1"), (2, "yé" + same + "2"), (3, None), (4, "short")])
    cut = suffix_dedup.cut_repeats(docs, 40, REACH)
    assert cut.columns == docs.columns
    got = {r["doc_id"]: r for r in cut.collect()}
    assert got[3]["text"] is None and got[4]["text"] == "short" and got[4]["n_chars"] == 5
    assert got[1]["text"] == "x1" and got[2]["text"] in ("yé2", "y2")
    assert all(r["n_chars"] == len(r["text"]) and r["lang"] == "en" for r in got.values()
               if r["text"] is not None)


def test_empty_table(no_docs):
    assert suffix_dedup.repeats(no_docs).count() == 0
    assert suffix_dedup.cut_repeats(no_docs).count() == 0
