import random

from ledgerline.llm import license_scan as ls
from .conftest import ROWS, documents


def slow(text, templates=ls.TEMPLATES):
    """Every window against every template, by shingle sets."""
    words, out = ls.template_words(text or ""), []
    stride = ls.stride_for(templates)
    for at in range(0, max(len(words), 1), stride):
        part = words[at:at + 2 * stride]
        have = set(ls.template_shingles(" ".join(part)))
        for name, template in templates.items():
            want = ls.template_shingles(template)
            share = len(have & set(want)) / len(want)
            if share >= ls.MIN_CONTAINMENT:
                out.append((name, at, share))
    return sorted(out)


def fast(docs, templates=None):
    return sorted((r["doc_id"] or -1, sorted(tuple(m) for m in r["matches"]))
                  for r in ls.scan(docs, templates).collect())


def test_templates_at_every_place_of_a_window(spark):
    r = random.Random(2)
    filler = lambda n: " ".join(r.choice("and of the a in license version".split()) for _ in range(n))
    rows = [(k, f"{filler(k)}\n{t}{filler(60 - k)}") for k in range(0, 60, 3)
            for t in ls.TEMPLATES.values()]
    rows = [(i, t) for i, (_, t) in enumerate(rows, 1)]
    got = fast(documents(spark, rows))
    assert got == [(i, slow(t)) for i, t in rows]
    assert all(matches for _, matches in got)


def test_damaged_notices(spark):
    notice = ls.TEMPLATES["GPL-3.0"]
    rows = [(1, notice.upper()), (2, notice.replace("GNU", "MIT")), (3, notice[:-12]),
            (4, "x " + notice.replace(",", " -- ") + " y"), (5, " ".join(notice.split()[::-1]))]
    assert fast(documents(spark, rows)) == [(i, slow(t)) for i, t in rows]


def test_edge_rows(docs):
    assert fast(docs) == sorted((i or -1, slow(t)) for i, t in ROWS)


def test_short_templates_and_none(spark, docs):
    short = {"Tiny": "one two", "Word": "One."}
    got = dict(fast(docs, short))
    assert [m[0] for m in got[6]] == ["Tiny"] and [m[0] for m in got[5]] == ["Word"]
    assert all(m == [] for _, m in fast(docs, {}))


def test_per_document_and_empty_table(spark, no_docs):
    rows = [(1, ls.TEMPLATES["MIT"] + " " + ls.TEMPLATES["Apache-2.0"]), (2, "nothing")]
    got = {r["doc_id"]: tuple(r)[1:] for r in
           ls.per_document(ls.scan(documents(spark, rows))).collect()}
    assert got == {1: ("Apache-2.0,MIT", 2, 1.0), 2: ("", 0, 0.0)}
    assert ls.scan(no_docs).count() == 0


def licenses(spark, texts):
    found = ls.per_document(ls.scan(documents(spark, list(enumerate(texts)))))
    return [r["licenses"] for r in sorted(found.collect())]


def edited(text, every):
    """One word in ``every`` changed, other case and line breaks, text around it."""
    words = [f"edit{i}" if i % every == every - 1 else w for i, w in enumerate(text.lower().split())]
    return "Copyright 2024 somebody\n" + "\n * ".join(
        " ".join(words[i:i + 9]) for i in range(0, len(words), 9)) + "\nmain() {}"


def test_whole_texts_and_headers_with_edits(spark):
    names = [name for name in ls.FORMS if len(ls.template_shingles(ls.FORMS[name])) > 60]
    want = [ls.license_of(name) for name in names]
    assert {"MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0", "GPL-2.0", "GPL-3.0",
            "LGPL-2.1", "MPL-2.0"} <= set(want)
    for every in (10 ** 9, 40):
        got = licenses(spark, [edited(ls.FORMS[name], every) for name in names])
        for name, license_, found in zip(names, want, got):
            assert license_ in found.split(","), (name, found)
            if license_ in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "0BSD", "Zlib"):
                assert found == license_
    assert licenses(spark, [edited(ls.FORMS["GPL-3.0:header"], 10 ** 9),
                            edited(ls.FORMS["GPL-2.0:header"], 10 ** 9)]) == ["GPL-3.0", "GPL-2.0"]


def test_short_notices_and_spdx_tags(spark):
    texts = ["x. Licensed under the MIT License, see file", "// SPDX-License-Identifier: MIT\ncode",
             "# spdx-license-identifier: (apache-2.0 OR GPL-2.0-only WITH Classpath-exception-2.0)\n",
             "/* SPDX-License-Identifier: LGPL-2.1-or-later AND X11 */ and more words",
             "no SPDX tag", "<!-- SPDX-License-Identifier: GPL-2.0+ -->", ""]
    assert licenses(spark, texts) == ["MIT", "MIT", "Apache-2.0,GPL-2.0", "LGPL-2.1,X11", "",
                                      "GPL-2.0", ""]


def test_keys_survive_whatever_a_match_may_lack():
    for text in ls.TEMPLATES.values():
        shingles = ls.template_shingles(text)
        keys = ls.keys_for(shingles, ls.MIN_CONTAINMENT)
        lacking = sum((len(shingles) - k) / len(shingles) >= ls.MIN_CONTAINMENT
                      for k in range(1, len(shingles) + 1))
        assert len(keys) == len(shingles) or len(keys) > lacking
