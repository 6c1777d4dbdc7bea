"""License scan: MinHash over overlapping text windows, then exact containment.

A text is cut into windows of ``2 * stride`` words, one every ``stride`` words, where
``stride`` is at least the longest template: a template that occurs lies whole in
some window. A window's five-word shingles are hashed once; the signature keeps
the smallest hash of each bin (one-permutation MinHash), and every bin is a band of
one row. A template is retrieved when a bin holds one of its keys: its smallest
hashes, ``SPARE_KEYS`` more than a match may lack, so that every match holds some.
A shingle that both share misses its bin only if a smaller one of the window falls
into the same bin; there are so many bins for the window's length that this has a
probability below ``MISS``. Retrieved templates are verified by exact containment of
their shingles.

Templates are one-line notices, standard headers and whole texts, named
``license`` or ``license:form``. SPDX tags are read as they stand. Licenses
whose texts hold most of each other (BSD with two and three clauses, GNU headers) match
each other's documents; per document only the better one counts.

Only DataFrame functions; one projection of the scan without any shuffle: the
templates are configuration and travel as literals. A document's work depends on
its own text alone.

Defined results: null and empty texts match nothing; repeated rows get a result
each; null ids are kept; other columns are ignored; an empty table gives an empty
result. A template of fewer than five words is one shingle, of all its words.
"""

from __future__ import annotations

import math
import re

import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import let
from ledgerline.llm.license_texts import FORMS

SHINGLE = 5
MIN_CONTAINMENT = 0.8
BIN_BITS = 20
MISS = 3e-5
SPARE_KEYS = 4

#: Public one-line license notices, then headers and whole texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 "
                 "International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                    "International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and "
               "related or neighboring rights to this work.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be "
                    "found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, "
               "v. 2.0.",
    "LGPL-2.1": "This library is free software under the GNU Lesser General Public License, "
                "version 2.1.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "ARR": "Copyright. All rights reserved. No part of this publication may be reproduced.",
} | FORMS

_ID = r"[A-Za-z0-9][A-Za-z0-9.+-]*"
_TAG = rf"(?i)SPDX-License-Identifier:[ \t]*(\(*{_ID}(?:[ \t)]+(?:AND|OR|WITH)[ \t(]+{_ID})*)"

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(_NOT_WORD, text.translate(str.maketrans(_UPPER, _LOWER))) if w]


def template_shingles(text: str) -> list[str]:
    words = template_words(text)
    if len(words) < SHINGLE:
        return [" ".join(words)] if words else []
    return list(dict.fromkeys(" ".join(words[i:i + SHINGLE])
                              for i in range(len(words) - SHINGLE + 1)))


def _hash(shingle: str) -> int:
    """As ``_shingle_hashes``: XXH64 over the words' hashes, each the seed of the next."""
    value = 42
    for word in shingle.split(" "):
        one = xxhash.xxh64_intdigest(word.encode(), seed=42)
        value = xxhash.xxh64_intdigest(one.to_bytes(8, "little"), seed=value)
    return value - (1 << 64) if value >> 63 else value


def keys_for(shingles: list[str], min_containment: float) -> list[int]:
    """The smallest hashes of a template, of which a match can't lack all."""
    count = len(shingles) - math.ceil(min_containment * len(shingles) - 1e-9) + 1 + SPARE_KEYS
    return sorted(map(_hash, shingles))[:count]


def bits_for(window: int) -> int:
    """Bits of a bin's number, so that a window's shingle meets a smaller one below MISS."""
    return max(BIN_BITS, math.ceil(math.log2(window / MISS)))


def license_of(template: str) -> str:
    return template.partition(":")[0]


def rivals_of(templates: dict[str, str], min_containment: float) -> list[tuple[str, str]]:
    """(a, b): a document of b's own text, of another license, would match a as well or nearly.

    A long b that quotes such a text stands out by the quoted template itself.
    """
    parts = {name: set(template_shingles(text)) for name, text in templates.items()}
    near = min_containment - 0.1
    return [(a, b) for a, x in parts.items() for b, y in parts.items()
            if license_of(a) != license_of(b) and 1 < len(x) and len(y) <= 2 * len(x)
            and near * len(x) <= len(x & y)] + [("GPL-3.0:text", "AGPL-3.0:title")]


def stride_for(templates: dict[str, str]) -> int:
    return max([SHINGLE, *(len(template_words(t)) for t in templates.values())])


def _shingles(words: Column, count: Column) -> Column:
    """The ``count`` five-word shingles of ``words``; fewer words make one."""
    return F.transform(F.sequence(F.lit(1), count),
                       lambda i: F.array_join(F.slice(words, i, F.lit(SHINGLE)), " "))


def _shingle_hashes(words: Column, count: Column) -> Column:
    """Hashes of the shingles of ``words``: each word is hashed once, no text is joined."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)])))


def _tags(text: Column) -> Column:
    """Matches of SPDX tags: every license of their expressions, without a place."""
    ids = F.flatten(F.transform(
        F.regexp_extract_all(text, F.lit(_TAG), F.lit(1)),
        lambda tag: F.split(F.regexp_replace(F.regexp_replace(
            tag, rf"(?i)[ \t)]+WITH[ \t(]+{_ID}", ""), r"[()]", " "),
            r"(?i)[ \t]+(?:AND|OR)[ \t]+")))
    plain = F.transform(ids, lambda x: F.regexp_replace(
        F.trim(x), r"(?i)(?:-only|-or-later|\+|\.)$", ""))
    known = sorted({license_of(name) for name in TEMPLATES})
    spelled = F.create_map(*[F.lit(x) for name in known for x in (name.lower(), name)])
    rows = F.transform(plain, lambda x: F.struct(
        F.coalesce(F.try_element_at(spelled, F.lower(x)), x).alias("license"),
        F.lit(None).cast("int").alias("first_word"), F.lit(1.0).alias("containment")))
    return F.when(F.contains(F.lower(text), F.lit("spdx-license-identifier:")), rows).otherwise(
        F.array())


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
         text_col: str = "text", min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """doc_id, matches: array of (license, first_word, containment), in window order.

    ``license`` is the template's name; SPDX tags come last, with their license and
    no first word.
    """
    templates = TEMPLATES if templates is None else templates
    parts = {name: template_shingles(text) for name, text in templates.items()}
    parts = {name: s for name, s in parts.items() if s}
    kind = "array<struct<license:string,first_word:int,containment:double>>"
    tags = _tags(F.col(text_col)).cast(kind)
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.translate(F.coalesce(F.col(text_col), F.lit("")),
                                   _UPPER, _LOWER).alias("_text"),
                       tags.alias("_tags"))
    if not parts:
        return base.select("doc_id", F.col("_tags").alias("matches"))
    stride = stride_for(templates)
    window = 2 * stride
    bits = bits_for(window)
    own = {name: keys_for(shingles, min_containment) for name, shingles in parts.items()}
    keys = sorted({h for hashes in own.values() for h in hashes})
    # Long lists as one literal each, which the optimizer takes apart once.
    literal = F.array(*[
        F.struct(F.lit(name).alias("license"),
                 F.split(F.lit("\n".join(shingles)), "\n").alias("shingles"),
                 F.split(F.lit(" ".join(map(str, own[name]))), " ").cast("array<bigint>")
                 .alias("keys"))
        for name, shingles in parts.items()])
    words = F.filter(F.split("_text", _NOT_WORD), lambda w: w != "")

    def signature(hashes: Column) -> Column:
        """The smallest hash of each bin: sorted hashes, first of each run of a bin."""
        bin_of = lambda h: F.shiftright(h, 64 - bits)
        return let(F.sort_array(hashes), lambda s: F.filter(
            s, lambda h, j: (j == 0) | (bin_of(F.get(s, F.greatest(j - 1, F.lit(0))))
                                        != bin_of(h))))

    def retrieve(w: Column) -> Column:
        count = F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1))
        hashes = _shingle_hashes(w, count)
        starts = F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1)), F.lit(stride))

        def windows(h: Column) -> Column:
            found = F.transform(starts, lambda at: F.struct(
                at.alias("at"),
                F.filter(signature(F.slice(h, at, F.lit(window - SHINGLE + 1))),
                         lambda x: x.isin(keys)).alias("keys")))
            return F.filter(found, lambda x: F.size(x["keys"]) > 0)

        def verify(x: Column) -> Column:
            part = F.slice(w, x["at"], F.lit(window))
            return let(_shingles(part, F.greatest(F.size(part) - (SHINGLE - 1), F.lit(1))),
                       lambda have: F.transform(
                F.filter(literal, lambda t: F.arrays_overlap(t["keys"], x["keys"])),
                lambda t: F.struct(
                    t["license"].alias("license"), (x["at"] - 1).alias("first_word"),
                    (F.size(F.array_intersect(t["shingles"], have))
                     / F.size(t["shingles"])).alias("containment"))))

        return F.filter(F.flatten(F.transform(let(hashes, windows), verify)),
                        lambda m: m["containment"] >= min_containment)

    empty = F.array().cast(kind)
    found = let(words, lambda w: F.when(F.size(w) > 0, retrieve(w)).otherwise(empty))
    return base.select("doc_id", F.concat(found.cast(kind), "_tags").alias("matches"))


def per_document(found: DataFrame) -> DataFrame:
    """doc_id, licenses (sorted, comma-joined), n_licenses and the best containment.

    A match whose rival is held better by the same document doesn't count.
    """
    rivals: dict[str, list[str]] = {}
    for a, b in rivals_of(TEMPLATES, MIN_CONTAINMENT):
        rivals.setdefault(a, []).append(b)
    lists = F.create_map(*[x for a, bs in rivals.items()
                           for x in (F.lit(a), F.array(*map(F.lit, bs)))])
    better = lambda matches: F.filter(matches, lambda m: ~F.exists(
        matches, lambda o: F.coalesce(F.array_contains(F.try_element_at(lists, m["license"]),
                                                       o["license"]), F.lit(False))
        & (o["containment"] > m["containment"])))
    names = F.array_sort(F.array_distinct(F.transform(
        let(F.col("matches"), better), lambda m: F.substring_index(m["license"], ":", 1))))
    return found.select(
        "doc_id", F.array_join(names, ",").alias("licenses"),
        F.size(names).cast("long").alias("n_licenses"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])),
                   F.lit(0.0)).alias("containment"))
