import random

import numpy as np
import xxhash

from ledgerline.llm import simhash
from .conftest import ROWS, documents


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] \
        or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Smallest id reachable, per row of (id, fingerprint); null ids name nothing."""
    n = len(prints)
    group = list(range(n))
    for i in range(n):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    names = {}
    for g, (i, _) in zip(group, prints):
        names[g] = min(x for x in (names.get(g), i, 1 << 63) if x is not None)
    return [None if names[g] == 1 << 63 else names[g] for g in group]


def test_edge_rows(docs):
    prints = [(i, slow_fingerprint(t)) for i, t in ROWS]
    want = sorted((i or -1, f"{f:016x}", c or -1)
                  for (i, f), c in zip(prints, slow_components(prints)))
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"] or -1)
                 for r in simhash.near_duplicates(docs).collect())
    assert got == want


def _link_all(spark, values):
    frame = spark.createDataFrame(
        [(i, int(np.uint64(v).view(np.int64))) for i, v in enumerate(values)], "doc_id long, fp long")
    rows = frame.join(simhash.link(frame), "fp").select("doc_id", "root").collect()
    return [r["root"] for r in sorted(rows)]


def test_links_at_and_beyond_three_bits(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(60)]
    values = []
    for b in base:
        values.append(b)
        for flips in (1, 2, 3, 4):
            v = b
            for bit in r.sample(range(64), flips):
                v ^= 1 << bit
            values.append(v)
    assert _link_all(spark, values) == slow_components(list(enumerate(values)))


def test_a_crowded_place_is_dealt_out_and_loses_no_link(spark):
    r = random.Random(9)
    top = r.getrandbits(64) & ~0xFFFFF
    values = list(dict.fromkeys(top | r.getrandbits(20) for _ in range(2 * simhash.CROWDED)))
    assert _link_all(spark, values) == slow_components(list(enumerate(values)))


def test_long_chains_reach_their_smallest_id(spark):
    values = [(1 << k) - 1 for k in range(0, 64, 3)]
    assert _link_all(spark, values[::-1]) == [0] * len(values)


def test_keep_one_row_of_each_component(spark, docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(8) == 1 and 10 in ids and 11 not in ids
    assert 2 in ids and 3 not in ids and 4 not in ids  # wordless texts are copies
    assert kept.filter("text = 'a row without an id, kept all the same'").count() == 1


def test_unlike_texts_under_one_id_stay_apart(spark, docs):
    kept = [(r["doc_id"], r["text"]) for r in simhash.keep_one(docs).collect()]
    assert sorted(t for i, t in kept if i == 9) == ["other", "same id, another text"]
    hot = [(0, f"text {i} of words {i * 7} all {i * 13} its own {i * 31}") for i in range(50)]
    rows = hot + [(7, hot[3][1]), (8, "apart from them"), (0, hot[5][1])]
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(documents(spark, rows)).collect())
    prints = [slow_fingerprint(t) for _, t in hot] + [slow_fingerprint("apart from them")]
    groups = slow_components(list(enumerate(prints)))
    assert len(kept) == len(set(groups)) > 40 and all(i in (0, 8) for i, _ in kept)


def test_a_shared_id_does_not_join_components(spark):
    values = [0, (1 << 20) - 1, (1 << 40) - 1, (1 << 40) - 1 ^ 1]
    frame = spark.createDataFrame([(5, values[0]), (5, values[1]), (9, values[1]), (5, values[2]),
                                   (2, values[3])], "doc_id long, fp long")
    got = {r["fp"]: (r["component"], r["root"]) for r in simhash.link(frame).collect()}
    assert len({c for c, _ in got.values()}) == 3
    assert [got[v][1] for v in values] == [5, 5, 2, 2]  # before: 2 for all


def test_copies_are_not_expanded(spark):
    same = documents(spark, [(i, "the very same words in every one of these") for i in range(300)])
    out = simhash.near_duplicates(same)
    assert out.count() == 300
    assert [r[0] for r in out.select("component_id").distinct().collect()] == [0]


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_masks_meet_every_three_bit_change():
    r = random.Random(1)
    for _ in range(200):
        change = sum(1 << b for b in r.sample(range(64), 3))
        meets = [m for m in simhash.COARSE if not m & change]
        assert meets
        assert all(any(not f & change for f in simhash._fine(m)) for m in meets)
