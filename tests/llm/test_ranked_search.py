import math
import random
import re
from collections import Counter

import pytest

from ledgerline.llm import ranked_search
from ledgerline.llm.common import table
from conftest import SMALL_SF

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    """Every document scored for every item."""
    bags = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n, total = sum(1 for _, _, k in bags if k), sum(k for _, _, k in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for d, bag, size in bags:
            s = 0
            for t, times in Counter(terms(text)).items():
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 25 + 75 * size * n // total
                    s += times * w * (1000000000 * bag[t] // (1000 * bag[t] + 8 * m))
            if s:
                scores.append((-s, d is None, d or 0))
        out += [(item, k + 1, None if none else d, -s)
                for k, (s, none, d) in enumerate(sorted(scores)[:top])]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def corpus(rows, seed):
    """Few words, so that lists are long, short ones too, and scores tie."""
    rng = random.Random(seed)
    words = ["the", "OF", "Is", "ß", "naïve"] * 8 + [f"w{i}" for i in range(60)]
    out = []
    for i in range(rows):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 5, 40])))
        out.append((rng.choice([i, i, i, None, 3]), rng.choice([text, text, text, None])))
    return out + [(5, "the same text"), (5, "the same text"), (6, "the same text")]


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, "x", 1) for d, t in docs],
                                  "doc_id long, text string, term string, score long"),
            spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, rank int"))


@pytest.mark.parametrize("seed,segment,block_terms,top",
                         [(1, 300, 200_000, 10), (2, 3000, 7, 3), (3, 1 << 20, 200_000, 10)])
def test_equals_scoring_every_document(spark, monkeypatch, seed, segment, block_terms, top):
    docs = corpus(300, seed)
    items = [(i, t) for i, t in corpus(25, seed + 50)] + [(1, "the the the ß"), (2, "unknown"), (3, "")]
    d, i = frames(spark, docs, items)
    got = ranked_search.search(ranked_search.index(d.repartition(3), segment_bytes=segment), i,
                               top, block_terms=block_terms)
    assert found(got) == brute(docs, items, top)


def test_windows_are_skipped(spark):
    """A rare term's accumulators keep most blocks of the long lists closed."""
    docs = [(i, "common word here " + ("rare gem " if i % 400 < 12 else "")) for i in range(4000)]
    d, i = frames(spark, docs, [(1, "rare gem common")])
    index = ranked_search.index(d.coalesce(1))
    n, total = ranked_search.corpus_size(index)
    queries = ranked_search.weighted_queries(index, i, n)
    (_, block), = ranked_search._blocks(queries, 1000)
    row = index.first()
    import numpy as np
    import pyarrow as pa
    lists = ranked_search.Lists(
        {"doc_ids": pa.array(row["doc_ids"]), "terms": pa.array(row["terms"])}
        | {c: np.array(row[c]) for c in ("lengths", "sizes", "docs", "tfs")}, block, n, total)
    best = ranked_search.Best(10)
    looked = ranked_search.search_segment(lists, block.queries[0], best)
    assert looked < 1500 and [d for _, _, d in best.rows] == list(range(10))


def test_whole_tables(spark):
    docs, items = table(spark, SMALL_SF, "documents"), table(spark, SMALL_SF, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()],
                 [(r.item_id, r.text) for r in items.collect()])
    index = ranked_search.index(docs)
    assert found(ranked_search.search(index, items)) == want
    assert found(ranked_search.search(index, items, 2)) == \
        Counter({k: v for k, v in want.items() if k[1] <= 2})  # the index serves again


def test_edge_rows(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "the quick fox"), (1, "same text"), (None, "one"), (2, None),
                                   (3, "東京 😀"), (4, "w1x2 w3x4"), (4, "w1x2 w3x4")],
                                  "item_id long, text string")
    none = items.limit(0)
    assert found(ranked_search.search(ranked_search.index(no_docs), items)) == Counter()
    assert found(ranked_search.search(ranked_search.index(docs), none)) == Counter()
    want = brute([(r.doc_id, r.text) for r in docs.collect()],
                 [(r.item_id, r.text) for r in items.collect()])
    assert found(ranked_search.search(ranked_search.index(docs), items)) == want


def test_memory_follows_a_segment_not_a_file(spark, monkeypatch):
    """Readers hold a few segments of a file at a time, and so does Python."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from glob import glob

    rng = random.Random(4)
    docs = spark.createDataFrame(
        [(i, " ".join(f"{rng.randrange(1 << 32):08x}" for _ in range(2000)) + " common") for i in range(240)],
        "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "common")], "item_id long, text string")
    index = ranked_search.index(docs, segment_bytes=200_000)
    file, = [pq.ParquetFile(f).metadata for f in glob(index.scratch_path.removeprefix("file:") + "/*.parquet")]
    groups = [file.row_group(i) for i in range(file.num_row_groups)]
    assert file.num_rows > 15 and len(groups) > 2
    assert max(g.total_byte_size for g in groups) < 8 << 20

    sizes = lambda: index.mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches),
        "n long")
    met = []
    whole = ranked_search.written
    monkeypatch.setattr(ranked_search, "written", lambda df, name, **o: (
        met.extend(r.n for r in sizes().collect()) if name == "search-best" else None,
        whole(df, name, **o))[1])
    monkeypatch.setattr(ranked_search, "BATCH_BYTES", 1 << 20)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    got = ranked_search.search(index, items)
    assert found(got) == brute([tuple(r) for r in docs.collect()], [(1, "common")])
    assert sum(met) == file.num_rows and max(met) <= 4
    assert spark.conf.get(key, None) == before
