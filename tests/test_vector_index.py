import math

import numpy as np
import pytest

from ledgerline.operators.vector_index import VectorIndex


def clustered(rows, centres, dim, spread, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return [(i, (middle[i % centres] + spread * rng.normal(size=dim)).tolist()) for i in range(rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, embedding array<double>")


def scan(rows, queries, k):
    """Cosine distances to every row."""
    out = set()
    for qid, q in queries:
        found = []
        for i, v in rows:
            if v is None or len(v) != len(q) or not any(v):
                continue
            d = 1 - math.fsum(a * b for a, b in zip(q, v)) / math.sqrt(
                math.fsum(a * a for a in q) * math.fsum(b * b for b in v))
            found.append((round(d, 12), i))
        out |= {(qid, r + 1, i, round(d, 6) + 0.0) for r, (d, i) in enumerate(sorted(found)[:k])}
    return out


def result(df):
    return {(r.qid, r.rank, r.id, round(r.distance, 6) + 0.0) for r in df.collect()}


@pytest.mark.parametrize("spread,k", [(0.05, 5), (3.0, 7)])
def test_equals_a_scan(spark, spread, k):
    rows = clustered(400, 8, 6, spread, 1)
    queries = rows[::20]
    index = VectorIndex(frame(spark, rows), lists=8, block_rows=20)
    asked = frame(spark, queries).toDF("qid", "qvec")
    visited = []
    assert result(index.search(asked, k, visited=visited)) == scan(rows, queries, k)
    share = sum(r.rows for t in visited for r in t.collect()) / (len(rows) * len(queries))
    assert share < 0.5 if spread < 1 else share <= 1.0
    assert index.blocks.agg({"rows": "max"}).first()[0] < 60
    index.release()


def test_a_group_of_copies_is_dealt_out_over_blocks(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(300)] + clustered(50, 5, 3, 1.0, 4)
    rows = [(i, v) for i, (_, v) in enumerate(rows)]
    index = VectorIndex(frame(spark, rows), lists=4, block_rows=32)
    asked = frame(spark, [(1, [2.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.5])]).toDF("qid", "qvec")
    want = scan(rows, [(1, [2.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.5])], 10)
    assert result(index.search(asked, 10)) == want
    assert index.blocks.count() > 8


def test_vectors_without_direction_and_small_tables(spark):
    rows = [(1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 2.0, 3.0]), (5, [-1.0, 0.0]),
            (6, [1.0, 1.0])]
    queries = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None)]
    index = VectorIndex(frame(spark, rows))
    asked = frame(spark, queries).toDF("qid", "qvec")
    assert result(index.search(asked, 10)) == scan(rows, queries[:1], 10)
    empty = VectorIndex(frame(spark, []))
    assert empty.search(asked, 10).count() == 0
    assert index.search(asked.limit(0), 10).count() == 0


def test_open_queries_are_listed_by_shelf_not_by_block(spark):
    rows = clustered(600, 1, 8, 3.0, 5)
    index = VectorIndex(frame(spark, rows), lists=16, block_rows=8)
    assert result(index.search(frame(spark, rows[::5]).toDF("qid", "qvec"), 5)) == scan(rows, rows[::5], 5)
    visits = spark.read.parquet(*[p for p in index._paths if "vectors-second" in p])
    assert index.blocks.count() > 40 and visits.count() <= len(rows[::5])


def test_shelves_and_chunks_of_queries_together_are_a_scan(spark, monkeypatch):
    from ledgerline.operators import vector_index
    monkeypatch.setattr(vector_index, "SHELF_ROWS", 50)
    monkeypatch.setattr(vector_index, "QUERY_CHUNK", 20)
    rows = clustered(300, 6, 5, 1.0, 9) + [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(40)]
    index = VectorIndex(frame(spark, rows), lists=6, block_rows=16)
    asked = rows[::4]
    assert result(index.search(frame(spark, asked).toDF("qid", "qvec"), 12)) == scan(rows, asked, 12)


def test_a_repeated_query_finds_rows_as_often_as_its_rows_meet(spark):
    rows = clustered(60, 3, 4, 1.0, 2)
    asked = [(1, rows[5][1]), (1, rows[5][1]), (2, rows[7][1]), (None, rows[9][1])]
    got = VectorIndex(frame(spark, rows), lists=3, block_rows=8).search(
        spark.createDataFrame(asked, "qid long, qvec array<double>"), 6).orderBy("qid", "rank").collect()
    near = sorted(scan(rows, [(1, rows[5][1])], 2), key=lambda r: r[1])
    assert [r.id for r in got if r.qid == 1] == [near[0][2]] * 4 + [near[1][2]] * 2
    assert {(r.qid, r.rank, r.id, round(r.distance, 6) + 0.0) for r in got if r.qid == 2} \
        == scan(rows, [(2, rows[7][1])], 6) and len(got) == 12
