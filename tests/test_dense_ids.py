import pytest

from ledgerline.operators.dense_ids import continue_ids, next_id, number


def ids(df, *cols):
    return [tuple(r) for r in df.select("id", *cols).orderBy("id").collect()]


@pytest.mark.parametrize("partitions", [1, 7, 300])
def test_gapless_in_key_order(spark, partitions):
    keys = [f"k{i * 37 % 1000:04d}" for i in range(1000)]
    rows = spark.createDataFrame([(k, k + "!") for k in keys + keys[:300]] + [(None, "x")],
                                 "key string, label string").repartition(5)
    got = ids(number(rows, ["key"], partitions=partitions), "key", "label")
    assert got == [(i + 1, k, k + "!") for i, k in enumerate(sorted(keys))]


def test_later_loads_continue(spark):
    first = spark.createDataFrame([(5, "a"), (1, "b"), (9, "a")], "x long, y string")
    store = number(first, ["y", "x"])
    assert ids(store, "y", "x") == [(1, "a", 5), (2, "a", 9), (3, "b", 1)]
    later = spark.createDataFrame([(5, "a"), (0, "a"), (0, "a"), (None, "q"), (2, "b")],
                                  "x long, y string")
    new = continue_ids(store, later, ["y", "x"])
    assert ids(new, "y", "x") == [(4, "a", 0), (5, "b", 2)]
    both = store.unionByName(new)
    assert next_id(both) == 6
    assert continue_ids(both, later, ["y", "x"]).count() == 0


def test_a_key_with_most_rows_and_empty_loads(spark):
    rows = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS key")
    got = ids(number(rows, ["key"], partitions=16), "key")
    want = sorted({-1 if i % 3 == 0 else i for i in range(5000)})
    assert got == [(i + 1, k) for i, k in enumerate(want)]
    none = number(rows.limit(0), ["key"])
    assert none.count() == 0 and next_id(none) == 1
