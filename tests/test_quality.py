from ledgerline.operators import quality as Q
from conftest import rows


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a long, b long")
    assert rows(Q.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2), (None, 3, 2)]


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a long, b string")
    assert rows(Q.null_counts(df, "t")) == [("t", "a", 1, 3), ("t", "b", 2, 3)]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "fk long")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "pk long")
    assert rows(Q.orphans(child, ["fk"], parent, ["pk"])) == [(9,)]
    rep = Q.orphan_report([("c->p", child, ["fk"], parent, ["pk"])])
    assert rows(rep) == [("c->p", 1, 3)]


def test_vector_length_and_outcome(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2]), (2, [0.1]), (3, None)], "id long, v array<float>")
    flag = Q.vector_length(df, "v", 2)
    assert rows(Q.import_outcome(df, flag)) == [(False, 2), (True, 1)]
    assert [r["id"] for r in Q.first_failures(df, flag, ["id"], 5).collect()] == [2, 3]
