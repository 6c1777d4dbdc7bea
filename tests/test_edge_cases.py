"""Empty inputs, null keys and ties across operators, plus SCD2 properties."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import changes as C
from ledgerline.operators import dimensions as D
from ledgerline.operators import quality as Q
from ledgerline.operators import search as S
from ledgerline.operators import text as X
from ledgerline.operators.totals import company_totals
from ledgerline.plans import adapter, star
from ledgerline.schemas import COMPANY_DIM
from ledgerline.sources.tables import read_tables
from conftest import SMALL_SF, rows

INC = "cik string, name string, sic string"


def test_scd2_empty_sides(spark):
    empty_dim = spark.createDataFrame([], COMPANY_DIM)
    inc = spark.createDataFrame([("1", "A", "x")], INC)
    snap = D.scd2_merge(empty_dim, inc, "2025-01-01 00:00:00")
    assert rows(snap, "cik", "is_current") == [("1", True)]
    none = spark.createDataFrame([], INC)
    assert rows(D.scd2_merge(snap, none, "2025-02-01 00:00:00")) == rows(snap)


def test_null_keys_never_match(spark):
    inc = spark.createDataFrame([(None, "A", "x"), ("1", "B", "y")], INC)
    src = D.company_source(inc.withColumn("adsh", F.lit("f")).withColumn("cik", F.col("cik")))
    assert rows(src, "cik") == [("1",)]
    existing = spark.createDataFrame([(1, None)], "id long, date_key string")
    source = spark.createDataFrame([(None,), ("d",)], "date_key string")
    assert rows(D.insert_only(existing, source, "date_key"), "date_key") == [("d",), (None,)]


def test_empty_totals_checks_and_search(spark):
    fact = spark.createDataFrame([], "company_id long, value double")
    comp = spark.createDataFrame([], "id long, name string")
    assert company_totals(fact, comp).count() == 0
    assert Q.duplicate_keys(fact, ["company_id"]).count() == 0
    assert rows(Q.null_counts(fact, "f")) == [("f", "company_id", 0, 0), ("f", "value", 0, 0)]
    corpus = spark.createDataFrame([], "id long, embedding array<float>")
    assert S.knn(corpus, [1.0, 0.0], 3).count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert X.TfIdf(docs).search("anything").count() == 0


def test_change_sets_on_empty_table(spark):
    schema = "adsh string, cik long, name string, form string, sic string, filing_summary string"
    raw = spark.createDataFrame([], schema)
    batch = spark.createDataFrame([("a", 1, "A", "10-K", "1", "")], schema)
    assert C.create_rows(raw, batch, all_or_nothing=True).table.count() == 1
    keys = spark.createDataFrame([("a",)], "adsh string")
    table, missing = C.delete_rows(raw, keys)
    assert table.count() == 0 and rows(missing) == [("a",)]


def test_fact_count_equals_join_prediction(spark):
    t = read_tables(spark, SMALL_SF)
    silver = adapter.silver(t)
    dims = star.first_load_dimensions(silver, "2024-01-01 00:00:00")
    facts = star.fact(silver, dims).count()
    num_n = silver["num"].groupBy("adsh", "tag_id").agg(F.count(F.lit(1)).alias("a"))
    pre_n = silver["pre"].groupBy("adsh", "tag_id").agg(F.count(F.lit(1)).alias("b"))
    predicted = num_n.join(pre_n, ["adsh", "tag_id"]).agg(F.sum(F.col("a") * F.col("b"))).first()[0]
    assert facts == predicted


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["A", "B", None]),
                          st.sampled_from(["1", "2", None])), max_size=8),
       st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["A", "B", None]),
                          st.sampled_from(["1", "2", None])), max_size=8))
def test_scd2_invariants(spark, first, second):
    def frame(data):
        seen, out = set(), []
        for k, n, s in data:
            if k not in seen:
                seen.add(k)
                out.append((str(k), n, s))
        return spark.createDataFrame(out, INC)

    a, b = frame(first), frame(second)
    snap = D.scd2_merge(D.scd2_initial(a, "2024-01-01 00:00:00"), b, "2025-01-01 00:00:00")
    got = snap.collect()
    current = [r for r in got if r["is_current"]]
    ciks_a = {r["cik"] for r in a.collect()}
    ciks_b = {r["cik"] for r in b.collect()}
    assert len(current) == len({r["cik"] for r in current}) == len(ciks_a | ciks_b)
    kinds = dict(rows(D.scd2_classify(D.scd2_initial(a, "2024-01-01 00:00:00"), b),
                      "cik", "change_kind"))
    changed = sum(1 for v in kinds.values() if v == "changed")
    assert len(got) == len(ciks_a | ciks_b) + changed
    for r in got:
        assert r["valid_from"] < r["valid_to"]
