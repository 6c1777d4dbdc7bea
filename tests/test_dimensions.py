import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import dimensions as D
from conftest import rows

T0 = "2024-01-01 00:00:00"
T1 = "2025-01-01 00:00:00"
T2 = "2025-06-01 00:00:00"


def _incoming(spark, data):
    return spark.createDataFrame(data, "cik string, name string, sic string")


def test_scd2_classes_and_snapshot(spark):
    dim = D.scd2_initial(_incoming(spark, [("1", "A", "10"), ("2", "B", None),
                                            ("3", "C", "30"), ("4", None, "40")]), T0)
    inc = _incoming(spark, [("1", "A", "10"),      # same
                            ("2", "B", None),      # same (null-safe)
                            ("3", "C2", "30"),     # changed name
                            ("4", None, "40"),     # same with null name
                            ("5", "E", "50")])     # new; nothing for vanished
    kinds = dict(rows(D.scd2_classify(dim, inc), "cik", "change_kind"))
    assert kinds == {"1": "same", "2": "same", "3": "changed", "4": "same", "5": "new"}
    snap = D.scd2_merge(dim, inc, T1)
    got = rows(snap.select("cik", "name", "is_current",
                           F.date_format("valid_from", "yyyy").alias("f"),
                           F.date_format("valid_to", "yyyy").alias("t")))
    assert got == sorted([("1", "A", True, "2024", "9999"), ("2", "B", True, "2024", "9999"),
                          ("3", "C", False, "2024", "2025"), ("3", "C2", True, "2025", "9999"),
                          ("4", None, True, "2024", "9999"), ("5", "E", True, "2025", "9999")],
                         key=lambda t: tuple((x is None, str(x)) for x in t))


def test_scd2_vanished_untouched_and_history_kept(spark):
    dim = D.scd2_initial(_incoming(spark, [("1", "A", "10"), ("2", "B", "20")]), T0)
    snap1 = D.scd2_merge(dim, _incoming(spark, [("1", "A1", "10")]), T1)
    snap2 = D.scd2_merge(snap1, _incoming(spark, [("1", "A2", "10")]), T2)
    assert snap2.count() == 4
    assert rows(snap2.filter("cik = '2'"), "name", "is_current") == [("B", True)]
    cur = snap2.filter("is_current").groupBy("cik").count()
    assert all(r["count"] == 1 for r in cur.collect())
    v = rows(snap2.filter("cik = '1'").select(
        "name", F.date_format("valid_from", "yyyy-MM").alias("f"),
        F.date_format("valid_to", "yyyy-MM").alias("t")))
    # half-open intervals chain without gap or overlap
    assert v == [("A", "2024-01", "2025-01"), ("A1", "2025-01", "2025-06"),
                 ("A2", "2025-06", "9999-12")]


def test_scd2_rerun_is_stable(spark):
    inc = _incoming(spark, [("1", "A", "10"), ("2", "B", "20")])
    dim = D.scd2_initial(inc, T0)
    again = D.scd2_merge(dim, inc, T1)
    assert rows(again) == rows(dim)


def test_scd2_ids_distinct_per_version(spark):
    dim = D.scd2_initial(_incoming(spark, [("1", "A", "10")]), T0)
    snap = D.scd2_merge(dim, _incoming(spark, [("1", "B", "10")]), T1)
    assert snap.select("id").distinct().count() == 2


def test_company_source_keep_first(spark):
    sub = spark.createDataFrame([("0002", 7, "Later", "10-K", "1"), ("0001", 7, "First", "10-Q", "1")],
                                "adsh string, cik long, name string, form string, sic string")
    assert rows(D.company_source(sub)) == [("7", "First", "1")]


def test_insert_only_rerun_adds_nothing(spark):
    src = spark.createDataFrame([("a",), ("b",)], "date_key string")
    existing = spark.createDataFrame([(1, "a")], "id long, date_key string")
    delta = D.insert_only(existing, src, "date_key")
    assert rows(delta, "date_key") == [("b",)]
    nxt = D.append_rows(existing, delta)
    assert D.insert_only(nxt, src, "date_key").count() == 0


def test_tag_source_first_by_id(spark):
    tag = spark.createDataFrame([(3, "Rev", "v2", 0, "late"), (1, "Rev", "v1", 0, "early"),
                                 (2, None, "v1", 0, "x")],
                                "tag_id long, tag string, version string, custom int, label string")
    assert rows(D.tag_source(tag)) == [("Rev", "v1", 0, "early")]


def test_statement_source_labels(spark):
    pre = spark.createDataFrame([("IS",), ("BS",), ("XX",), (None,), ("IS",)], "stmt string")
    assert rows(D.statement_source(pre)) == [("BS", "Balance Sheet"), ("IS", "Income Statement"),
                                             ("XX", "Other")]


def test_calendar_reference_range(spark):
    cal = D.calendar_range(spark)
    assert cal.count() == 7670
    first = cal.orderBy("date").first()
    assert tuple(first) == ("2005-01-01", 2005, 1, 1, 1, None)


def test_calendar_from_data(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 27),), (dt.date(2020, 3, 1),)], "d date")
    assert [r["date"] for r in D.calendar_from(df, "d").orderBy("date").collect()] == [
        "2020-02-27", "2020-02-28", "2020-02-29", "2020-03-01"]


def test_metric_and_statement_label_dims(spark):
    tag = spark.createDataFrame([(1, "Rev", "v1"), (2, "Rev", "v1"), (3, "Rev", "v2")],
                                "tag_id long, tag string, version string")
    assert rows(D.metric_dim(tag)) == [("Rev", "v1", None, None, None), ("Rev", "v2", None, None, None)]
    pre = spark.createDataFrame([("IS", "a"), ("IS", "a"), (None, "b"), ("BS", None)],
                                "stmt string, plabel string")
    assert rows(D.statement_label_dim(pre)) == [("BS", None), ("IS", "a")]
