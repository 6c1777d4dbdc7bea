from ledgerline.operators import changes as C
from conftest import rows

SCHEMA = "adsh string, cik long, name string, form string, sic string, filing_summary string"


def _raw(spark):
    return spark.createDataFrame([("a", 1, "A", "10-K", "1", "s"), ("b", 2, "B", "10-Q", "2", "t"),
                                  (None, 3, "N", "8-K", "3", None)], SCHEMA)


def test_create_row_level_and_conflicts(spark):
    batch = spark.createDataFrame([("b", 2, "B", "10-Q", "2", ""), ("c", 4, "C", "10-K", "4", ""),
                                   ("d", 5, "D", "10-K", "5", ""), ("d", 5, "D", "10-K", "5", "")],
                                  SCHEMA)
    res = C.create_rows(_raw(spark), batch)
    assert rows(res.conflicts) == [("b", "exists"), ("d", "duplicate_in_batch")]
    assert rows(res.accepted, "adsh") == [("c",)]
    assert res.table.count() == 4


def test_create_all_or_nothing(spark):
    batch = spark.createDataFrame([("b", 2, "B", "10-Q", "2", ""), ("c", 4, "C", "10-K", "4", "")],
                                  SCHEMA)
    res = C.create_rows(_raw(spark), batch, all_or_nothing=True)
    assert res.table.count() == 3 and res.accepted.count() == 0
    ok = C.create_rows(_raw(spark), batch.filter("adsh = 'c'"), all_or_nothing=True)
    assert ok.table.count() == 4


UPDATE = "update_no int, adsh string, name string, form string, sic string, " \
         "filing_summary string, set_fields array<string>"


def test_update_set_null_vs_unset(spark):
    upd = spark.createDataFrame(
        [(1, "a", None, "AMENDED", None, None, ["form", "sic"]),
         (2, "zz", "X", None, None, None, ["name"])], UPDATE)
    table, missing = C.apply_updates(_raw(spark), upd)
    got = {r["adsh"]: r for r in table.collect()}
    assert (got["a"]["name"], got["a"]["form"], got["a"]["sic"]) == ("A", "AMENDED", None)
    assert got["b"]["form"] == "10-Q"
    assert rows(missing) == [("zz",)]


def test_delete_and_not_found(spark):
    keys = spark.createDataFrame([("a",), ("zz",), (None,)], "adsh string")
    table, missing = C.delete_rows(_raw(spark), keys)
    assert rows(table, "adsh") == [("b",), (None,)]   # null-keyed rows stay
    assert rows(missing) == [("zz",)]


def test_page_and_get(spark):
    raw = _raw(spark)
    assert [r["adsh"] for r in C.list_page(raw, 1, 1).collect()] == ["a"]   # nulls first
    keys = spark.createDataFrame([("a",), ("q",)], "adsh string")
    got = rows(C.get_rows(raw, keys), "adsh", "found", "name")
    assert got == [("a", True, "A"), ("q", False, None)]


def test_updates_of_one_key_are_merged_in_order(spark):
    upd = spark.createDataFrame(
        [(2, "a", None, "Y", None, None, ["form"]), (1, "a", "N1", "X", "9", None,
                                                     ["name", "form", "sic"]),
         (3, "a", None, None, None, None, ["sic"]), (4, "a", None, "ignored", None, None, [])],
        UPDATE)
    table, _ = C.apply_updates(_raw(spark), upd)
    assert table.count() == 3
    a = table.filter("adsh = 'a'").first()
    assert (a["name"], a["form"], a["sic"], a["filing_summary"]) == ("N1", "Y", None, "s")


def test_updates_need_an_order(spark):
    import pytest
    with pytest.raises(ValueError, match="order column"):
        C.apply_updates(_raw(spark), spark.createDataFrame([], UPDATE).drop("update_no"))
