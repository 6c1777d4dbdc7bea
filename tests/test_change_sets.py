import os

import pytest
from conftest import rows

from ledgerline.operators import changes
from ledgerline.operators.change_sets import ChangeTable
from ledgerline.sources.sinks import Superseded, Warehouse

SCHEMA = "adsh string, cik long, name string, form string, sic string"


def raw(spark, n=400):
    return spark.createDataFrame(
        [(f"k{i:04d}", i % 7, f"n{i}", "10-K", "1") for i in range(n)] + [(None, 1, "no key", "f", "1")],
        SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"raw": raw(spark).schema}, parted={"raw": ("adsh", 16)})
    out = ChangeTable(wh, "raw")
    out.load(raw(spark))
    return out


def updates(spark, *data):
    return spark.createDataFrame(
        list(data), "adsh string, update_no int, name string, form string, sic string, "
        "filing_summary string, set_fields array<string>")


def files(table):
    return {f.split("/parts/")[1]: os.stat(f.replace("file://", "")).st_mtime_ns
            for f in table.rows().inputFiles()}


def test_an_update_rewrites_its_parts_alone(spark, table):
    before = files(table)
    upd = updates(spark, ("k0007", 1, "new", None, None, None, ["name"]),
                  ("k0007", 2, None, "8-K", None, None, ["form", "sic"]),
                  ("gone", 1, "x", None, None, None, ["name"]))
    done = table.update(upd)
    assert len(done.touched) <= 2
    want, missing = changes.apply_updates(raw(spark), upd)
    assert rows(table.rows()) == rows(want)
    assert rows(done.problems) == rows(missing) == [("gone",)]
    after = files(table)
    part = lambda f: int(f.split("_part=")[1].split("/")[0])
    for f, at in before.items():
        assert (part(f) in done.touched) or after.pop(f) == at
    assert {part(f) for f in after} <= set(done.touched)  # nothing else was written


def test_creates_and_deletes_as_on_the_whole_table(spark, table):
    batch = spark.createDataFrame([("new1", 1, "a", "f", "s"), ("new2", 1, "a", "f", "s"),
                                   ("new2", 2, "b", "f", "s"), ("k0001", 9, "z", "f", "s")], SCHEMA)
    made = changes.create_rows(raw(spark), batch)
    done = table.create(batch)
    assert rows(table.rows()) == rows(made.table)
    assert rows(done.problems) == rows(made.conflicts)
    keys = spark.createDataFrame([("k0001",), ("k0001",), ("never",), (None,)], "adsh string")
    want, missing = changes.delete_rows(table.rows(), keys)
    want = rows(want)
    done = table.delete(keys)
    assert rows(table.rows()) == want and rows(done.problems) == rows(missing) == [("never",)]


def test_emptied_parts_older_versions_and_no_changes(spark, table):
    first = table.wh.current_version()
    assert table.delete(raw(spark).select("adsh").limit(0)).touched == []
    assert table.wh.current_version() == first
    table.delete(raw(spark).select("adsh"))
    assert rows(table.rows()) == [(None, 1, "no key", "f", "1")]
    assert rows(table.rows(first)) == rows(raw(spark))  # an older version stays readable
    table.create(raw(spark).filter("adsh = 'k0003'"))
    assert table.rows().count() == 2


def test_replace_takes_the_rows_of_its_keys(spark, table):
    keys = spark.createDataFrame([("k0001",), ("k0002",)], "adsh string")
    table.replace(keys, raw(spark).filter("adsh = 'k0001'").selectExpr(
        "adsh", "cast(99 AS long) cik", "name", "form", "sic"))
    got = {r["adsh"]: r["cik"] for r in table.rows().collect()}
    assert got["k0001"] == 99 and "k0002" not in got and len(got) == 400
    with pytest.raises(ValueError, match="not being replaced"):
        table.replace(keys, raw(spark))


def test_the_second_of_two_writers_is_told(spark, table):
    wh, parent = table.wh, table.wh.current_version()
    entries = wh.stage_parts("raw", wh.parts("raw", [3], parent), [3], "zz")
    table.update(updates(spark, ("k0007", 1, "new", None, None, None, ["name"])))
    with pytest.raises(Superseded):
        wh.mark("zz", entries, parent)
    assert table.rows().filter("name = 'new'").count() == 1


def test_a_hot_key_and_an_empty_table(spark, tmp_path):
    hot = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END adsh",
                                       "id cik", "'n' name", "'f' form", "'s' sic")
    wh = Warehouse(spark, str(tmp_path / "hot"), {"raw": hot.schema}, parted={"raw": ("adsh", 8)})
    table = ChangeTable(wh, "raw")
    table.load(hot.limit(0))
    assert table.rows().count() == 0
    table.load(hot)
    assert rows(table.rows()) == rows(hot)
    table.delete(spark.createDataFrame([("hot",)], "adsh string"))
    assert table.rows().count() == 2000
