import pytest
from conftest import rows

from ledgerline.operators import fact_changes
from ledgerline.plans import pipeline


def silver(spark, num, sub, tag, pre=None):
    pre = pre if pre is not None else sorted({(a, "IS", t) for a, t, *_ in num}, key=str)
    return {
        "sub": spark.createDataFrame(sub, "adsh string, cik long, name string, form string, sic string, "
                                          "filing_summary string"),
        "num": spark.createDataFrame(num, "adsh string, tag_id long, day string, value double")
        .selectExpr("adsh", "tag_id", "cast(day AS date) ddate", "1 AS qtrs", "value"),
        "pre": spark.createDataFrame(pre, "adsh string, stmt string, tag_id long"),
        "tag": spark.createDataFrame(tag, "tag_id long, tag string, version string, custom int, "
                                          "label string"),
    }


def sub(n, **changes):
    return [(f"f{i}", i % 5, changes.get(f"c{i % 5}", f"co{i % 5}"), "10-K", "1", None) for i in range(n)]


NUM = [(f"f{i}", t, "2024-01-0%d" % (1 + t), float(i * 10 + t)) for i in range(60) for t in (1, 2)] \
    + [("f1", 1, "2024-01-02", 11.0), (None, 1, "2024-01-02", 1.0), ("f2", None, "2024-01-02", 1.0)]
TAG = [(1, "Revenues", "v", 0, "l"), (2, "Assets", "v", 0, "l"), (3, "Cash", "v", 0, "l")]


@pytest.mark.parametrize("case,rebuilt", [("rows", 5), ("company", 12), ("tag", 60)])
def test_second_load_equals_a_full_reload(spark, tmp_path, case, rebuilt):
    first = silver(spark, NUM, sub(60), TAG)
    num, subs, tag, pre = list(NUM), sub(60), list(TAG), None
    if case == "rows":  # another value, a repeated row, a filing gone, a new one, a statement
        num[6] = (*num[6][:3], 999.0)
        num += [num[8], ("f60", 3, "2024-02-01", 5.0)]
        num, subs = [r for r in num if r[0] != "f7"], [r for r in sub(61) if r[0] != "f7"]
        pre = sorted({(a, "BS" if a == "f9" else "IS", t) for a, t, *_ in num}, key=str)
    elif case == "company":
        subs = sub(60, c3="renamed")
    elif case == "tag":
        tag[0] = (1, "Sales", "v", 0, "l")
    second = silver(spark, num, subs, tag, pre)
    wh = pipeline.gold_warehouse(spark, str(tmp_path / "parts"), fact_parts=16)
    full = pipeline.gold_warehouse(spark, str(tmp_path / "full"))
    for load, at in ((first, "2024-01-01 00:00:00"), (second, "2025-01-01 00:00:00")):
        report = pipeline.publish_gold(load, wh, at)
        pipeline.publish_gold(load, full, at)
        for name in ("factfinancials", "companydim", "tagdim"):
            assert rows(wh.table(name)) == rows(full.table(name)), name
    assert report.filings_rebuilt == rebuilt
    assert report.fact_parts <= min(rebuilt, 16)
    if case == "rows":
        same = pipeline.publish_gold(second, wh, "2026-01-01 00:00:00")
        assert (same.filings_rebuilt, same.fact_parts) == (0, 0)
        assert rows(wh.table("factfinancials")) == rows(full.table("factfinancials"))


def test_order_does_not_change_a_digest_and_null_is_not_skipped(spark):
    companies = spark.createDataFrame([], "id long, cik string, is_current boolean")
    one = silver(spark, NUM, sub(60), TAG)
    two = {**one, "num": one["num"].repartition(7)}
    a, b = (fact_changes.digests(s, companies) for s in (one, two))
    assert fact_changes.changed_filings(a, b, one["num"]).count() == 0
    moved = {**one, "num": one["num"].selectExpr(
        "adsh", "tag_id", "ddate", "qtrs", "CASE WHEN adsh = 'f3' THEN null ELSE value END AS value")}
    c = fact_changes.digests(moved, companies)
    assert rows(fact_changes.changed_filings(a, c, one["num"])) == [("f3",)]
