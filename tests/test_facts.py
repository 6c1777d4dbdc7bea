import datetime as dt

from ledgerline.operators.totals import company_totals
from ledgerline.plans import star
from conftest import rows

D1 = dt.date(2024, 3, 31)


def _silver(spark):
    sub = spark.createDataFrame(
        [("f1", 1, "Acme", "10-K", "1000", None), ("f2", 2, "Beta", "10-Q", "2000", None)],
        "adsh string, cik long, name string, form string, sic string, filing_summary string")
    tag = spark.createDataFrame([(10, "Rev", "v", 0, "Revenue"), (11, "Cost", "v", 0, "Cost"),
                                 (12, "Rev", "v", 0, "Revenue again")],
                                "tag_id long, tag string, version string, custom int, label string")
    pre = spark.createDataFrame([("f1", "IS", 10), ("f1", "BS", 10), ("f2", "IS", 11)],
                                "adsh string, stmt string, tag_id long")
    num = spark.createDataFrame([("f1", 10, D1, 4, 100.0), ("f2", 11, D1, 1, 5.0),
                                 ("f2", 12, D1, 1, 7.0), ("f9", 10, D1, 1, 1.0)],
                                "adsh string, tag_id long, ddate date, qtrs int, value double")
    return {"sub": sub, "tag": tag, "pre": pre, "num": num}


def test_fact_fans_out_and_drops_unmatched(spark):
    silver = _silver(spark)
    dims = star.first_load_dimensions(silver, "2024-01-01 00:00:00")
    f = star.fact(silver, dims, natural_keys=True)
    # f1/10 matches two pre rows (IS, BS); f2/12 has no pre row; f9 has no filing
    assert rows(f, "adsh", "stmt", "tag", "value") == [
        ("f1", "BS", "Rev", 100.0), ("f1", "IS", "Rev", 100.0), ("f2", "IS", "Cost", 5.0)]
    ids = star.fact(silver, dims)
    assert ids.columns == ["value", "filing_id", "company_id", "tag_id", "date_id", "statement_id"]
    assert ids.dropna().count() == 3


def test_fact_left_keeps_rows_without_statement(spark):
    silver = _silver(spark)
    dims = star.first_load_dimensions(silver, "2024-01-01 00:00:00")
    f = star.fact_left(silver, dims, natural_keys=True)
    assert rows(f, "adsh", "tag", "stmt", "value") == [
        ("f1", "Rev", "BS", 100.0), ("f1", "Rev", "IS", 100.0), ("f2", "Cost", "IS", 5.0),
        ("f2", "Rev", None, 7.0)]


def test_totals_on_star(spark):
    silver = _silver(spark)
    dims = star.first_load_dimensions(silver, "2024-01-01 00:00:00")
    got = rows(company_totals(star.fact(silver, dims), dims["companydim"]))
    assert got == [("Acme", 200.0), ("Beta", 5.0)]


def test_totals_limit_and_tie_break(spark):
    fact = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0)], "company_id long, value double")
    comp = spark.createDataFrame([(1, "B"), (2, "A"), (3, "C")], "id long, name string")
    got = [tuple(r) for r in company_totals(fact, comp, limit=2).collect()]
    assert got == [("A", 5.0), ("B", 5.0)]


def test_incremental_dims_rerun_identical(spark):
    silver = _silver(spark)
    gold = star.first_load_dimensions(silver, "2024-01-01 00:00:00")
    again = star.dimensions(silver, gold, "2025-01-01 00:00:00")
    for name in gold:
        assert rows(again[name]) == rows(gold[name]), name


def test_facts_by_ids_are_not_shuffled_by_tag(spark):
    """Presentation rows look their tags up; no exchange by tag carries the facts' values."""
    def shuffled(node):
        plan = node.initialPlan() if "Adaptive" in node.nodeName() else node
        own = [] if "Exchange" not in plan.nodeName() else [
            (plan.outputPartitioning().toString(), plan.output().mkString(" "))]
        children = plan.children()
        return own + [s for i in range(children.size()) for s in shuffled(children.apply(i))]

    silver = _silver(spark)
    dims = star.first_load_dimensions(silver, "2024-01-01 00:00:00")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = star.fact(silver, dims)
        found = shuffled(facts._jdf.queryExecution().executedPlan())
        assert found and [out for by, out in found if "(tag_id" in by]
        assert not [out for by, out in found if "(tag_id" in by and "value#" in out]
        assert sorted(r.value for r in facts.collect()) == [5.0, 100.0, 100.0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
