import re

import pytest

from ledgerline.operators.changes import list_page
from ledgerline.operators.paging import PagedTable


def frame(spark):
    return spark.createDataFrame(
        [(f"k{i * 7919 % 3000:05d}" if i % 11 else None, i % 40, i) for i in range(3000)]
        + [("k00500", 1, i) for i in range(200)], "adsh string, a int, b long").repartition(5)


@pytest.mark.parametrize("skip,limit", [(0, 100), (2700, 100), (250, 30), (600, 500), (3190, 50),
                                        (3200, 10), (5000, 10), (10, 0)])
def test_same_rows_as_sorting_everything(spark, skip, limit):
    df = frame(spark)
    table = PagedTable(df, ["adsh"])
    want = list_page(df, skip, limit, ["adsh", "a", "b"]).collect()
    assert table.page(skip, limit).collect() == want
    table.release()


def test_a_deep_page_reads_a_small_part(spark):
    table = PagedTable(frame(spark), ["adsh"])
    assert table.rows == 3200
    assert sum(b - a for a, b, _ in table.ranges_of(2880, 20)) < 0.05 * table.rows
    plan = table.page(2880, 20)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_range", plan)


def test_empty_table(spark):
    table = PagedTable(frame(spark).limit(0), ["adsh"])
    assert table.rows == 0 and table.page().collect() == []
