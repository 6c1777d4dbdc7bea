import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import columns as C


def test_standardize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["  Company Name ", "Form.Type", "SIC"])
    assert C.standardize_columns(df).columns == ["company_name", "formtype", "sic"]


def test_standardize_columns_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "A_B"])
    with pytest.raises(ValueError):
        C.standardize_columns(df)


def test_parse_date_int_lenient(spark):
    df = spark.createDataFrame([(20230131,), (20231340,), (None,)], "d int")
    out = [r[0] for r in df.select(C.parse_date_int("d")).collect()]
    assert out == [dt.date(2023, 1, 31), None, None]


def test_parse_date_int_strict_raises(spark):
    df = spark.createDataFrame([(20231340,)], "d int")
    with pytest.raises(Exception):
        df.select(C.parse_date_int("d", strict=True)).collect()


def test_date_key_and_iso(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 9),)], "d date")
    r = df.select(C.date_key("d"), C.iso_date("d")).first()
    assert tuple(r) == ("20240209", "2024-02-09")


def test_code_label_default(spark):
    df = spark.createDataFrame([("IS",), ("BS",), ("CF",), ("XX",), (None,)], "c string")
    out = [r[0] for r in df.select(C.code_label("c")).collect()]
    assert out == ["Income Statement", "Balance Sheet", "Cash Flow", "Other", "Other"]


def test_join_texts_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    out = [r[0] for r in df.select(C.join_texts("x", "y")).collect()]
    assert out == ["a\n\n", "\n\nb"]


def test_optional_column(spark):
    df = spark.createDataFrame([("t",)], "tlabel string")
    r = df.select(C.optional_column(df, "tlabel"), C.optional_column(df, "iord")).first()
    assert tuple(r) == ("t", None)


def test_rounded_folds_negative_zero(spark):
    r = spark.range(1).select(C.rounded(F.lit(-1e-17), 6).alias("x")).first()
    assert str(r["x"]) == "0.0"
