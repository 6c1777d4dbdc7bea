"""Fixed schemas of the bronze, silver and gold tables.

Bronze tables are read with these schemas (no inference). Gold tables carry a
surrogate ``id`` derived from the natural key (see ``functions.keys``), so ids
are stable across runs and need no global numbering.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# --- bronze -----------------------------------------------------------------
SUB = _schema(
    ("adsh", StringType(), False),
    ("cik", LongType(), True),
    ("name", StringType(), True),
    ("form", StringType(), True),
    ("sic", StringType(), True),
    ("filing_summary", StringType(), True),
)
TAG = _schema(
    ("tag_id", LongType(), True),
    ("tag", StringType(), True),
    ("version", StringType(), True),
    ("custom", IntegerType(), True),
    ("label", StringType(), True),
)
PRE = _schema(
    ("pre_id", LongType(), True),
    ("adsh", StringType(), True),
    ("stmt", StringType(), True),
    ("tag_id", LongType(), True),
)
# ``ddate`` comes as text: what doesn't parse as yyyyMMdd is rejected row by row.
NUM = _schema(
    ("num_id", LongType(), True),
    ("adsh", StringType(), True),
    ("tag_id", LongType(), True),
    ("version", StringType(), True),
    ("ddate", StringType(), True),
    ("qtrs", IntegerType(), True),
    ("value", DoubleType(), True),
)
# Columns a bronze file must have; the others may be missing and are null then.
REQUIRED = {"sub": ("adsh", "cik"), "tag": ("tag_id", "tag"), "pre": ("adsh", "tag_id", "stmt"),
            "num": ("adsh", "tag_id", "value")}
BRONZE = {"sub": SUB, "tag": TAG, "pre": PRE, "num": NUM}

# --- gold -------------------------------------------------------------------
COMPANY_DIM = _schema(
    ("id", LongType(), False),
    ("cik", StringType(), False),
    ("name", StringType(), True),
    ("sic", StringType(), True),
    ("valid_from", TimestampType(), False),
    ("valid_to", TimestampType(), False),
    ("is_current", BooleanType(), False),
)
FILING_DIM = _schema(
    ("id", LongType(), False),
    ("accession_number", StringType(), False),
    ("form_type", StringType(), True),
    ("period_of_report", StringType(), True),
    ("date_filed", StringType(), True),
)
TAG_DIM = _schema(
    ("id", LongType(), False),
    ("tag", StringType(), False),
    ("version", StringType(), True),
    ("custom", IntegerType(), True),
    ("label", StringType(), True),
)
DATE_DIM = _schema(
    ("id", LongType(), False),
    ("date_key", StringType(), False),
)
STATEMENT_DIM = _schema(
    ("id", LongType(), False),
    ("statement_code", StringType(), False),
    ("statement_name", StringType(), False),
)
FACT = _schema(
    ("value", DoubleType(), True),
    ("filing_id", LongType(), True),
    ("company_id", LongType(), True),
    ("tag_id", LongType(), True),
    ("date_id", LongType(), True),
    ("statement_id", LongType(), True),
)
GOLD = {
    "companydim": COMPANY_DIM,
    "filingdim": FILING_DIM,
    "tagdim": TAG_DIM,
    "datedim": DATE_DIM,
    "statementdim": STATEMENT_DIM,
    "factfinancials": FACT,
}

# --- search -----------------------------------------------------------------
def vector_doc_schema(dim: int | None = None) -> StructType:
    """Search document; ``dim`` is checked by ``operators.quality.vector_length``."""
    return _schema(
        ("id", StringType(), False),
        ("cik", StringType(), True),
        ("name", StringType(), True),
        ("form", StringType(), True),
        ("filing_summary", StringType(), True),
        ("extracted_pdf_text", StringType(), True),
        ("embedding", ArrayType(FloatType(), False), False),
    )


CHANGE_FIELDS = ("name", "form", "sic", "filing_summary")
