"""Column-level helpers: name rules, optional columns, dates, labels, text.

All of these build JVM-side Column expressions; nothing runs per row in Python.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: statement code -> statement name,
# with "Other" for any code not listed.
STATEMENT_NAMES = {"IS": "Income Statement", "BS": "Balance Sheet", "CF": "Cash Flow"}
STATEMENT_DEFAULT = "Other"
# Open upper bound of a current SCD2 version.
OPEN_END = "9999-12-31 00:00:00"
DATE_KEY_FORMAT = "yyyyMMdd"


# --- column names (P3, P4) ---------------------------------------------------
def standard_name(name: str) -> str:
    """strip -> blanks to '_' -> drop '.' -> lower, in that order."""
    return name.strip().replace(" ", "_").replace(".", "").lower()


def standardize_columns(df: DataFrame) -> DataFrame:
    names = [standard_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both standardize to {new!r}")
        seen[new] = old
    return df.toDF(*names)


# --- optional columns (P11, P12) ---------------------------------------------
def optional_column(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column if present, else a typed null, named ``name``."""
    if name in df.columns:
        return F.col(name).cast(dtype).alias(name)
    return F.lit(None).cast(dtype).alias(name)


# --- dates (F1, F2, F8, F9, F10) ---------------------------------------------
def parse_date_int(c: Column | str, strict: bool = False) -> Column:
    """int yyyyMMdd -> date. Lenient: bad or null -> null; strict: raise (ANSI)."""
    text = F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    if strict:
        return F.to_date(text, DATE_KEY_FORMAT)
    return F.try_to_date(text, DATE_KEY_FORMAT)


def date_key(c: Column | str) -> Column:
    """date/timestamp -> 'yyyyMMdd' string key."""
    return F.date_format(c, DATE_KEY_FORMAT)


def date_key_int(c: Column | str) -> Column:
    return date_key(c).cast("int")


def iso_date(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def rounded(c: Column | str, digits: int) -> Column:
    """round() with negative zero folded to zero (-0.0 + 0.0 = 0.0)."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


# --- code labels (F5) ---------------------------------------------------------
def code_label(c: Column | str, labels: Mapping[str, str] = STATEMENT_NAMES,
               default: str = STATEMENT_DEFAULT) -> Column:
    """Map a code through a small literal map, ``default`` when unmapped."""
    pairs = []
    for k, v in labels.items():
        pairs += [F.lit(k), F.lit(v)]
    mapping = F.create_map(*pairs)
    key = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_element_at(mapping, key), F.lit(default))


# --- text (F6, F7) -------------------------------------------------------------
def blank_if_null(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def join_texts(a: Column | str, b: Column | str, sep: str = "\n\n") -> Column:
    """a + sep + b with null parts as empty strings."""
    return F.concat(blank_if_null(a), F.lit(sep), blank_if_null(b))


# --- version bounds (F13, F14) -----------------------------------------------
def batch_timestamp(ts: str) -> Column:
    """One literal per run, so expiry and new validity share the same instant."""
    return F.lit(ts).cast("timestamp")


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def ts_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
