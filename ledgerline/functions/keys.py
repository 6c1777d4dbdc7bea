"""Surrogate keys.

Ids are a 64-bit hash of the natural key (plus ``valid_from`` for versioned
rows). Every partition computes them locally: no global numbering, no
single-partition exchange, and the same row gets the same id on every run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column | str) -> Column:
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])
