"""Vector expressions (F15): dot product, norm, cosine distance.

Higher-order array functions keep the arithmetic in the JVM. Values are cast
to double first so results do not depend on float accumulation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _arr(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def vector_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_arr(a), _arr(b), lambda x, y: x * y),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    """Euclidean norm in one pass (no intermediate zipped array)."""
    return F.sqrt(F.aggregate(_arr(a), F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))


def literal_norm(values: Sequence[float]) -> float:
    """Norm of a literal vector, summed in the same order as ``norm``."""
    total = 0.0
    for v in values:
        total += float(v) * float(v)
    return math.sqrt(total)


def cosine_distance(a: Column | str, b: Column | str, b_norm: Column | None = None) -> Column:
    """1 - a.b / (|a| |b|); null when either vector has zero length.

    ``b_norm``: the norm of ``b`` when it is a constant (a literal query)."""
    denom = norm(a) * (b_norm if b_norm is not None else norm(b))
    return F.when(denom > 0, F.lit(1.0) - dot(a, b) / denom)


#: Distances closer than this many decimals count as equal when ranking: the last bits
#: of a float sum depend on the order of its terms, which no shuffle fixes.
TIE_DIGITS = 12


def ranking(distance: Column | str, *then: Column | str) -> list[Column]:
    """Order of search results: nearest first, then by ``then``; no distance comes last."""
    c = F.col(distance) if isinstance(distance, str) else distance
    return [F.asc_nulls_last(F.round(c, TIE_DIGITS)),
            *[F.col(t) if isinstance(t, str) else t for t in then]]
