"""Small vector algebra over plain columns.

Feature vectors in this library are short and fixed-width, so they are kept as
separate double columns: the arithmetic stays in generated code and no vector
type has to be materialised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def safe_divide(num, den) -> Column:
    """F16: ``num / den`` with NULL for a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def dot(a: Sequence, b: Sequence) -> Column:
    return sum((_c(x) * _c(y) for x, y in zip(a, b, strict=True)), F.lit(0.0))


def norm(a: Sequence) -> Column:
    return F.sqrt(sum((_c(x) * _c(x) for x in a), F.lit(0.0)))


def cosine(a: Sequence, b: Sequence) -> Column:
    """cosine similarity of two equal-length column vectors.

    A zero vector gives 0.0 (it is normalised to the zero vector); NULL in any
    component gives NULL.
    """
    d = dot(a, b)
    den = norm(a) * norm(b)
    return F.when(den == 0.0, F.lit(0.0)).otherwise(d / den)


def lookup(col, mapping: dict) -> Column:
    """Dictionary value mapping; keys not in ``mapping`` give NULL."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _c(col) if not isinstance(col, str) else F.col(col))


def one_hot(col, categories: Sequence[str], prefix: str = "") -> list[Column]:
    """one 0/1 double column per category (fixed order); unknown -> all 0."""
    c = F.col(col) if isinstance(col, str) else col
    return [F.coalesce((c == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{prefix}{v}") for v in categories]
