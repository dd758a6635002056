"""JSON field extraction on raw post lines.

``try_parse_json`` turns malformed documents into NULL instead of failing the
task, and ``try_variant_get`` casts numbers, numeric strings and booleans to the
requested type (NULL otherwise), which is exactly the forgiving behaviour the
post parser needs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def json_double(value, path: str = "$.like_count", default: float | None = 0.0) -> Column:
    """numeric field of a JSON document; unreadable document, missing key,
    JSON null or non-numeric value -> ``default``."""
    got = F.try_variant_get(F.try_parse_json(_col(value)), path, "double")
    return got if default is None else F.coalesce(got, F.lit(float(default)))


def json_string(value, path: str) -> Column:
    """string field of a JSON document (missing -> NULL)."""
    return F.try_variant_get(F.try_parse_json(_col(value)), path, "string")


def json_string_array(value, path: str) -> Column:
    """array<string> field of a JSON document (missing -> NULL)."""
    return F.try_variant_get(F.try_parse_json(_col(value)), path, "array<string>")
