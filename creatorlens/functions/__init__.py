"""Column-expression builders.  Everything here returns a ``Column`` built from
Spark's native functions, so it stays inside whole-stage codegen or Spark's
interpreted higher-order functions - never a Python UDF."""

from creatorlens.functions.json import json_double, json_string, json_string_array  # noqa: F401
from creatorlens.functions.text import (  # noqa: F401
    clean_text, count_occurrences, count_present, keyword_token_count, occurrence_total,
    remove_mentions, remove_urls, keep_letters, tokens, format_score, profile_url,
)
from creatorlens.functions.vector import cosine, dot, lookup, norm, one_hot, safe_divide  # noqa: F401
