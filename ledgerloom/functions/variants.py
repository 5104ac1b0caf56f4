"""Values inside JSON texts of any shape."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_path(text: Column, path: str, kind: str = "string") -> Column:
    """The value at ``path`` (``$.a.b[3]``) as ``kind``; null where a step is missing, of another shape, or unreadable."""
    return F.try_variant_get(F.try_parse_json(text), path, kind)
