"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys must hash to the same text as in existing warehouses.
NULL_TEXT = "__dbt_null__"
SEPARATOR = "|"


def surrogate_key(*columns: str) -> Column:
    """md5 over columns (or SQL expressions) as text. Use whole numbers and strings only: the
    text form of a floating point number differs between engines."""
    texts = [f"coalesce(cast({column} as string), '{NULL_TEXT}')" for column in columns]
    return F.expr(f"md5(concat_ws('{SEPARATOR}', {', '.join(texts)}))")
