"""Raw text to typed, cleaned columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lotbook.functions.dates import date_sql
from lotbook.functions.text import blank_to_null_sql
from lotbook.plans.entities import DAY, ENTITIES, LINEAGE, SQL_TYPES, TEXT, Field


def typed_sql(field: Field, lenient: bool = False, strict_dates: bool = False) -> str:
    text = blank_to_null_sql(f"`{field.raw}`")
    if field.kind == DAY:
        day = date_sql(f"`{field.raw}`")
        if not strict_dates:
            return day
        refused = f"raise_error('{field.raw}: no date form fits ' || {text})"
        return f"coalesce({day}, if({text} is null, null, cast({refused} as date)))"
    if field.kind == TEXT:
        return text
    return f"{'try_cast' if lenient else 'cast'}({text} as {SQL_TYPES[field.kind]})"


def conform(
    raw: DataFrame, entity: str, lenient: bool = False, strict_dates: bool = False
) -> DataFrame:
    """One select: clean, cast and rename by name, keep the lineage columns.

    A number that does not parse fails the job (``lenient``: gives null). A date that fits no
    form gives null and is left to the not-null checks (``strict_dates``: fails the job); a blank
    one gives null.
    """
    columns = [
        f"{typed_sql(field, lenient, strict_dates)} as `{field.typed}`"
        for field in ENTITIES[entity]
    ]
    return raw.selectExpr(*columns, *LINEAGE)
