from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def slots_to_rows(
    df: DataFrame,
    keep: Sequence[str],
    slots: Mapping[str, Sequence[str]],
    label: str,
    into: Sequence[str],
) -> DataFrame:
    """Turn column groups into rows in one pass over the input.

    ``slots`` maps a label to the columns of its group, in the order of ``into``. A group whose
    first column is null gives no row.
    """
    cells = [
        cell for name, columns in slots.items() for cell in (F.lit(name), *map(F.col, columns))
    ]
    rows = df.select(*keep, F.stack(F.lit(len(slots)), *cells).alias(label, *into))
    return rows.filter(F.col(into[0]).isNotNull())
