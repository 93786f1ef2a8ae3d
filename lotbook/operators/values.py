from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotbook.functions import fold, surrogate_key


def value_dimension(sources: Sequence[tuple[DataFrame, str]], sk: str, name: str) -> DataFrame:
    """Distinct folded values of one column per source, with a key.

    One distinct over the union: it is cut down in the map tasks, so a value that fills a third
    of the rows ships once per task.
    """
    arms = [df.select(fold(F.col(column)).alias(name)) for df, column in sources]
    values = reduce(DataFrame.unionByName, arms).filter(F.col(name) != "").distinct()
    return values.select(surrogate_key(name).alias(sk), name)
