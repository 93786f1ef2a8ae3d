"""Newest row per key and batch-versioned dimensions.

A window keeps all rows of its partition key in one task, so neither window here may see a
whole natural key unless its size is proven:

* the newest row per (key, version) is cut down in the map tasks before the shuffle (Spark's
  window group limit), so a hot key or a repeated load ships one row per map task and version;
* the next version is looked up over at most one row per (key, version). With a proven span of
  versions that is small enough for one task; without, the version axis is cut into slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotbook.functions import surrogate_key

# One key may bring this many versions into one task.
VERSIONS_PER_TASK = 1_000_000
SLICE_WIDTH = 65_536


def version_span(df: DataFrame, version: str) -> int:
    """How many versions there are, a null one among them: the most that one key can have. Runs
    a one-column scan; versions are told apart in the map tasks."""
    return version_spans({"": df}, version)[""]


def version_spans(tables: Mapping[str, DataFrame], version: str) -> dict[str, int]:
    """:func:`version_span` of several tables in one job."""
    arms = [df.select(F.lit(name).alias("name"), version) for name, df in tables.items()]
    found = reduce(DataFrame.unionByName, arms).distinct().groupBy("name").count()
    counts = {r["name"]: r["count"] for r in found.collect()}
    return {name: counts.get(name, 0) for name in tables}


def slice_of(version: str) -> Column:
    return F.expr(f"`{version}` div {SLICE_WIDTH}L")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: str, tie_break: Sequence[str]
) -> DataFrame:
    """One row per key: the newest, and among equally new ones the greatest by ``tie_break``.

    The tie break should name all remaining columns: then rows that still tie are equal and
    the result does not depend on row order or partitioning.
    """
    order = [F.col(c).desc_nulls_last() for c in (newest, *tie_break)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def with_next_version(
    df: DataFrame,
    key: str,
    version: str,
    into: str,
    span: int | None = None,
    versions_of: DataFrame | None = None,
) -> DataFrame:
    """Add the following version of the same key; a null version counts as the last.

    ``df`` holds one row per (key, version). ``versions_of`` may name a cheaper frame with the
    same keys and versions, repeated or not.
    """
    last_null = F.col(version).asc_nulls_last()
    if span is not None and span <= VERSIONS_PER_TASK:
        return df.withColumn(into, F.lead(version).over(Window.partitionBy(key).orderBy(last_null)))

    part = slice_of(version)
    heads = (
        (df if versions_of is None else versions_of)
        .select(key, version)
        .groupBy(key, part.alias("_slice"))
        .agg(F.min(version).alias("_head"))
    )
    following = F.lead("_head").over(
        Window.partitionBy(key).orderBy(F.col("_slice").asc_nulls_last())
    )
    # The first version of the next slice stands in as a guard row at the end of this one.
    guards = heads.select(
        key, "_slice", following.alias(version), F.lit(True).alias("_guard")
    ).filter(F.col(version).isNotNull())
    rows = df.withColumns({"_slice": part, "_guard": F.lit(False)})
    return (
        rows.unionByName(guards, allowMissingColumns=True)
        .withColumn(
            into, F.lead(version).over(Window.partitionBy(key, "_slice").orderBy(last_null))
        )
        .filter(~F.col("_guard"))
        .drop("_slice", "_guard")
    )


def versioned_dimension(
    df: DataFrame,
    sk: str,
    key: str,
    attributes: Sequence[str],
    version: str = "batch_number",
    newest: str = "_ingested_at_utc",
    span: int | None = None,
) -> DataFrame:
    """One row per key and version, valid until the version before the next one.

    ``span`` is a proven bound from :func:`version_span`; None means unbounded. Without attributes
    all rows of a key and version are alike.
    """
    if attributes:
        rows = df.select(key, version, *attributes, newest)
        kept = latest_per_key(rows, [key, version], newest, attributes).drop(newest)
    else:
        kept = df.select(key, version).distinct()
    following = F.col("_next")
    return with_next_version(kept, key, version, "_next", span, versions_of=df).select(
        surrogate_key(key, version).alias(sk),
        key,
        version,
        *attributes,
        F.col(version).alias("valid_from_batch"),
        (following - 1).alias("valid_to_batch"),
        following.isNull().alias("is_current"),
    )
