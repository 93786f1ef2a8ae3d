"""Resolving foreign keys against dimensions.

A dimension is broadcast by hint only when the caller has counted it (``dim_rows``) and it is
small. With an uncounted one the join sorts and merges, as Catalyst knows neither the size of rows
made from slots nor that of a dimension: it would take the size of the packed files the dimension is
made from, less the columns not read, and broadcast millions of rows. AQE splits the partitions of
hot keys in such joins.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotbook.functions import surrogate_key
from lotbook.session import written

# With so few versions per key, testing each of them is cheaper than a second pass.
FEW_VERSIONS = 64
# Counted dimensions up to here are broadcast: some 100 bytes a row, so well below 100 MB.
BROADCAST_ROWS = 500_000


def exact_version(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    take: Mapping[str, str],
    version: str = "batch_number",
    how: str = "left",
    dim_rows: int | None = None,
    spread: int = 1,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Add dimension columns (``take``: name in dim -> new name) of the same key and version.

    The dimension holds a key and version once, so rows are neither lost (left) nor multiplied.
    ``spread`` > 1 salts the join for clusters without AQE: each key's rows go to that many
    tasks, chosen by a hash of ``spread_by`` so that a recomputed task chooses alike.
    """
    on = [key, version]
    found = dim.select(*on, *(F.col(old).alias(new) for old, new in take.items()))
    if spread > 1:
        on = [*on, "_salt"]
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(spread)))
        salts = F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))
        found = found.withColumn("_salt", F.explode(salts))
    df, found = _with_strategy(df, found, dim_rows)
    return df.join(found, on, how).drop("_salt")


def own_version(key: str, sk: str, version: str = "batch_number") -> Column:
    """The key under which a row's own dimension holds it, without a join.

    A dimension built from these very rows holds each of their (key, version) pairs, and its
    surrogate key is a function of the pair. The lookup would shuffle both sides to find what
    the row already says. As in a join, a missing key or version finds nothing.
    """
    known = F.col(key).isNotNull() & F.col(version).isNotNull()
    return F.when(known, surrogate_key(key, version)).alias(sk)


def asof_version(
    df: DataFrame,
    dim: DataFrame,
    key: Sequence[str],
    take: Mapping[str, str],
    version: str = "batch_number",
    span: int | None = None,
    dim_rows: int | None = None,
) -> DataFrame:
    """Add columns of the newest dimension version not later than the row's own version.

    Rows without such a version are dropped. ``span`` is a proven bound on versions per key:
    when it is small, each row is tested against the validity range of its key's few versions.
    Otherwise that would meet every version of a hot key with every row of it, so rows and versions
    are put in one order and the last version is carried along; that runs when it is called.
    """
    if span is not None and span <= FEW_VERSIONS:
        starts, ends = F.col("_starts"), F.col("_ends")
        ranges = dim.select(
            *key,
            F.col("valid_from_batch").alias("_starts"),
            F.col("valid_to_batch").alias("_ends"),
            *(F.col(old).alias(new) for old, new in take.items()),
        )
        df, ranges = _with_strategy(df, ranges, dim_rows)
        left, right = df.alias("_row"), ranges.alias("_range")
        at = F.col(f"_row.{version}")
        met = [F.col(f"_row.{k}") == F.col(f"_range.{k}") for k in key]
        valid = (starts <= at) & (ends.isNull() | (at <= ends))
        joined = left.join(right, reduce(Column.__and__, met, valid), "inner")
        return joined.select("_row.*", *take.values())

    # The row's own columns in their order, then the taken ones, whichever way they were found.
    return _carry(df, dim, key, take, version).select(*df.columns, *take.values())


def _with_strategy(
    df: DataFrame, found: DataFrame, dim_rows: int | None
) -> tuple[DataFrame, DataFrame]:
    if dim_rows is not None and dim_rows <= BROADCAST_ROWS:
        return df, F.broadcast(found)
    return df.hint("merge"), found


def asof_marks(
    df: DataFrame,
    dim: DataFrame,
    key: Sequence[str],
    take: Mapping[str, str],
    version: str = "batch_number",
) -> DataFrame:
    """Versions and rows together, in ranges of (key, version), versions first.

    The ranges may part the rows of one key, and by a hash of the row even those of one version,
    so none of them grows with a hot key.
    """
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*key, version)])
    keys = [F.col(k).alias(f"_key{i}") for i, k in enumerate(key)]
    at = F.col(version).alias("_at")
    hit = F.struct(*(F.col(old).alias(new) for old, new in take.items()))
    row = F.struct(*df.columns)
    kind = df.select(row.alias("r")).schema["r"].dataType
    versions = dim.filter(known).select(
        *keys,
        at,
        F.lit(0).alias("_asks"),
        F.lit(0).cast("bigint").alias("_spread"),
        hit.alias("_hit"),
        F.lit(None).cast(kind).alias("_row"),
    )
    asked = df.filter(known).select(
        *keys,
        at,
        F.lit(1).alias("_asks"),
        F.xxhash64(*df.columns).alias("_spread"),
        F.lit(None).cast(versions.schema["_hit"].dataType).alias("_hit"),
        row.alias("_row"),
    )
    order = [*(f"_key{i}" for i in range(len(key))), "_at", "_asks", "_spread"]
    return versions.unionByName(asked).repartitionByRange(*order).sortWithinPartitions(*order)


def carried(marks: DataFrame, keys: int) -> DataFrame:
    """Each asking row of ``marks`` with the last version of its key in its partition, and a row
    per partition with the state at its end.

    ``_first``: the row has the first key of its partition and no version before it there, so it
    may belong to one in an earlier partition.
    """
    names = [f"_key{i}" for i in range(keys)]
    kinds = {f.name: f.dataType.simpleString() for f in marks.schema.fields}
    out = [*names, "_asks", "_hit", "_row"]
    schema = ", ".join(f"{c} {kinds[c]}" for c in out) + ", _first boolean, _part int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        # The last row seen, with the version that holds there; whether a second key has come.
        last: pa.RecordBatch | None = None
        moved = False
        for batch in batches:
            if not batch.num_rows:
                continue
            # By name: columns that Spark knows to be without nulls say so, carried ones do not.
            batch = pa.RecordBatch.from_arrays([batch.column(c) for c in out], names=out)
            start = 0 if last is None else 1
            rows = batch if last is None else pa.concat_batches([last, batch])
            n = rows.num_rows
            fresh = np.zeros(n, dtype=bool)
            for name in names:
                cells = rows.column(name)
                apart = pc.not_equal(cells.slice(1), cells.slice(0, n - 1))
                fresh[1:] |= apart.to_numpy(zero_copy_only=False)
            at = np.arange(n)
            valid = rows.column("_hit").is_valid().to_numpy(zero_copy_only=False)
            hit = np.maximum.accumulate(np.where(valid, at, -1))
            known = hit >= np.maximum.accumulate(np.where(fresh, at, 0))
            filled = rows.column("_hit").take(pa.array(hit, mask=~known))
            first = ~known & ~(np.logical_or.accumulate(fresh) | moved)
            done = pa.RecordBatch.from_arrays(
                [
                    *(rows.column(c) for c in (*names, "_asks")),
                    filled,
                    rows.column("_row"),
                    pa.array(first),
                    pa.array(np.full(n, part, np.int32)),
                ],
                names=[*out, "_first", "_part"],
            )
            asks = rows.column("_asks").to_numpy() == 1
            asks[:start] = False
            yield done.filter(pa.array(asks))
            moved = moved or bool(fresh.any())
            end = done.slice(n - 1)
            last = end.select(out)
        if last is not None:
            state = {c: last.column(c) for c in (*names, "_hit")}
            yield pa.RecordBatch.from_arrays(
                [
                    *(state[c] for c in names),
                    pa.array([0], pa.int32()),
                    state["_hit"],
                    pa.nulls(1, last.schema.field("_row").type),
                    pa.array([False]),
                    pa.array([part], pa.int32()),
                ],
                names=[*out, "_first", "_part"],
            )

    return marks.mapInArrow(run, schema)


def _carry(
    df: DataFrame,
    dim: DataFrame,
    key: Sequence[str],
    take: Mapping[str, str],
    version: str,
) -> DataFrame:
    """Rows with their versions, by carrying the last version along ranges of (key, version).

    One shuffle brings rows and versions together. The ranges are written before they are used,
    as a range drawn again could be cut elsewhere; the state at their ends, one row each, then
    goes on to the ranges behind.
    """
    marks = asof_marks(df, dim, key, take, version)
    ranges = written(carried(marks, len(key)), "asof-ranges")
    keys = F.struct(*(f"_key{i}" for i in range(len(key))))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    state = F.when(F.col("_hit").isNotNull(), F.struct(keys.alias("keys"), F.col("_hit").alias("hit")))
    # One row per range. The last version at an end is that of the ranges behind while they hold
    # its key.
    ends = ranges.filter("_asks = 0").select(
        "_part", F.last(state, ignorenulls=True).over(before).alias("_state")
    )
    rows = ranges.filter("_asks = 1").join(F.broadcast(ends), "_part", "left")
    earlier = F.when(F.col("_first") & (F.col("_state.keys") == keys), F.col("_state.hit"))
    found = rows.withColumn("_hit", F.coalesce("_hit", earlier)).filter(F.col("_hit").isNotNull())
    return found.select("_row.*", "_hit.*")


def value_lookup(
    df: DataFrame, dim: DataFrame, name: Column, dim_name: str, sk: str, into: str
) -> DataFrame:
    """Add the key of a folded value; null where the value is missing or unknown.

    Missing values match nothing, so each such row gets a side key of its own: in a merge join
    they would otherwise all meet in one task.
    """
    found = dim.select(
        F.col(dim_name).alias("_name"), F.lit(0).cast("bigint").alias("_side"), F.col(sk).alias(into)
    )
    known = found.filter(F.col("_name").isNotNull())
    side = F.when(F.col("_name").isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0))
    named = df.withColumn("_name", name).withColumn("_side", side.cast("bigint"))
    return named.join(known, ["_name", "_side"], "left").drop("_name", "_side")


def named_members(members: Mapping[str, tuple[DataFrame, Sequence[str]]], label: str,
                  names: Sequence[str]) -> DataFrame:
    """Stack several dimensions under one label column, so that rows that point into different
    dimensions by label are resolved in a single join."""
    arms = [
        dim.select(F.lit(kind).alias(label), *(F.col(c).alias(n) for c, n in zip(columns, names)))
        for kind, (dim, columns) in members.items()
    ]
    return reduce(DataFrame.unionByName, arms)
