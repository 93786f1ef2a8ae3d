"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

Every row's key has a place on a ring of 64-bit hashes and belongs to the next virtual node
clockwise. A shard takes its own rows up to its capacity; rows beyond it go on clockwise to the
next virtual node whose shard has room. Capacities add up to the whole load, so the balance holds
whatever the keys, and only the rows that a full shard turns away leave their home.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotbook.llm.common import text_of, written
from lotbook.llm.ordering import in_order

SHARDS = 24
#: Virtual nodes of each shard. The driver holds one load for each of all of them.
POINTS = 128
#: Bytes that a row costs besides its text.
ROW_BYTES = 8


def ring(shards: int, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places of all virtual nodes, and the shard of each."""
    owner = np.repeat(np.arange(shards), points)
    names = (f"{s}:{p}" for s in range(shards) for p in range(points))
    at = np.array([xxhash.xxh64_intdigest(n) for n in names], dtype=np.uint64).view(np.int64)
    order = np.lexsort((owner, at))
    return at[order], owner[order]


def bounded_pieces(
    loads: Sequence[int], owner: Sequence[int], capacity: Sequence[int]
) -> list[tuple[int, int]]:
    """(start, shard) of consecutive pieces of the ring's load, ascending by start.

    ``loads[i]`` is the load of arc i, which ends at virtual node i; one more arc lies behind the
    last node and belongs to the first. Each shard first takes its own arcs in the order of the
    ring; what does not fit goes on clockwise, arc by arc, to the next node whose shard has room.
    Capacities add up to the load at least. A piece is cut only where a shard fills up, so there
    are no more of them than arcs and twice the shards.
    """
    nodes, free = len(owner), list(capacity)
    pieces, waiting, start = [], [], 0
    for arc, load in enumerate(loads):
        shard = owner[arc % nodes]
        taken = min(load, free[shard])
        free[shard] -= taken
        if taken:
            pieces.append((start, int(shard)))
        if taken < load:
            waiting.append((arc, start + taken, start + load))
        start += load
    for arc, low, high in waiting:
        node = arc
        while low < high:
            node += 1
            shard = owner[node % nodes]
            taken = min(high - low, free[shard])
            if taken:
                pieces.append((low, int(shard)))
                free[shard] -= taken
                low += taken
    return sorted(pieces)


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Equal parts of ``total`` that differ by one at most, each widened by ``slack``."""
    even = [total // shards + (s < total % shards) for s in range(shards)]
    return [c + int(c * slack) for c in even]


def shard_rows(
    rows: DataFrame,
    key: str,
    size: str,
    shards: int = SHARDS,
    law: str = "rows",
    slack: float = 0.0,
    points: int = POINTS,
) -> DataFrame:
    """``rows`` (of plain columns) with ``home`` (the shard of the key's own virtual node),
    ``shard`` and ``slot`` (gapless from 0 within the shard, in the order of the ring).

    ``law`` says what is balanced: with ``rows`` each row counts one, with ``bytes`` its ``size``.
    Without ``slack``, counts differ by one at most, and sizes by one row's size at most; with it
    a shard may hold that share more, and fewer rows leave their home. Rows with equal keys lie
    side by side, null keys among them, and are cut where a shard fills up. The result depends on
    the rows alone, not on files or partitions. An empty table gives no rows.
    """
    at, owner = ring(shards, points)
    nodes = len(owner)

    def arc_of(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(at, place.to_numpy(), side="left").astype(np.int32))

    weight = F.lit(1) if law == "rows" else F.col(size)
    placed = rows.withColumns(
        {
            "_at": F.xxhash64(key),
            "_arc": F.pandas_udf(arc_of, "int")(F.xxhash64(key)),
            "_weight": weight.cast("long"),
            "_row": F.monotonically_increasing_id(),
        }
    )
    placed = written(placed, "ring-rows")
    # One load for each virtual node and one more: a bound that shards and points set.
    found = {r._arc: r.load for r in placed.groupBy("_arc").agg(F.sum("_weight").alias("load")).collect()}
    loads = [found.get(arc, 0) for arc in range(nodes + 1)]
    pieces = bounded_pieces(loads, owner, capacities(sum(loads), shards, slack))
    starts = np.array([start for start, _ in pieces], dtype=np.int64)

    def piece_of(position: pd.Series) -> pd.Series:
        return pd.Series(
            (np.searchsorted(starts, position.to_numpy(), side="right") - 1).astype(np.int32)
        )

    total_order = [F.col(c).asc_nulls_first() for c in ("_at", *rows.columns, "_row")]
    ordered = in_order(placed, total_order, "_weight", "ring-order")
    cut = ordered.global_weights().withColumn(
        "_piece", F.pandas_udf(piece_of, "int")(F.col("_position"))
    )
    # No more rows than pieces and partitions together: both lie in the order of the ring.
    runs = cut.groupBy("_piece", "_part").agg(F.min("_place").alias("first"), F.count("*").alias("n"))
    slots, bases = [0] * shards, []
    for run in sorted(runs.collect(), key=lambda r: (r._piece, r._part)):
        shard = pieces[run._piece][1]
        bases.append((run._piece, run._part, shard, slots[shard] - run.first))
        slots[shard] += run.n
    spark = rows.sparkSession
    base = spark.createDataFrame(bases, "_piece int, _part int, shard int, _base long")

    def home_of(arc: pd.Series) -> pd.Series:
        return pd.Series(owner[arc.to_numpy() % nodes].astype(np.int32))

    return cut.join(F.broadcast(base), ["_piece", "_part"]).select(
        *rows.columns,
        F.pandas_udf(home_of, "int")(F.col("_arc")).alias("home"),
        "shard",
        (F.col("_base") + F.col("_place")).alias("slot"),
    )


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    law: str = "rows",
    slack: float = 0.0,
    points: int = POINTS,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot,
    grown_shard and home, as in :func:`shard_rows`.

    ``size`` is the text's UTF-8 bytes and ``ROW_BYTES``; a null text has no bytes. text_crc32 is
    that of these bytes. Null ids are keys like others; rows that repeat stay apart. With one more
    shard other rows move too, though few, so grown_shard is null. Other columns are ignored.
    """
    text = F.encode(text_of(), "UTF-8")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return shard_rows(rows, "doc_id", "size", shards, law, slack, points).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(law).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home",
    )
