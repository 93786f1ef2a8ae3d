"""A global order of a table's rows without a single task that sees them all."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.llm.common import written


class Ordered:
    """Rows in a global order: each knows its partition, its place there and the weight before it.

    ``rows`` has the columns of the frame and ``_part``, ``_place`` (from 0 within the partition)
    and ``_before`` (the weight of the rows before it within the partition). ``totals`` lists
    (part, rows, weight) by partition; a partition holds a range of the order, so the running sums
    over this short list carry places and weights from one partition to the next.
    """

    def __init__(self, rows: DataFrame, weight: str):
        self.rows = rows
        ends = rows.groupBy("_part").agg(
            F.count("*").alias("n"), F.max(F.col("_before") + F.col(weight)).alias("all")
        )
        # One row per partition, whatever the number of rows.
        self.totals = sorted((r._part, r.n, r.all) for r in ends.collect())

    @property
    def count(self) -> int:
        return sum(n for _, n, _ in self.totals)

    def global_places(self) -> DataFrame:
        """The rows with ``_rank``: their gapless place from 0 in the whole order."""
        return self._carried("_rank", "_place", [n for _, n, _ in self.totals])

    def global_weights(self) -> DataFrame:
        """The rows with ``_position``: the weight of all rows before them in the whole order."""
        return self._carried("_position", "_before", [w for _, _, w in self.totals])

    def _carried(self, into: str, within: str, sums: list[int]) -> DataFrame:
        starts = np.cumsum([0, *sums])[:-1].tolist()
        parts = [part for part, _, _ in self.totals]
        first = self.rows.sparkSession.createDataFrame(
            list(zip(parts, starts, strict=True)), "_part int, _start long"
        )
        # One row per partition of the order.
        joined = self.rows.join(F.broadcast(first), "_part")
        return joined.withColumn(into, F.col("_start") + F.col(within)).drop("_start")


def in_order(df: DataFrame, order: Sequence[Column], weight: str, name: str) -> Ordered:
    """``df`` in the global order of ``order``, cut into ranges and written to the shared folder.

    The order should be total, so that a value that very many rows share does not fix where a
    range can be cut. ``weight`` is a column of whole numbers.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n, weights = batch.num_rows, batch.column(weight).to_numpy()
            added = {
                "_part": pa.array(np.full(n, part, np.int32)),
                "_place": pa.array(np.arange(place, place + n)),
                "_before": pa.array(before + np.cumsum(weights) - weights),
            }
            place, before = place + n, before + int(weights.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added.values()], names=[*batch.schema.names, *added]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    schema = f"{kinds}, _part int, _place long, _before long"
    return Ordered(written(ranged.mapInArrow(run, schema), name), weight)
