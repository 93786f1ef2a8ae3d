"""Warehouse tables as Parquet folders, one folder per layer and table.

A bucketed table is cut and sorted by a key when it is written, so that lookups on that key move
the other side only. Its folder reads like any other; the buckets are known through an external
table in the session's catalog, made again where a session does not have it. Files are packed with
zstd: hashed keys are hex digits, of which Snappy saves nothing and zstd half.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from zlib import crc32

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CODEC = "zstd"


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str
    #: Of each bucketed table; a folder keeps the number it was written with.
    buckets: int = 16

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str, schema: str) -> DataFrame:
        """Read with a declared schema: a partition column keeps its type, and its place."""
        names = [part.split()[0] for part in schema.split(", ")]
        return self.spark.read.schema(schema).parquet(self.path(layer, table)).select(*names)

    def columns(self, layer: str, table: str) -> list[str] | None:
        """Stored columns, or None where nothing has been written yet."""
        try:
            return self.spark.read.parquet(self.path(layer, table)).columns
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def append(self, layer: str, table: str, df: DataFrame, partition_by: str | None = None):
        writer = df.write.mode("append").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(layer, table))

    def replace(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        finish: Callable[[DataFrame], DataFrame] | None = None,
    ):
        """Rebuild a table. A partitioned one is rebalanced before the write, so that each task
        writes few files; AQE splits a partition value that holds much of the data. ``finish``
        adds columns in the tasks that write, where they need not be moved any more."""
        if partition_by:
            df = df.hint("rebalance", F.col(partition_by))
        if finish:
            df = finish(df)
        writer = df.write.mode("overwrite").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(layer, table))

    def replace_bucketed(self, layer: str, table: str, df: DataFrame, key: str) -> None:
        """Rebuild a table in buckets of ``key``, one file each. Meant for keys that do not
        repeat: a bucket holds all rows of its keys."""
        writer = df.repartition(self.buckets, key).write.mode("overwrite").option("compression", CODEC)
        writer = writer.bucketBy(self.buckets, key).sortBy(key).option("path", self.path(layer, table))
        writer.saveAsTable(self._name(layer, table))

    def read_bucketed(self, layer: str, table: str, schema: str, key: str) -> DataFrame:
        name = self._name(layer, table)
        self.spark.sql(
            f"create table if not exists {name} ({schema}) using parquet clustered by ({key}) "
            f"sorted by ({key}) into {self.buckets} buckets location '{self.path(layer, table)}'"
        )
        return self.spark.table(name).select(*(part.split()[0] for part in schema.split(", ")))

    def _name(self, layer: str, table: str) -> str:
        """One name per folder: a session may open several warehouses."""
        return f"{layer}_{table}_{crc32(self.root.encode()):08x}"

    def expose(self, layer: str, table: str, schema: str) -> DataFrame:
        """Register a table as a view ``<layer>_<table>`` for SQL users."""
        df = self.read(layer, table, schema)
        df.createOrReplaceTempView(f"{layer}_{table}")
        return df
