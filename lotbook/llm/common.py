"""Shared pieces: written intermediate tables, the training fold, and text in flat byte buffers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotbook.session import scratch as scratch
from lotbook.session import written as written

FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, into: str) -> DataFrame:
    """The rows of a table of files with a number each, the same whenever and wherever they are
    read: the place of the file among the table's, and of the row in the file. A frame that is
    not read from files is written first."""
    try:
        df.select("_metadata.row_index")
    except AnalysisException:
        df = written(df, "numbered")
    path, place, index = (unused(df, name) for name in ("_path", "_place", "_index"))
    # One row per file; Spark's driver lists them anyway.
    files = sorted(r[0] for r in df.select("_metadata.file_path").distinct().collect())
    places = df.sparkSession.createDataFrame(list(enumerate(files)), "place long, path string")
    places = places.select(F.col("place").alias(place), F.xxhash64("path").alias(path))
    keyed = df.select(
        "*",
        F.xxhash64("_metadata.file_path").alias(path),
        F.col("_metadata.row_index").alias(index),
    )
    number = F.shiftleft(place, 40) + F.col(index)
    return keyed.join(F.broadcast(places), path).select(*df.columns, number.alias(into))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or longer where the frame has such a column."""
    while name in df.columns:
        name += "_"
    return name


def lean(run: Callable) -> Callable:
    """A task's function that gives the memory it has freed back to the system when it ends. A
    Python worker goes on to the tasks of other operators, and what it keeps adds up."""

    @wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. A null id falls in fold 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(1))


def text_of(column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, rows: int
) -> DataFrame:
    """(id, text, label) of at most about ``rows`` labelled documents outside the held-out fold.

    Which ones depends on a hash of the id alone, so a re-run takes the same ones. Null labels
    and ids take no part; an id that repeats counts once, with its greatest label and, of its
    texts, the first in order.
    """
    marked = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & (fold(F.col("id")) != 0))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    total = marked.count()
    if total > rows:
        scale = 1 << 20
        marked = marked.filter(F.pmod(F.xxhash64("id"), F.lit(scale)) < scale * rows // total)
    texts = docs.select(F.col("doc_id").alias("id"), text_of().alias("text"))
    # Text stays put: the marks are bounded by the parameter.
    found = texts.join(F.broadcast(marked), "id")
    return found.groupBy("id", "label").agg(F.min("text").alias("text")).select("id", "text", "label")


# --- words of many texts at once -------------------------------------------------------------

_POWERS = np.ones(1, dtype=np.uint64)
_BASE, _INVERSE = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
_INVERSES = np.ones(1, dtype=np.uint64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = 1 << (n - 1).bit_length()
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE, np.uint64)])
            _INVERSES = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _INVERSE, np.uint64)])
    return _POWERS[:n], _INVERSES[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def chunked(texts: list[str], limit: int = 1 << 20):
    """Index ranges of consecutive texts of together about ``limit`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of several texts, A-Z folded to a-z, as 64-bit hashes.

    ``data`` holds the folded UTF-8 bytes of all texts, each followed by a line feed; word k is
    ``data[start[k]:end[k]]`` and belongs to text ``doc[k]``. Texts may be of any length.
    """

    def __init__(self, texts: list[str]):
        joined = "\n".join([*texts, ""]).encode("utf-8", "surrogatepass")
        self.raw = np.frombuffer(joined, dtype=np.uint8)
        self.data = _LOWER[self.raw]
        inside = ~_SPACE[self.data]
        edge = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        lengths = [len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts]
        self.text_end = np.cumsum(np.array(lengths, dtype=np.int64))
        self.doc = np.searchsorted(self.text_end, self.start, side="right")
        power, inverse = _powers(len(self.data) + 1)
        with np.errstate(over="ignore"):
            sums = np.r_[np.uint64(0), np.cumsum(_BYTE[self.data] * power[:-1])]
            raw = (sums[self.end] - sums[self.start]) * inverse[self.start]
        self.hash = mix(raw ^ (self.end - self.start).astype(np.uint64))
        # Where each text's words begin: words first[d]:first[d + 1] are text d's.
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))


# --- tiles of groups -----------------------------------------------------------------------------


def tiled(rows: DataFrame, group: str, key: str, size: Column, block_rows: int) -> DataFrame:
    """``rows`` with (tile, block): the pairs of a group's rows meet in tiles of bounded size.

    Rows of a group of ``size`` go to blocks by a hash of their key, and each pair of blocks is
    a tile; a group of one block is one tile. Within a tile of two blocks only pairs across them
    count, and a tile of one block holds the pairs within it.
    """
    blocks = F.ceil(size / block_rows)
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(key), F.col("blocks")))
        .withColumn("other", F.explode(others))
        .withColumn("tile", F.xxhash64(F.col(group), low, high))
        .drop("blocks", "other")
    )


def whole_groups(batches, column: str):
    """Arrow tables of whole groups from batches that come sorted by ``column``; one table holds
    the groups that end in a batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(column).to_numpy()
        # The last group of a batch may go on in the next one.
        cut = int(np.searchsorted(group, group[-1]))
        if cut or (held and group[0] != held[-1].column(column)[-1].as_py()):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def group_slices(group: np.ndarray) -> list[slice]:
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    return [slice(a, b) for a, b in zip(first, np.r_[first[1:], len(group)], strict=True)]
