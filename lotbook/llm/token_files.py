"""Flat token files without an index: writing them, and counting tokens per document by a scan
for the end-of-document id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotbook.llm.common import chunked, text_of
from lotbook.llm.tokens import word_tokenizer

#: Ids are unsigned 16-bit, little-endian. This one ends a document and occurs nowhere else.
END_ID = 49407
#: Tokens searched at a time.
BLOCK_TOKENS = 1 << 20
#: Bytes of ids that are written as one row, but for a longer document, and rows per file: the
#: reader takes a file of some 64 MB as a whole.
ROW_BYTES, FILE_ROWS = 1 << 20, 64


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    row_bytes: int = ROW_BYTES,
    file_rows: int = FILE_ROWS,
) -> None:
    """The ids of every text of ``docs``, one after the other, each closed by the end id.

    A row holds the ids of documents of together about ``row_bytes``, end ids between them. Spark's
    text writer puts the raw bytes of a row and the separator, which is the last end id; nothing
    else is in the files, so they hold neither document ids nor offsets. A file holds ``file_rows``
    rows at most, so its size is bounded in bytes whatever the number of documents; a document
    longer than a row is a row of its own. Null text counts as empty.
    """
    end = END_ID.to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path, spell_special=True)
        held: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"value": pa.array([end.join(held)], pa.binary())})

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in chunked(texts):
                for ids in tokenizer.ids(texts[a:b]):
                    held.append(np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes())
                    size += len(held[-1]) + 2
                    if size >= row_bytes:
                        yield row()
                        held.clear()
                        size = 0
        if held:
            yield row()

    rows = docs.select(text_of().alias("text")).mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string")).write.options(
        lineSep=end.decode("latin-1"), encoding="ISO-8859-1", maxRecordsPerFile=file_rows
    ).text(path)


def block_ends(tokens: np.ndarray, end_id: int, block: int) -> Iterator[tuple[int, np.ndarray]]:
    """(block number, places of the end id in the file) of each block of a file's tokens."""
    for number, start in enumerate(range(0, len(tokens), block)):
        yield number, start + np.flatnonzero(tokens[start : start + block] == end_id)


def token_counts(
    spark: SparkSession, path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """One row per document of the flat files at ``path``: (file, doc_no, start, n_tokens).

    ``file`` is the file's name, ``doc_no`` counts from 0 within it, ``start`` is the place of
    the document's first id and ``n_tokens`` counts its ids with the end id. Empty files give
    no rows; ids behind the last end id are a document cut short and count as one. A file of
    an odd number of bytes fails.

    Blocks are searched on their own. What a block must know of those before it, the number of
    documents and the last end id, is a running sum and a running maximum over the blocks'
    summaries, two numbers for each, so documents that span blocks are stitched without reading
    them again.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    schema = "file string, block int, size long, n long, last long, ends array<long>"

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"], strict=True):
                tokens = np.frombuffer(content, dtype="<u2")
                rows = [
                    (file, number, len(tokens), len(ends), int(ends[-1]) if len(ends) else -1, ends)
                    for number, ends in block_ends(tokens, end_id, block_tokens)
                ]
                yield pd.DataFrame(rows, columns=["file", "block", "size", "n", "last", "ends"])

    blocks = files.select(name.alias("file"), "content").mapInPandas(search, schema)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    final = F.col("block") == F.floor((F.col("size") - 1) / block_tokens)
    stitched = blocks.select(
        "file",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs_before"),
        (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("open_from"),
        "size",
        "last",
        "ends",
        final.alias("final"),
    )
    # A file that does not end with the end id has one more document, up to its size.
    cut = F.col("final") & (F.greatest("last", F.col("open_from") - 1) < F.col("size") - 1)
    ends = F.when(cut, F.concat("ends", F.array(F.col("size") - 1))).otherwise(F.col("ends"))
    starts = F.concat(F.array("open_from"), F.transform(ends, lambda end: end + 1))
    return (
        stitched.select(
            "file", "docs_before", F.posexplode(F.arrays_zip(ends.alias("end"), starts.alias("from")))
        )
        .filter(F.col("col.end").isNotNull())
        .select(
            "file",
            (F.col("docs_before") + F.col("pos")).alias("doc_no"),
            F.col("col.from").alias("start"),
            (F.col("col.end") - F.col("col.from") + 1).alias("n_tokens"),
        )
    )
