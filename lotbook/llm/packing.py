"""Cost-balanced packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lotbook.llm.common import chunked, lean, text_of
from lotbook.llm.tokens import CACHE_WORDS, word_tokenizer

SEQUENCE_TOKENS = 2048
END_ID = 1
#: Tokens that a task gathers before it packs them: some 500 sequences to balance, 4 MB of ids.
BLOCK_TOKENS = 1 << 20
#: Cost of a piece of n tokens: feed-forward work grows with n, attention with its square.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

Piece = tuple[int, int, int, int, int]


def capacities(total: int, limit: int) -> list[int]:
    """Sequence lengths that hold exactly ``total`` tokens: full ones, and powers of two, which
    need no padding, for the rest."""
    rest = total % limit
    return [limit] * (total // limit) + [
        1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1
    ]


def balance(lengths: list[int], limit: int = SEQUENCE_TOKENS) -> list[Piece]:
    """(document, start, length, sequence, offset) of every piece.

    Documents longer than a sequence are cut into full ones and a rest. Pieces go in descending
    cost, which is descending length, to the sequence of lowest cost that has room. When no
    sequence has room for the whole piece, the roomiest takes what fits and the remainder queues
    again. Capacity equals the tokens, so every sequence ends full: no padding at all.
    """
    room = capacities(sum(lengths), limit)
    used = [0] * len(room)
    spent = [0.0] * len(room)
    pieces = [
        (-min(limit, length - start), doc, start)
        for doc, length in enumerate(lengths)
        for start in range(0, length, limit)
    ]
    heapq.heapify(pieces)
    # Sequences by room, roomiest first, until pieces are small enough for them; then by cost.
    parked = [(-size, sequence) for sequence, size in enumerate(room)]
    heapq.heapify(parked)
    ready: list[tuple[float, int]] = []
    placed: list[Piece] = []

    def put(doc: int, start: int, length: int, sequence: int) -> None:
        placed.append((doc, start, length, sequence, used[sequence]))
        used[sequence] += length
        room[sequence] -= length
        spent[sequence] += LINEAR * length + QUADRATIC * length * length

    while pieces:
        negative, doc, start = heapq.heappop(pieces)
        length = -negative
        while parked and -parked[0][0] >= length:
            sequence = heapq.heappop(parked)[1]
            heapq.heappush(ready, (spent[sequence], sequence))
        while ready and room[ready[0][1]] < length:
            sequence = heapq.heappop(ready)[1]
            heapq.heappush(parked, (-room[sequence], sequence))
        if ready:
            sequence = heapq.heappop(ready)[1]
            put(doc, start, length, sequence)
            if room[sequence]:
                heapq.heappush(ready, (spent[sequence], sequence))
        else:
            free, sequence = heapq.heappop(parked)
            put(doc, start, -free, sequence)
            heapq.heappush(pieces, (negative - free, doc, start - free))
    return placed


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = SEQUENCE_TOKENS,
    block_tokens: int = BLOCK_TOKENS,
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """One row per piece of a document (doc_id, text): where it starts in the document, its ids'
    crc32, and its place (sequence_id, offset).

    A document is its ids and one end id; null text counts as empty and gives the end id alone.
    Null ids are kept, repeated rows are documents of their own, other columns are ignored, an
    empty table gives no rows. ``limit`` is a power of two.

    A task packs what it scans, block by block: no shuffle, and no memory beyond one block and
    one document. Each block ends in at most log2(limit) short sequences, each a power of two.
    Sequence ids carry the task's partition, so they differ between tasks and stay the same when
    a task is run again.
    """
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, "
        "ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path, cache_words=cache_words)
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        names: list = []
        ids: list[bytes] = []
        kind = None

        def flush() -> pa.RecordBatch:
            nonlocal first
            sizes = [len(x) // 4 for x in ids]
            placed = balance(sizes, limit)
            doc, start, length, sequence, offset = zip(*placed, strict=True)
            crc = [
                zlib.crc32(memoryview(ids[d])[4 * s : 4 * (s + n)])
                for d, s, n in zip(doc, start, length, strict=True)
            ]
            columns = {
                "doc_id": pa.array([names[d] for d in doc], kind),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array([sizes[d] for d in doc], pa.int64()),
                "sequence_id": pa.array([first + s for s in sequence], pa.int64()),
                "offset": pa.array(offset, pa.int64()),
            }
            first += len(capacities(sum(sizes), limit))
            names.clear()
            ids.clear()
            return pa.RecordBatch.from_pydict(columns)

        waiting = 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in chunked(texts):
                for key, encoded in zip(keys[a:b], tokenizer.ids(texts[a:b]), strict=True):
                    names.append(key)
                    ids.append(encoded + end)
                    waiting += len(encoded) // 4 + 1
                    if waiting >= block_tokens:
                        yield flush()
                        waiting = 0
        if names:
            yield flush()

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(lean(run), schema)
