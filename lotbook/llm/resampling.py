"""Resampling towards a target distribution by hashed n-gram importance weights.

Words come from Arrow kernels over whole batches (``ascii_lower``, ``split_pattern_regex``,
``list_flatten``, ``dictionary_encode``); dictionary indices shifted against each other form
n-grams, and the checksum is taken once per distinct pair. A document's weight is the sum of its
features' gains, and Gumbel noise from its id makes the draw a weighted sample without replacement.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotbook.llm.common import text_of, written
from lotbook.llm.ordering import in_order

#: What lies between words once A-Z are lower case: ASCII but for digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NGRAM = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
SHARE_PERCENT = 10
#: Bytes of text turned into words at a time, but for a longer text.
_CHUNK_BYTES = 1 << 22


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(start, slice) of consecutive texts of together a bounded number of bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < len(texts):
        used = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, used + _CHUNK_BYTES, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the index of each word into them, and the text that it belongs to."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    encoded = pc.list_flatten(parts).dictionary_encode()
    index = encoded.indices.to_numpy(zero_copy_only=False)
    doc = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    distinct = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    if b"" in distinct:
        keep = index != distinct.index(b"")
        index, doc = index[keep], doc[keep]
    return distinct, index.astype(np.int64), doc


def feature_buckets(
    texts: pa.Array, ngram: int, buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of one to ``ngram`` words: the bucket of each, and the text it belongs to.

    A run of k words is the pair of a run of k - 1 and the word behind it. Only distinct pairs
    are hashed, on from the checksum of their first part.
    """
    distinct, index, doc = words(texts)
    spelt = np.array([zlib.crc32(w) for w in distinct], dtype=np.int64)
    yield spelt[index] % buckets if len(index) else index, doc
    code, crc = index, spelt
    for k in range(2, ngram + 1):
        inside = doc[k - 1 :] == doc[: max(0, len(doc) - k + 1)]
        # ``code`` has one entry per run of k - 1 words, at the place of its first word.
        pair = code[: len(inside)] * max(len(distinct), 1) + index[k - 1 :]
        pair = pa.array(pair).dictionary_encode()
        first, last = np.divmod(pair.dictionary.to_numpy(), max(len(distinct), 1))
        code = pair.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        crc = np.array(
            [zlib.crc32(b" " + distinct[w], int(crc[f])) for f, w in zip(first, last, strict=True)],
            dtype=np.int64,
        )
        yield crc[code][inside] % buckets if len(code) else code, doc[: len(inside)][inside]


def bucket_counts(df: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket. A task gives each bucket once at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in text_chunks(batch.column(0)):
                for found, _ in feature_buckets(texts, ngram, buckets):
                    counts += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[used])], names=["bucket", "n"]
        )

    rows = df.select(text_of().alias("text")).mapInArrow(run, "bucket long, n long")
    counts = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # <= ``buckets`` rows
        counts[r.bucket] = r.n
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the raw texts)."""
    buckets, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    return np.array(
        [
            math.floor(
                1000
                * math.log(((t + 1.0) * (all_raw + buckets)) / ((s + 1.0) * (all_target + buckets)))
            )
            for s, t in zip(raw.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def gumbel(seed: int, doc_id: int) -> int:
    """floor(1000 times standard Gumbel noise), from a hash of seed and id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(
    docs: DataFrame, gain: np.ndarray, ngram: int = NGRAM, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sums = np.zeros((3, n), dtype=np.int64)
            for start, texts in text_chunks(batch.column(1)):
                own = sums[:, start : start + len(texts)]
                for k, (found, doc) in enumerate(feature_buckets(texts, ngram, len(gain))):
                    edge = np.searchsorted(doc, np.arange(len(texts) + 1))
                    total = np.r_[0, np.cumsum(gain.take(found))]
                    own[0] += (edge[1:] - edge[:-1]) * (k == 0)
                    own[1] += edge[1:] - edge[:-1]
                    own[2] += total[edge[1:]] - total[edge[:-1]]
            ids = batch.column(0).to_pylist()
            noise = [None if i is None else gumbel(seed, i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(s) for s in sums),
                    pc.add(pa.array(sums[2]), pa.array(noise, pa.int64())),
                ],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long"
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    ngram: int = NGRAM,
    buckets: int = BUCKETS,
    share_percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank.

    A feature is a run of one to ``ngram`` words, in the bucket of its checksum; a bucket's gain
    compares its share in ``target`` (text) with its share in ``docs``. Of the documents with at
    least ``least_words`` words, ``share_percent`` of a hundred (rounded down) with the highest
    scores are drawn, ties to the smaller id; ``rank`` counts them from 1 and is null for others.

    Null and blank texts have no features, weight 0 and are not drawn. A null id has no score and
    takes no part in the draw. Rows that repeat an id count each; of equal rows any order is the
    same. Either table may be empty. Other columns are ignored.
    """
    gain = gains(bucket_counts(docs, ngram, buckets), bucket_counts(target, ngram, buckets))
    rows = written(
        weighted(docs, gain, ngram, seed).withColumns(
            {"_row": F.monotonically_increasing_id(), "_one": F.lit(1).cast("long")}
        ),
        "resample-scores",
    )
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    order = [F.desc("score"), F.asc("doc_id"), F.asc("weight"), F.asc("n_features"), F.asc("_row")]
    ordered = in_order(rows.filter(able), order, "_one", "resample-order")
    drawn = ordered.count * share_percent // 100
    place = F.col("_rank") + 1
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = ordered.global_places().select(*columns, F.when(place <= drawn, place).alias("rank"))
    others = rows.filter(~F.coalesce(able, F.lit(False)))
    return ranked.unionByName(others.select(*columns, F.lit(None).cast("long").alias("rank")))
