"""Byte-level BPE over whole texts with a local rank file: encode, then decode as raw bytes."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lotbook.llm.common import text_of

#: Longer texts are encoded piece by piece, cut at safe boundaries after this many characters.
PIECE_CHARS = 1 << 16
#: Longer runs of blanks or of other text without a safe boundary are taken out of the pattern.
_BLANKS = re.compile(r"[ \n]{4096,}")
_SAFE = re.compile(r"(?<=[0-9A-Za-z])(?=[ \n])")


@lru_cache(maxsize=4)
def encoding(rank_path: str, pattern: str) -> tiktoken.Encoding:
    """One per Python worker. The rank file is read where the task runs."""
    with open(rank_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(rank_path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Cuts a text where no match of the pattern can reach across.

    Every alternative of the pattern holds white space at its start only, or is white space
    alone. A blank that follows a letter or digit therefore always begins a match. A text
    without such a place stays whole.
    """
    start = 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a text of any length, as encoding it at once would give."""
    if len(text) <= PIECE_CHARS:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece in safe_pieces(text):
        ids += _encode_blanks(enc, piece)
    return ids


def _encode_blanks(enc: tiktoken.Encoding, piece: str) -> list[int]:
    # A very long run of blanks before other text makes the pattern's look-ahead back up step
    # by step. The run's match is all but its last blank (or all, at the end of the text).
    ids: list[int] = []
    start = 0
    for run in _BLANKS.finditer(piece):
        begin, end = run.span()
        if end < len(piece):
            if piece[end].isspace():
                continue  # other white space follows: leave the run to the pattern
            end -= 1
        if begin and piece[begin - 1].isspace():
            continue
        ids += enc.encode_ordinary(piece[start:begin])
        ids += enc._encode_single_piece(piece[begin:end])
        start = end
    return ids + enc.encode_ordinary(piece[start:])


def encode(rank_path: str, pattern: str, text: Column) -> Column:
    """The ids of each text, array<int>."""

    @pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_path, pattern)
        for texts in batches:
            yield pd.Series([encode_text(enc, t or "") for t in texts], dtype=object)

    return run(text)


def decode(rank_path: str, pattern: str, ids: Column) -> Column:
    """The bytes of each id array; a cut inside a character leaves its bytes as they are."""

    @pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_path, pattern)
        for arrays in batches:
            yield arrays.map(lambda a: None if a is None else enc.decode_bytes(list(a)))

    return run(ids)


def round_trip(rank_path: str, pattern: str, text: Column) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256): encode and decode in one pass, keeping only
    the digests, so that the ids of long texts are never shipped."""

    @pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoding(rank_path, pattern)
        for texts in batches:
            rows = []
            for text in texts:
                ids = encode_text(enc, text or "")
                listed = " ".join(map(str, ids)).encode()
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(listed).hexdigest(),
                        hashlib.sha256(enc.decode_bytes(ids)).hexdigest(),
                    )
                )
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(text)


def token_digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): length and digests of its ids and their bytes.

    Null text counts as empty (no ids, digests of nothing); a null doc_id stays null; repeated
    rows give repeated results; other columns are ignored; an empty table gives no rows. No
    shuffle: the work follows the scan, and memory holds one Arrow batch.
    """
    digest = round_trip(rank_path, pattern, text_of())
    return docs.select("doc_id", digest.alias("d")).select("doc_id", "d.*")
