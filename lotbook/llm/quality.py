"""Quality classifier: a linear-chain CRF over lines, aggregated into document quality."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lotbook.llm.common import Words, chunked, fold, lean, text_of, training_rows

#: Labelled documents that the model is fitted on, at most about this many.
TRAIN_ROWS = 4_000
#: Lines of a training document on average, at most about; fitting and scoring take all its lines.
TRAIN_LINES = 200
LEAST_SCORE = 0.3
_STEPS, _ROUNDS, _L2 = 100, 3, 1e-4


# --- line features ---------------------------------------------------------------------------

_KIND = np.zeros(256, dtype=np.uint8)  # 0: white space and continuation bytes
_KIND[0x21:0x7F] = 4  # marks
_KIND[[ord(c) for c in ".,"]] = 5
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[0xC2:0xF5] = 1  # lead bytes of other characters count as letters
N_LINE = 16


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes, text) of every line of every text; at least one line per text.

    Whole lines of any length are counted through running sums over the bytes, so the cost is
    linear and no line is cut.
    """
    words = Words(texts)
    data, raw = words.data, words.raw
    line_end = np.flatnonzero(raw == 10)  # each text is followed by one
    line_start = np.r_[0, line_end[:-1] + 1]
    doc = np.searchsorted(words.text_end, line_start, side="right")
    size = line_end - line_start

    def per_line(mask: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(mask, dtype=np.int64)]
        return (sums[line_end] - sums[line_start]).astype(np.float64)

    kind = _KIND[raw]
    lower, upper, digit, mark, stop = (per_line(kind == k) for k in (1, 2, 3, 4, 5))
    chars = lower + upper + digit + mark + stop
    line_of = np.searchsorted(line_end, words.start, side="right")
    n = len(line_end)
    count = np.bincount(line_of, minlength=n).astype(np.float64)
    share = lambda x: np.divide(x, count, out=np.zeros(n), where=count > 0)
    part = lambda x: np.divide(x, chars, out=np.zeros(n), where=chars > 0)
    by_word = lambda mask: np.bincount(line_of[mask], minlength=n).astype(np.float64)

    same = np.zeros(len(words.hash), dtype=bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (line_of[1:] == line_of[:-1])
    two_back = np.zeros(len(words.hash), dtype=bool)
    two_back[2:] = (words.hash[2:] == words.hash[:-2]) & (line_of[2:] == line_of[:-2])
    # Words of marks only, and words that close with two marks or more.
    last, before = words.end - 1, np.maximum(words.end - 2, words.start)
    closes = (kind[last] == 4) & (kind[before] == 4)
    lone = (kind[words.start] == 4) & (words.end - words.start == 1)
    distinct = np.zeros(n)
    if len(words.hash):
        order = np.lexsort((words.hash, line_of))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (
            line_of[order][1:] != line_of[order][:-1]
        )
        distinct = np.bincount(line_of[order][new], minlength=n).astype(np.float64)
    span = np.bincount(line_of, weights=words.end - words.start, minlength=n)
    starts_upper = by_word(kind[words.start] == 2) if len(words.hash) else np.zeros(n)
    # A line that the same text already had.
    sums = np.r_[np.uint64(0), np.cumsum(words.hash)]
    at = np.searchsorted(line_of, np.arange(n + 1))
    key = sums[at[1:]] - sums[at[:-1]]
    again = np.zeros(n)
    order = np.lexsort((np.arange(n), key, doc))
    repeat = np.zeros(n, dtype=bool)
    repeat[1:] = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    again[order] = repeat
    ends = np.where(size > 0, data[np.maximum(line_end - 1, 0)], 32)
    features = np.stack(
        [
            np.ones(n),
            part(upper),
            part(digit),
            part(mark),
            part(stop),
            share(by_word(same)),
            share(by_word(two_back)),
            share(by_word(closes)),
            share(by_word(lone)),
            share(distinct),
            share(span) / 10,
            share(starts_upper),
            np.log1p(count) / 5,
            (count == 0).astype(np.float64),
            again,
            np.isin(ends, [ord("."), ord("!"), ord("?")]).astype(np.float64),
        ],
        axis=1,
    )
    assert features.shape[1] == N_LINE
    return features, size.astype(np.float64) + 1, doc


def with_neighbours(features: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it in its text, and the
    differences from them; beyond the ends of a text they are zero."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    near = doc[1:] == doc[:-1]
    before[1:][near] = features[:-1][near]
    after[:-1][near] = features[1:][near]
    return np.concatenate([features, before[:, 1:], after[:, 1:]], axis=1)


# --- the chain -------------------------------------------------------------------------------


@dataclass
class Chain:
    """Weights of "good" against "bad" per line, and of neighbouring labels that agree."""

    weights: np.ndarray
    moves: np.ndarray  # 2 x 2, from the line before to the line
    slope: float = 1.0
    offset: float = 0.0

    def marginals(self, rows: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(good) of each line, P(label before, label) of each line with one before it)."""
        return forward_backward(rows @ self.weights, self.moves, doc)

    def score(self, texts: list[str]) -> np.ndarray:
        """Quality of each text: the mean of its lines' P(good), by length, calibrated."""
        features, size, doc = line_features(texts)
        good, _ = self.marginals(with_neighbours(features, doc), doc)
        share = np.bincount(doc, good * size, len(texts)) / np.bincount(doc, size, len(texts))
        return 1 / (1 + np.exp(-(self.slope * share + self.offset)))


def forward_backward(
    unary: np.ndarray, moves: np.ndarray, doc: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all texts' chains at once, longest first, one step per line position.

    ``doc`` is sorted. Messages are normalised at each step, so chains of any length neither
    overflow nor vanish. Memory is linear in the number of lines.
    """
    n = len(unary)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if n else np.zeros(0, int)
    length = np.diff(np.r_[first, n])
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    alive = np.searchsorted(-length, -np.arange(length.max(initial=0)), side="left")
    local = np.exp(np.stack([np.zeros(n), unary], 1) - np.maximum(unary, 0)[:, None])
    step = np.exp(moves - moves.max())
    ahead = np.empty((n, 2))
    back = np.ones((n, 2))
    for t, k in enumerate(alive):
        at = first[:k] + t
        message = local[at] if t == 0 else (ahead[at - 1] @ step) * local[at]
        ahead[at] = message / message.sum(1, keepdims=True)
    for t in range(len(alive) - 2, -1, -1):
        at = first[: alive[t + 1]] + t
        message = (back[at + 1] * local[at + 1]) @ step.T
        back[at] = message / message.sum(1, keepdims=True)
    both = ahead * back
    good = both[:, 1] / both.sum(1) if n else np.zeros(0)
    inner = np.setdiff1d(np.arange(n), first, assume_unique=True)
    pairs = ahead[inner - 1][:, :, None] * step[None] * (local[inner] * back[inner])[:, None, :]
    return good, pairs / pairs.sum((1, 2), keepdims=True)


def fit_chain(features: np.ndarray, size: np.ndarray, doc: np.ndarray, label: np.ndarray) -> Chain:
    """Fits the chain to documents' labels (one per document, in the order of ``doc``).

    Lines of good documents are good. Those of bad documents are not known: they start as bad,
    and after each round only those that the model still calls bad, at least the worst of each
    document, stay so. The slope and offset then map a document's share of good lines to the
    probability of its label.
    """
    rows = with_neighbours(features, doc)
    n_docs = len(label)
    kept = np.concatenate([np.ones(1), np.full(rows.shape[1] - 1, 1.0)])
    chain = Chain(np.zeros(rows.shape[1]), np.zeros((2, 2)))
    lines = np.bincount(doc, minlength=n_docs)
    inner = np.flatnonzero(np.r_[False, doc[1:] == doc[:-1]])
    truth = label[doc].astype(np.float64)
    # Every document weighs the same and so do both labels, however long or rare.
    bad_share = min(max(1 - label.mean(), 0.02), 0.98) if n_docs else 0.5
    weight = np.where(label == 1, 0.5 / (1 - bad_share), 0.5 / bad_share)[doc] / lines[doc]
    for _ in range(_ROUNDS):
        moment = [np.zeros_like(chain.weights), np.zeros((2, 2))]
        square = [np.zeros_like(chain.weights), np.zeros((2, 2))]
        for step in range(1, _STEPS + 1):
            good, pairs = chain.marginals(rows, doc)
            gradient = rows.T @ (weight * (truth - good)) / n_docs - _L2 * kept * chain.weights
            seen = np.zeros((len(inner), 2, 2))
            seen[np.arange(len(inner)), truth[inner - 1].astype(int), truth[inner].astype(int)] = 1
            turn = ((seen - pairs) * weight[inner, None, None]).sum(0) / n_docs
            for k, (value, slope) in enumerate(
                ((chain.weights, gradient), (chain.moves, turn - _L2 * chain.moves))
            ):
                moment[k] = 0.9 * moment[k] + 0.1 * slope
                square[k] = 0.99 * square[k] + 0.01 * slope**2
                value += (
                    0.1
                    * (moment[k] / (1 - 0.9**step))
                    / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                )
        good, _ = chain.marginals(rows, doc)
        worst = np.full(n_docs, 2.0)
        np.minimum.at(worst, doc, good)
        truth = np.where(
            label[doc] == 1, 1.0, ((good > 0.5) & (good > worst[doc])).astype(np.float64)
        )
    good, _ = chain.marginals(rows, doc)
    share = np.bincount(doc, good * size, n_docs) / np.bincount(doc, size, n_docs)
    chain.slope, chain.offset = calibrate(share, label)
    return chain


def calibrate(share: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from share to label, with a weak prior that keeps a
    separable sample finite."""
    a, b = 4.0, -2.0
    x = np.stack([share, np.ones_like(share)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ [a, b], -30, 30)))
        gradient = x.T @ (label - p) - 0.05 * np.array([a, b])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
        a, b = np.array([a, b]) + np.clip(np.linalg.solve(curve, gradient), -5, 5)
    return float(a), float(b)


# --- on tables -------------------------------------------------------------------------------


def within(documents: list[tuple[int, int, int]], lines: int) -> set[int]:
    """Ids of whole documents, (id, label, lines) each, that hold ``lines`` lines at most: first
    the shortest of each label, then the others as they come, those that do not fit left out."""
    taken: set[int] = set()
    shortest = {label: min(d[::-1] for d in documents if d[1] == label) for label in {d[1] for d in documents}}
    first = [(number, label, n) for n, label, number in sorted(shortest.values())]
    for number, _, n in [*first, *documents]:
        if number not in taken and n <= lines:
            taken.add(number)
            lines -= n
    return taken


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Chain:
    """The chain learnt from labelled documents outside the held-out fold.

    Fitted on the driver from line features, 16 numbers a line, of whole documents: at most about
    ``train_rows`` of them, and ``TRAIN_LINES`` times as many lines; a document that would pass
    this bound is left out. Without
    labels of both kinds every document is called good.
    """

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in chunked(texts):
                rows, size, doc = line_features(texts[a:b])
                cut = np.searchsorted(doc, np.arange(1, b - a))
                yield pd.DataFrame(
                    {
                        "id": batch["id"].to_numpy()[a:b],
                        "label": batch["label"].to_numpy()[a:b],
                        "rows": [x.astype("<f4").tobytes() for x in np.split(rows, cut)],
                        "size": [x.astype("<f4").tobytes() for x in np.split(size, cut)],
                    }
                )

    sample = training_rows(docs, labels, "quality", train_rows)
    length = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    # By the hash that the sample is drawn by, so that fewer are a sample of it.
    ranked = sample.select("id", "label", length.alias("n"), F.xxhash64("id").alias("at"))
    lengths = sorted(ranked.collect(), key=lambda r: (r["at"], r["id"]))
    taken = within([(r["id"], r["label"], r["n"]) for r in lengths], TRAIN_LINES * train_rows)
    if len(taken) < len({r["id"] for r in lengths}):
        kept = docs.sparkSession.createDataFrame([(i,) for i in sorted(taken)], "id long")
        sample = sample.join(F.broadcast(kept), "id", "left_semi")
    found = sample.mapInPandas(lean(features), "id long, label int, rows binary, size binary")
    # In the order of the ids, so that a run again fits the same numbers.
    bags = sorted(found.collect(), key=lambda r: (r["id"], r["rows"]))
    label = np.array([r["label"] for r in bags], dtype=np.float64)
    if len(set(label.tolist())) < 2:
        return Chain(np.zeros(3 * N_LINE - 2), np.zeros((2, 2)), 0.0, 4.0)
    rows = [np.frombuffer(r["rows"], "<f4").reshape(-1, N_LINE) for r in bags]
    size = np.concatenate([np.frombuffer(r["size"], "<f4") for r in bags]).astype(np.float64)
    doc = np.repeat(np.arange(len(bags)), [len(r) for r in rows])
    return fit_chain(np.concatenate(rows).astype(np.float64), size, doc, label)


def quality(chain: Chain, text: Column) -> Column:
    """The score of each text, 0 to 1, higher for better ones. An empty text is one empty line."""

    @pandas_udf("double")
    @lean
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = texts.tolist()
            scores = [chain.score(values[a:b]) for a, b in chunked(values)]
            yield pd.Series(np.concatenate([np.zeros(0), *scores]))

    return run(text)


def quality_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, score, predicted).

    Null text counts as empty; a null id is never held out; repeated rows get the same score;
    other columns are ignored; an empty table gives no rows.
    """
    chain = fit_quality(docs, labels, train_rows)
    scored = docs.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        quality(chain, text_of()).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= LEAST_SCORE).cast("int"))
