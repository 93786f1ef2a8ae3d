"""Toxicity of texts restored from leetspeak, spacing and repetition by a noisy-channel decoder."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lotbook.llm.common import chunked, fold, lean, text_of, training_rows

#: Labelled documents that the lexicon is learnt from, at most about this many.
TRAIN_ROWS = 10_000
LEAST_SCORE = 0.5

# --- the character model -----------------------------------------------------------------------

#: Symbols: 0 is a word boundary, 1-26 are a-z, 27 any other letter, 28 a digit, 29 a mark.
SYMBOLS = 30
_BOUNDARY, _LETTER, _DIGIT, _MARK = 0, 27, 28, 29
_SYMBOL = np.full(256, _MARK, dtype=np.uint8)
_SYMBOL[[0x20, *range(0x09, 0x0E)]] = _BOUNDARY
_SYMBOL[ord("0") : ord("9") + 1] = _DIGIT
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(1, 27)
_SYMBOL[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_SYMBOL[0xC2:0xF5] = _LETTER
_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[0x80:0xC0] = True


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of three symbols in a row, over all texts, each closed by a boundary."""
    raw = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-8", "surrogatepass"), np.uint8)
    symbols = _SYMBOL[raw[~_CONTINUES[raw]]].astype(np.int32)
    codes = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
    return np.bincount(codes, minlength=SYMBOLS**3)


def corpus_trigrams(docs: DataFrame) -> np.ndarray:
    """Trigram counts over every text of the table, summed per task and then over tasks.

    What reaches the driver is one number for each of the 27,000 trigrams at most.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in chunked(texts):
                total += trigram_counts(texts[a:b])
        codes = np.flatnonzero(total)
        yield pd.DataFrame({"code": codes, "n": total[codes]})

    counted = docs.select(text_of().alias("text")).mapInPandas(lean(count), "code long, n long")
    total = np.zeros(SYMBOLS**3, dtype=np.int64)
    for row in counted.groupBy("code").agg(F.sum("n").alias("n")).collect():
        total[row["code"]] = row["n"]
    return total


def log_model(trigrams: np.ndarray) -> np.ndarray:
    """log P(symbol | the two before), trigram smoothed by bigram by unigram by uniform."""
    tri = trigrams.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    p = (uni + 1) / (uni.sum() + SYMBOLS)
    p = (bi + 50 * p) / (bi.sum(1, keepdims=True) + 50)
    p = (tri + 20 * p[None]) / (tri.sum(2, keepdims=True) + 20)
    return np.log(p).astype(np.float32)


# --- the channel and the decoder -----------------------------------------------------------------

# Letters that a mark or digit may stand for.
LEET = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "gb",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "€": "e",
    "£": "l",
    "¢": "c",
    "(": "c",
}
_GAPS = " .-_*~'"
#: Log probabilities of the channel: a letter written otherwise, a mark put in, a letter repeated,
#: and a digit or mark, or a blank within a spelt-out run, that means itself.
_LEET_COST, _GAP_COST, _REPEAT_COST, _KEEP_MARK, _KEEP_BLANK = -1.5, -0.7, -0.7, -7.0, -2.5
#: Longer strings are decoded in windows of twice this length that overlap by half, so that a
#: word is whole in one of them; its neighbour may read its parts again.
_HALF = 64


def _symbol(char: str) -> int:
    if char.isascii():
        return int(_SYMBOL[ord(char)])
    return _LETTER if char.isalpha() else _BOUNDARY if char.isspace() else _MARK


def lattice(noisy: str) -> Iterator[list[tuple[str, float]]]:
    """For each character what may have been meant, with the channel's log probability; an empty
    string where it was put in."""
    for i, char in enumerate(noisy):
        again = i > 0 and noisy[i - 1] == char
        if char.isalpha():
            arcs = [(char, 0.0)]
            # Two in a row is spelling; three or more may stand for one or two.
            if again and (noisy[i - 2 : i - 1] == char or noisy[i + 1 : i + 2] == char):
                arcs.append(("", _REPEAT_COST))
        else:
            arcs = [(char, _KEEP_BLANK if char == " " else _KEEP_MARK)]
            arcs += [(c, _LEET_COST) for c in LEET.get(char, "")]
            if char in _GAPS or again:
                arcs.append(("", _GAP_COST))
        yield arcs


def viterbi(noisy: str, model: np.ndarray) -> str:
    """The likeliest reading of a string under the channel and the character model.

    States are the last two symbols; each keeps its best reading. A step costs at most the
    states times a handful of arcs, so the time is linear in the length.
    """
    best: dict[tuple[int, int], tuple[float, str]] = {(_BOUNDARY, _BOUNDARY): (0.0, "")}
    for arcs in lattice(noisy):
        step: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, read) in best.items():
            for char, cost in arcs:
                if char:
                    c = _symbol(char)
                    state, total = (b, c), score + cost + float(model[a, b, c])
                else:
                    state, total = (a, b), score + cost
                if state not in step or (total, char) > (step[state][0], ""):
                    step[state] = (total, read + char)
        best = step
    closed = [
        (score + float(model[a, b, _BOUNDARY]), read) for (a, b), (score, read) in best.items()
    ]
    return max(closed)[1]


_LEET_CLASS = re.escape("".join(c for c in LEET if not c.isdigit()))
_ITEM = rf"[^\W_{_LEET_CLASS}]|[{_LEET_CLASS}]"
# Single characters, or symbols that stand for one, spelt out with a gap between each, at least
# three of them.
_SPELT = re.compile(
    rf"(?<![^\W_])(?:{_ITEM})(?:[ .\-_*~]{{1,2}}(?:{_ITEM})){{2,}}(?![^\W_])"
)
#: What every such run holds; it starts with a gap, so most of a text is passed over quickly.
_MAYBE_SPELT = re.compile(
    rf"[ .\-_*~]{{1,2}}(?:{_ITEM})[ .\-_*~]{{1,2}}(?:{_ITEM})(?![^\W_])"
)
# A word with a digit or mark among its letters, a gap inside, or a letter three times over.
_INSIDE = re.compile(r"[^\W\d_][0-9@$!|+€£¢(*.\-_~']+[^\W\d_]|[0-9@$!|+€£¢(*]+[^\W\d_]{2}")
#: A letter and a digit or symbol that may stand for one, next to each other.
_BESIDE = re.compile(rf"[^\W\d_][0-9{_LEET_CLASS}]|[0-9{_LEET_CLASS}][^\W\d_]")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_EDGE = " \t\n\r\"'.,;:?!#%&*$()[]{}<>|/\\~=+-_"
#: Marks at the edge that never stand for a letter.
_PLAIN_EDGE = "".join(c for c in _EDGE if c not in LEET)
_LETTERS = re.compile(r"[^\W\d_]+")


class Restorer:
    """Restores words; keeps what it has read, as noisy words repeat."""

    KEPT = 200_000

    def __init__(self, model: np.ndarray):
        self._model = model
        self._read: dict[str, str] = {}

    def decode(self, noisy: str) -> str:
        if len(noisy) > 2 * _HALF:
            starts = range(0, len(noisy) - _HALF, _HALF)
            return " ".join(self.decode(noisy[i : i + 2 * _HALF]) for i in starts)
        if noisy not in self._read:
            if len(self._read) >= self.KEPT:
                self._read.clear()
            self._read[noisy] = viterbi(noisy, self._model)
        return self._read[noisy]

    def unspelt(self, text: str) -> str:
        """The text in lower case with spelt-out runs read as words."""
        folded = text.lower()
        if _MAYBE_SPELT.search(folded):
            folded = _SPELT.sub(self._unspelt, folded)
        return folded

    def _unspelt(self, run: re.Match) -> str:
        """The reading of a run; marks and a few digits without a letter are tables and sums."""
        noisy = run.group()
        if not _LETTERS.search(noisy) and sum(map(str.isalnum, noisy)) < 4:
            return noisy
        return " " + self.decode(noisy) + " "

    def words(self, part: str) -> tuple[str, ...]:
        """Letter runs of one white-space delimited part in lower case, restored if it looks
        noisy. Any other part has one reading, itself."""
        core = part.strip(_EDGE)
        if core.isalpha() and not _TRIPLE.search(core):
            return (core,)
        # Marks at the end are punctuation, but one in front may stand for a letter.
        front = part.strip("\"'.,;:?#%&()[]{}<>/\\~=-_ ").rstrip(_EDGE)
        if _TRIPLE.search(core) or _INSIDE.search(front):
            return tuple(_LETTERS.findall(self.decode(front)))
        return tuple(_LETTERS.findall(core))

    def readings(self, part: str) -> tuple[str, ...]:
        """The words of a part, and those it has if digits and symbols at its edges may stand for
        letters as well as be punctuation or numbers: the channel may still read them as
        themselves."""
        words = self.words(part)
        loose = part.strip(_PLAIN_EDGE)
        if loose.startswith("(") and ")" in part:
            loose = loose.lstrip("(")
        if not _BESIDE.search(loose):
            return words
        return tuple(dict.fromkeys([*words, *_LETTERS.findall(self.decode(loose))]))

    def restore(self, text: str) -> str:
        """The whole text with noisy words and spelt-out runs replaced by their readings."""
        return " ".join(" ".join(self.words(part)) for part in self.unspelt(text).split())


# --- the scorer ------------------------------------------------------------------------------

_PREFIXES = range(3, 9)
#: Strength of the prior on a feature's share of toxic documents, in documents.
_PRIOR = 2.0
#: Contexts of toxic documents that make a feature stand on its own.
_CONTEXTS = 8


def features(word: str) -> Iterator[str]:
    """A word and its beginnings: inflected forms share them. Whole words end in a blank."""
    yield word + " "
    for n in _PREFIXES:
        if len(word) < n:
            break
        yield word[:n]


@dataclass
class ToxicityModel:
    """Decoder and lexicon: each feature with its share of toxic documents."""

    trigrams: np.ndarray
    lexicon: dict[str, float]
    base: float

    def __post_init__(self):
        self._seen: set[str] = set()
        self._toxic: dict[str, float] = {}  # of the parts seen, those that may do harm
        self._restorer: Restorer | None = None
        self._whole = {f[:-1]: p for f, p in self.lexicon.items() if f.endswith(" ")}
        sizes = sorted({len(f) for f in self.lexicon if not f.endswith(" ")})
        heads = sorted({f.rstrip() for f in self.lexicon})
        self._head = re.compile("|".join(map(re.escape, heads)) if heads else r"(?!)")
        self._starts = [
            (n, {f: p for f, p in self.lexicon.items() if len(f) == n and not f.endswith(" ")})
            for n in sizes
        ]

    def __getstate__(self):
        return {"trigrams": self.trigrams, "lexicon": self.lexicon, "base": self.base}

    def __setstate__(self, state):
        self.__init__(state["trigrams"], state["lexicon"], state["base"])

    def restorer(self) -> Restorer:
        if self._restorer is None:
            self._restorer = Restorer(log_model(self.trigrams))
        return self._restorer

    def _log_clean(self, part: str) -> float:
        """log of the probability that a part of the restored text is harmless."""
        worst = 0.0
        for word in self.restorer().readings(part):
            if not self._head.match(word):
                continue
            worst = max(worst, self._whole.get(word, 0.0))
            for n, starts in self._starts:
                worst = max(worst, starts.get(word[:n], 0.0))
        return math.log1p(-worst)

    def score(self, text: str) -> float:
        """1 minus the probability that every distinct part is harmless, and the text as well."""
        parts = set(self.restorer().unspelt(text).split())
        new = parts - self._seen
        for part in new:
            if log_clean := self._log_clean(part):
                self._toxic[part] = log_clean
        self._seen |= new
        # fsum does not depend on the order of the set.
        harm = math.fsum(self._toxic[part] for part in parts & self._toxic.keys())
        if len(self._seen) > 400_000:
            self._seen.clear()
            self._toxic.clear()
        return 1 - (1 - self.base) * math.exp(harm)


class DocumentFeatures:
    """The features of a restored text; those of parts seen before are kept."""

    def __init__(self, restorer: Restorer):
        self._restorer, self._kept = restorer, {}

    def __call__(self, text: str) -> set[str]:
        if len(self._kept) > 200_000:
            self._kept.clear()
        found: set[str] = set()
        for part in set(self._restorer.unspelt(text).split()):
            if part not in self._kept:
                words = self._restorer.readings(part)
                self._kept[part] = tuple({f for word in words for f in features(word)})
            found.update(self._kept[part])
        return found


def context(found: set[str]) -> int:
    """A number that near copies mostly share: the least hash of a text's whole words."""
    words = (f for f in found if f.endswith(" "))
    return min((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), default=0)


def learn(
    shares: dict[str, tuple[int, int]],
    toxic_docs: list[tuple[int, Iterable[str]]],
    n_toxic: int,
    n_clean: int,
) -> tuple[dict[str, float], float]:
    """(lexicon, base) by sequential covering.

    ``shares`` has (toxic, clean) document counts of candidate features, ``toxic_docs`` the
    context and the candidates of each toxic document. The feature that explains most toxic
    documents not yet explained, weighed by its share, goes first, until none explains two more:
    what holds by chance in a few documents that others explain is not taken. Features that
    stand on their own are: held by toxic documents of many contexts and by next to no clean
    one. Copies of one document are one context, so their other words prove nothing.
    """
    prior = (n_toxic + 0.5) / (n_toxic + n_clean + 1)

    def share(feature: str) -> float:
        toxic, clean = shares[feature]
        return (toxic + _PRIOR * prior) / (toxic + clean + _PRIOR)

    holders: dict[str, set[int]] = {}
    contexts: dict[str, set[int]] = {}
    for i, (about, found) in enumerate(toxic_docs):
        for feature in found:
            holders.setdefault(feature, set()).add(i)
            contexts.setdefault(feature, set()).add(about)
    lexicon: dict[str, float] = {}
    open_docs = set(range(len(toxic_docs)))
    value = {f: len(docs) * share(f) ** 4 for f, docs in holders.items()}
    queue = sorted(value, key=lambda f: (-value[f], -len(f), f))
    # Values only fall as documents are explained, so a feature whose value still stands after
    # it is counted again is the best.
    while queue:
        best, top = None, 0.0
        for f in queue:
            if value[f] <= top:
                break
            fresh = len(holders[f] & open_docs)
            value[f] = fresh * share(f) ** 4
            if fresh >= 2 and value[f] > top:
                best, top = f, value[f]
        if best is None:
            break
        lexicon[best] = min(share(best), 0.999)
        open_docs -= holders[best]
        rest = (f for f in queue if value[f] > 0 and f != best)
        queue = sorted(rest, key=lambda f: (-value[f], -len(f), f))
    # Longest first, so that of beginnings with the same holders only the longest is taken, and
    # a beginning of five letters before the whole word, as it meets inflected forms too.
    alone: list[str] = []
    order = lambda f: (-len(f.rstrip()), f.endswith(" ") == (len(f.rstrip()) >= 5), f)
    for f in sorted(contexts, key=order):
        toxic, clean = shares[f]
        if len(contexts[f]) >= _CONTEXTS and clean <= 0.02 * toxic:
            if not any(g.startswith(f.rstrip()) and shares[g][0] >= 0.9 * toxic for g in alone):
                alone.append(f)
                lexicon.setdefault(f, min(share(f), 0.999))
    base = (len(open_docs) + 0.5) / (len(open_docs) + n_clean + 1)
    return lexicon, min(base, 0.4)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS
) -> ToxicityModel:
    """The character model of all documents, and a lexicon learnt from restored labelled ones
    outside the held-out fold, at most about ``train_rows``.

    Feature counts are summed in the tasks and then over them. The driver gets features that
    three toxic documents hold and of whose holders most are toxic, and where they occur in the
    sample's toxic documents: both are bounded by the sample.
    """
    trigrams = corpus_trigrams(docs)
    sample = training_rows(docs, labels, "toxic", train_rows)
    sizes = sample.groupBy("label").agg(F.count("*").alias("n")).collect()
    kinds = {r["label"]: r["n"] for r in sizes}
    n_toxic, n_clean = kinds.get(1, 0), kinds.get(0, 0)
    if not n_toxic:
        return ToxicityModel(trigrams, {}, 0.5 / (n_clean + 1))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = DocumentFeatures(Restorer(log_model(trigrams)))
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                found[label].update(of(text))
        # Only what a toxic document of the sample holds can become a candidate, but counts of
        # clean documents come from all tasks, so both are sent.
        names = list(found[1].keys() | found[0].keys())
        yield pd.DataFrame(
            {
                "feature": names,
                "toxic": [found[1][f] for f in names],
                "clean": [found[0][f] for f in names],
            }
        )

    counted = (
        sample.select("text", "label")
        .mapInPandas(lean(count), "feature string, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= 3) & (F.col("clean") < F.col("toxic")))
    )
    shares = {r["feature"]: (r["toxic"], r["clean"]) for r in counted.collect()}
    candidates = frozenset(shares)

    def occur(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = DocumentFeatures(Restorer(log_model(trigrams)))
        for batch in batches:
            held = [of(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "context": [context(f) for f in held],
                    "found": [sorted(f & candidates) for f in held],
                }
            )

    toxic = sample.filter("label = 1").select("id", "text")
    rows = toxic.mapInPandas(lean(occur), "id long, context long, found array<string>").collect()
    rows.sort(key=lambda r: (r["id"], r["found"]))
    toxic_docs = [(r["context"], r["found"]) for r in rows]
    lexicon, base = learn(shares, toxic_docs, n_toxic, n_clean)
    return ToxicityModel(trigrams, lexicon, base)


def toxicity(model: ToxicityModel, text: Column) -> Column:
    """The score of each text, 0 to 1, higher for toxic ones. An empty text gets the least."""

    @pandas_udf("double")
    @lean
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(model.score).astype("float64")

    return run(text)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, score, predicted).

    Null text counts as empty; a null id is never held out; repeated rows get the same score;
    other columns are ignored; an empty table gives no rows. Whole texts are scored, whatever
    their length.
    """
    model = fit_toxicity(docs, labels, train_rows)
    scored = docs.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        toxicity(model, text_of()).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= LEAST_SCORE).cast("int"))
