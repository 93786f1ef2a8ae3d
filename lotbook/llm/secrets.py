"""Secret scans: keyword, key-id and hex patterns, and runs of high sliding-window entropy."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate, islice, pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lotbook.llm.common import lean, text_of

#: Kinds in the order of ties, with the shortest length that counts (of group 2 for "assign").
KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: One of these is in every text with a keyword, its letters folded.
_STEMS = ("passw", "secret", "token", "api")

#: Entropy scan: candidate strings, window, and bits a character that a window must reach.
WINDOW = 20
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Bars by the narrowest class that a window's characters fit, narrowest first. Digits alone are
#: numbers, whatever their entropy.
_CLASSES = (
    (frozenset("0123456789"), math.inf),
    (frozenset("0123456789abcdef"), 3.0),
    (frozenset("0123456789ABCDEF"), 3.0),
    (frozenset("0123456789abcdefABCDEF"), 3.0),
    (frozenset("abcdefghijklmnopqrstuvwxyz"), 3.2),
    (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), 3.2),
)
_ALNUM_BITS, _ANY_BITS = 3.7, 3.9
#: Steps of a window to the next character of the alphabet, or back, that make it a list of them.
_LISTED = WINDOW // 2
#: High-entropy strings that are no secrets: UUIDs.
ALLOWED = (r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",)
#: Words and short numbers joined by marks, paths for one. Each mark run has one place to match, so
#: the time is linear. Such strings are secrets only where their letters do not look like words.
_WORDS = re.compile(
    r"[/_=+-]*(?:[A-Za-z]+|[0-9]{1,8})(?:[/_=+-]+(?:[A-Za-z]+|[0-9]{1,8}))*[/_=+-]*"
)
# Letter pairs that make up most of English, German, French and Spanish words, about
# a quarter of all pairs. Of a random string's pairs a quarter is among them.
_PAIRS = frozenset(
    """th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve
    co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur ca el ta la ns di fo ho pe ec pr no ct
    us ac ot il tr ly nc et ut ss so rs un lo wa ge ie wh ee wi em ad ol rt po we na ul ni ts mo ow
    pa im mi ai sh ir su id os iv ia am fi ci vi pl ig tu ev ld ry mp fe bl ab gh ty op wo sa ay ex
    ke fr oo av ag if ap gr od bo sp rd do uc bu ei ov rm ep tt oc fa ef cu rn sc gi da cr cl qu ue
    va um au ck ht tz pf eu ux oi ze zu uf ah ez ja lt br ru""".split()
)
#: Least share of a window's letter pairs that are such pairs in words, and letter pairs that a
#: window must hold to be told from words.
_WORDLIKE, _TOLD = 0.6, WINDOW // 2

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the three patterns, leftmost and without overlap within a kind.

    A match that is too short is dropped and still uses up its characters.
    """
    spans: list[Span] = []
    folded = text.lower()
    if any(stem in folded for stem in _STEMS):
        spans += [
            (m.start(), m.end(), "assign")
            for m in _ASSIGN.finditer(text)
            if len(m.group(2)) >= 8
        ]
    if "AKIA" in text:
        spans += [
            (m.start(), m.end(), "access")
            for m in _ACCESS.finditer(text)
            if m.end() - m.start() >= 16
        ]
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return spans


_TERM = [0.0, 0.0] + [c * math.log2(c) for c in range(2, WINDOW + 1)]


def window_bits(run: str) -> Iterator[float]:
    """Entropy of each window, by start.

    Counts change by one character in and one out per step, so a run costs its length, not its
    length times the window.
    """
    window = WINDOW
    counts: dict[str, int] = {}
    total = 0.0  # the sum of c * log2(c) over the window's characters
    for i, char in enumerate(run):
        if i >= window:
            old = run[i - window]
            total += _TERM[counts[old] - 1] - _TERM[counts[old]]
            counts[old] -= 1
        count = counts.get(char, 0)
        total += _TERM[count + 1] - _TERM[count]
        counts[char] = count + 1
        if i >= window - 1:
            yield math.log2(window) - total / window


def _sums(marks: Iterable[bool]) -> list[int]:
    return [0, *accumulate(marks)]


def window_bars(run: str) -> Iterator[float]:
    """The bar of each window: that of the narrowest class which holds all its characters, so
    neighbours of another class do not raise it. Runs along the alphabet are no secrets."""
    outside = [(_sums(c not in members for c in run), bits) for members, bits in _CLASSES]
    marks = _sums(not c.isalnum() for c in run)
    codes = [ord(c) for c in run]
    up, down = (
        _sums(b - a == step for a, b in pairwise(codes)) for step in (1, -1)
    )
    for start in range(len(run) - WINDOW + 1):
        end = start + WINDOW
        if max(up[end - 1] - up[start], down[end - 1] - down[start]) >= _LISTED:
            yield math.inf
            continue
        for sums, bits in outside:
            if sums[end] == sums[start]:
                yield bits
                break
        else:
            yield _ALNUM_BITS if marks[end] == marks[start] else _ANY_BITS


def hot_starts(run: str) -> list[int]:
    """Starts of the windows whose entropy reaches their bar."""
    levels = zip(window_bits(run), window_bars(run), strict=True)
    return [start for start, (bits, bar) in enumerate(levels) if bits >= bar - 1e-9]


def odd_starts(run: str) -> Iterator[int]:
    """Starts of the windows whose letter pairs are not those of words."""
    low = run.lower()
    pairs, common = [0], [0]
    for pair in map("".join, zip(low, low[1:])):  # noqa: B905
        pairs.append(pairs[-1] + pair.isalpha())
        common.append(common[-1] + (pair in _PAIRS))
    for start in range(len(run) - WINDOW + 1):
        end = start + WINDOW - 1
        told = pairs[end] - pairs[start]
        if told >= _TOLD and common[end] - common[start] < _WORDLIKE * told:
            yield start


def hot_stretches(run: str, allowed: re.Pattern) -> Iterator[tuple[int, int]]:
    """Start and end of what the hot windows of a string cover, windows that meet together.

    Windows without digits, and all windows of a string of words and short numbers, count only
    if their letters do not look like words.
    """
    if len(run) < WINDOW or allowed.fullmatch(run):
        return
    starts = hot_starts(run)
    if starts:
        odd = set(odd_starts(run))
        words = _WORDS.fullmatch(run) is not None
        digits = _sums(c.isdigit() for c in run)
        starts = [
            s for s in starts if s in odd or not words and digits[s + WINDOW] > digits[s]
        ]
    for i, start in enumerate(starts):
        if i == 0 or start > starts[i - 1] + WINDOW:
            first = start
        if i + 1 == len(starts) or starts[i + 1] > start + WINDOW:
            yield first, start + WINDOW


def entropy_spans(text: str, allowed: re.Pattern, base: Iterable[Span] = ()) -> list[Span]:
    """The hot stretches of candidate strings; of those that base spans touch, of what is left
    beside them. ``base`` is in the order of the starts."""
    spans: list[Span] = []
    taken = list(base)
    first = 0
    for candidate in _CANDIDATE.finditer(text):
        at, close = candidate.span()
        if allowed.fullmatch(candidate.group()):
            continue
        # Later candidates meet no base span that ends before this one.
        while first < len(taken) and taken[first][1] <= at:
            first += 1
        rest = []
        for start, end, _ in islice(taken, first, None):
            if start >= close:
                break
            if start > at:
                rest.append((at, start))
            at = max(at, end)
        if at < close:
            rest.append((at, close))
        for a, b in rest:
            spans += [(a + s, a + e, "entropy") for s, e in hot_stretches(text[a:b], allowed)]
    return spans


def find_spans(text: str, allowed: re.Pattern) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start, then kind. Entropy spans are looked for beside the
    base spans, so none touches one."""
    order = lambda span: (span[0], KINDS.index(span[2]))
    base = sorted(base_spans(text), key=order)
    return base, sorted(base + entropy_spans(text, allowed, base), key=order)


def _allow(patterns: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(f"(?:{p})" for p in patterns))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(text: Column, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """struct(n_assign, n_access, n_hex, n_entropy, base_sha256, spans) of each text."""
    names = ["n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"]

    @pandas_udf(
        "n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"
    )
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        allow = _allow(allowed)
        for texts in batches:
            rows = []
            for text in texts:
                base, spans = find_spans(text or "", allow)
                kinds = [kind for _, _, kind in spans]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in KINDS), digest, _joined(spans)))
            yield pd.DataFrame(rows, columns=names)

    return run(text)


def redact(text: Column, mark: str = "[SECRET]", allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Each text with every found span, overlapping ones together, replaced by ``mark``.

    A text without findings stays as it is, a null stays null.
    """

    @pandas_udf("string")
    @lean
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        allow = _allow(allowed)
        for texts in batches:
            yield texts.map(lambda t: t if t is None else _redacted(t, allow, mark))

    return run(text)


def _redacted(text: str, allow: re.Pattern, mark: str) -> str:
    parts, at = [], 0
    for start, end, _ in find_spans(text, allow)[1]:
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], mark]
        at = end
    return "".join([*parts, text[at:]])


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts by kind, a digest of the base spans and
    all spans as ``kind:start:end``, in code points, the end exclusive.

    Null text counts as empty; without findings the lists are empty strings. Null ids stay,
    repeated rows give repeated results, other columns are ignored, an empty table gives no
    rows. No shuffle; memory holds one Arrow batch.
    """
    return docs.select("doc_id", scan(text_of()).alias("s")).select("doc_id", "s.*")
