"""Ids of whole texts by a word-end BPE file, with the ids of words seen before kept."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from operator import attrgetter

from tokenizers import Tokenizer, pre_tokenizers

#: Words kept per Python worker; beyond it the older half starts over. Some 200 bytes a word.
CACHE_WORDS = 800_000
#: A word of Latin letters, each one code point in every normal form, and what closes it: ASCII
#: marks, which the file parts from letters. So few that all of them can be kept.
_ID = attrgetter("id")
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]{0,3})")


class WordTokenizer:
    """Ids by a ``tokenizers`` file whose merges never cross white space.

    The file's pre-tokenizer drops white space, so a text's ids are those of its parts between
    white space, one after the other. Parts repeat, so most are looked up.
    """

    #: White space to ``str.split``, but not to the tokenizer; such texts are encoded whole.
    _SEPARATORS = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str, spell_special: bool = False, cache_words: int = CACHE_WORDS):
        """With ``spell_special`` the names of special tokens in a text are plain text, so their
        ids occur nowhere; else they are those tokens, as in the file."""
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = spell_special
        self._cache_words = cache_words
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = map(chr, range(0xDF, 0x100))
        self._spelling = {ord(c): spelt.pre_tokenize_str(c)[0][0] for c in letters}
        self._marks = _Known(self._whole)
        self._merge = self._tokenizer.model.tokenize
        self._young, self._old = _Known(self._encode), {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        known = self._young.__getitem__
        parts = ([t] if self._SEPARATORS.search(t) else t.split() for t in texts)
        found = [b"".join(map(known, part)) for part in parts]
        if len(self._young) > self._cache_words // 2:
            self._old, self._young = self._young, _Known(self._encode)
        return found

    def _whole(self, part: str) -> bytes:
        (encoded,) = self._tokenizer.encode_batch_fast([part], add_special_tokens=False)
        return array("I", encoded.ids).tobytes()

    def _encode(self, part: str) -> bytes:
        """Plain words go to the merges directly, each with its closing mark's ids behind; the
        tokenizer's own steps would only lower their case and spell their bytes. The bare word is
        kept too, so that its other cases and marks need no merges."""
        young, old = self._young, self._old
        ids = old.get(part)
        if ids is not None:
            return ids
        found = _PLAIN.fullmatch(part)
        if not found:
            return self._whole(part)
        word, mark = found.groups()
        word = word.lower()
        ids = young.get(word) or old.get(word)
        if ids is None:
            spelt = word if word.isascii() else word.translate(self._spelling)
            ids = array("I", map(_ID, self._merge(spelt))).tobytes()
        young[word] = ids
        return ids + self._marks[mark]


class _Known(dict):
    """Ids by part. A part not seen before is encoded when it is first asked for, so that texts
    are gone through once."""

    def __init__(self, encode: Callable[[str], bytes]):
        self._encode = encode

    def __missing__(self, part: str) -> bytes:
        ids = self[part] = self._encode(part)
        return ids


@lru_cache(maxsize=2)
def word_tokenizer(
    path: str, spell_special: bool = False, cache_words: int = CACHE_WORDS
) -> WordTokenizer:
    """One per Python worker. The file is read where the task runs."""
    return WordTokenizer(path, spell_special, cache_words)
