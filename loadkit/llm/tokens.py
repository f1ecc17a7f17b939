"""Token ids of whole texts, word by word with a cache in each Python worker."""

from __future__ import annotations

import os
import string
import sys
import unicodedata
from array import array

import numpy as np

from .common import remembered

#: Words that a worker remembers unless told otherwise; then it starts anew. So many take about 250 MB.
CACHE = 900_000
END = 1
_MARKS = string.punctuation.encode()
_GROWS = "\u0130".encode()
_PROBE = ["Word".encode(), "\u00c9t\u00e9".encode(), "\u65e5\u672c".encode(), b"theonward", "stra\u00dfe".encode()]
#: Byte-level vocabularies write a byte without a visible character of its own as the next one from U+0100.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_VISIBLE = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class Encoder:
    """Ids of texts in a vocabulary file of the tokenizers library, as little-endian 16-bit numbers
    (32-bit for a vocabulary beyond 65,536 ids).

    A text is parted at ASCII white space and each word's ids are kept for the next time. That
    gives the ids of the whole text only for a tokenizer that drops white space before it looks
    for merges, as the word vocabularies do; `whole=True` encodes texts as they are. Words of
    letters, with or without marks after them, go to the library's merge model directly; the
    few steps before it are no work for them. A probe at the start tells if that holds, and
    if case matters; if not, A-Z is lowered first (unless a special token may be meant). The one
    character whose lower case is longer than itself (U+0130) makes the library part the marks
    after it in another way; texts that hold it are encoded whole.
    """

    def __init__(self, path: str, whole: bool = False, words: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.whole, self.words = Tokenizer.from_file(path), whole, words
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache: dict[bytes, bytes] = {}
        self.direct = sys.byteorder == "little"
        self.cased = self._library([b"Aa"])[b"Aa"] != self._library([b"aa"])[b"aa"]
        self.direct = self.direct and all(self._model(w) == self._library([w])[w] for w in _PROBE)

    def __call__(self, raws: list[bytes]) -> list[bytes]:
        if self.whole:
            found = self.tokenizer.encode_batch([r.decode() for r in raws], add_special_tokens=False)
            return [np.array(e.ids, self.dtype).tobytes() for e in found]
        return [self._whole(r) if _GROWS in r else self._words((r if self.cased or b"<|" in r else r.lower()).split()) for r in raws]

    def _whole(self, raw: bytes) -> bytes:
        return np.array(self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids, self.dtype).tobytes()

    def _words(self, words: list[bytes]) -> bytes:
        ids = list(map(self.cache.get, words))
        if None in ids:
            self._learn(list({w for w, i in zip(words, ids, strict=True) if i is None}))
            ids = [self.cache[w] if i is None else i for w, i in zip(words, ids, strict=True)]
            if len(self.cache) > self.words:
                self.cache.clear()
        return b"".join(ids)

    def _learn(self, words: list[bytes]) -> None:
        cache, other, parts = self.cache, [], []
        if self.direct:
            for word in words:
                core = word.rstrip(_MARKS)
                if core != word and not (core[-1:].isalnum() or core.decode()[-1:].isalpha()):
                    other.append(word)
                    continue
                ids = cache.get(core)
                if ids is None and (ids := self._model(core) if core else None) is None:
                    other.append(word)
                    continue
                cache[core] = ids
                if len(core) < len(word):
                    parts.append((word, ids, word[len(core) :]))
        else:
            other = words
        cache |= self._library([*other, *{marks for _, _, marks in parts}.difference(cache)])
        for word, ids, marks in parts:
            cache[word] = ids + cache[marks]

    def _model(self, word: bytes) -> bytes | None:
        """Ids of a word of letters; None if it has anything else or isn't in its normal form."""
        if word.isalpha():
            shown = word.lower().decode()
        else:
            text = word.decode()
            low = text.lower()
            if not text.isalpha() or not low.isalpha() or not unicodedata.is_normalized("NFC", text) or "\u03a3" in text:
                return None
            shown = low.encode().decode("latin-1").translate(_VISIBLE)
        return array(self.dtype.char, [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _library(self, words: list[bytes]) -> dict[bytes, bytes]:
        if not words:
            return {}
        found = self.tokenizer.encode([w.decode() for w in words], is_pretokenized=True, add_special_tokens=False)
        owner = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
        at = (np.searchsorted(owner, np.arange(len(words) + 1)) * self.dtype.itemsize).tolist()
        raw = np.array(found.ids, self.dtype).tobytes()
        return {w: raw[start:end] for w, start, end in zip(words, at, at[1:], strict=False)}


def widened(raw: bytes, dtype: np.dtype) -> bytes:
    """The ids as little-endian unsigned 32-bit numbers."""
    return np.frombuffer(raw, dtype).astype("<u4").tobytes()


def encoder(path: str, whole: bool = False, words: int = CACHE) -> Encoder:
    """One per file and worker; Spark reuses workers, so later tasks find the cache filled."""
    return remembered(("encoder", path, whole, words), lambda: Encoder(path, whole, words))
