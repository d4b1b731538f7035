"""Byte-level BPE encoding with the tokenizers library, with a cache of words.

The vocabulary's pre-tokens never join text across a space that stands before a
character other than white space, so a text may be cut there and its parts encoded
one by one. Parts repeat; each distinct one is encoded once per worker and cache.
"""

from __future__ import annotations

import os
import re

import numpy as np

_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|\Z)")
#: How byte-level vocabularies write UTF-8 bytes: printable Latin-1 characters stand for themselves, the others follow from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_loaded: dict = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """``encode`` gives a text's ids as little-endian bytes of ``dtype``."""

    CACHED = 700_000  # parts, and as many words; about 200 MB
    LONGEST = 64  # characters of a part or word that is kept, so the caches are bounded in bytes too

    def __init__(self, vocabulary: str, dtype: str = "<u2"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.dtype, self.cache, self.words, self.tails, self.sizes = np.dtype(dtype), {}, {}, {}, {}
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[i for t, i in self.tokenizer.get_vocab().items() if t[0] == "\u0120"]] = True  # how the vocabulary writes a space

    def _add(self, parts: list[str], into: dict) -> None:
        for part, e in zip(parts, self.tokenizer.encode_batch_fast(parts, add_special_tokens=False), strict=True):
            into[part] = np.array(e.ids, self.dtype).tobytes()

    def _add_spaced(self, parts: list[str], into: dict) -> None:
        """Parts as they stand after a space. Those without a space inside are encoded as one text, cut again at the tokens that begin with one."""
        inner = [x for x in parts if " " in x]
        if inner:
            self._add([" " + x for x in inner], spaced := {})
            into.update((x, spaced[" " + x]) for x in inner)
            parts = [x for x in parts if " " not in x]
        if not parts:
            return
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(parts)], add_special_tokens=False)[0].ids, self.dtype)
        begin = np.flatnonzero(self.spaced[ids])
        if len(begin) != len(parts):
            self._add([" " + x for x in parts], spaced := {})
            into.update((x, spaced[" " + x]) for x in parts)
            return
        data, width = ids.tobytes(), self.dtype.itemsize
        at = (begin * width).tolist()
        into.update(zip(parts, map(data.__getitem__, map(slice, at, [*at[1:], len(data)])), strict=True))

    def parts(self, text: str) -> list[str]:
        """Parts without the space before each but the first."""
        return _CUT.split(text) if _ODD.search(text) else text.split(" ")

    def _add_words(self, parts: list[str], into: dict) -> None:
        """Letters, perhaps with punctuation after them, are one pre-token or two: these go to the model itself, the rest through the whole encoder."""
        other, word, tokenize, dtype = [], self.words.get, self.tokenizer.model.tokenize, self.dtype
        for part in parts:
            base = part.rstrip(".,;:!?")
            if not base.isalpha():
                other.append(part)
                continue
            if (ids := word(base)) is None:
                t = "\u0120" + (base if base.isascii() else base.encode().decode("latin-1").translate(_BYTES))
                ids = np.array([x.id for x in tokenize(t)], dtype).tobytes()
                if len(base) <= self.LONGEST:
                    self.words[base] = ids
            if len(base) < len(part):
                tail = part[len(base) :]
                if (end := self.tails.get(tail)) is None:
                    end = np.array([x.id for x in tokenize(tail)], dtype).tobytes()
                    if len(tail) < 8:
                        self.tails[tail] = end
                ids += end
            into[part] = ids
        self._add_spaced(other, into)

    def counts(self, parts: list[str]) -> list[int]:
        """Tokens of parts which all but the first begin with a space before a character (the first may)."""
        if len(self.sizes) > self.CACHED:
            self.sizes.clear()
        if len(self.words) > 2 * self.CACHED:
            self.words.clear()
        sizes, width = self.sizes, self.dtype.itemsize
        missing = [x for x in dict.fromkeys(parts) if x not in sizes]
        if missing:
            self._add_words([x[1:] for x in missing if x[0] == " " and x[1:2].strip()], into := {})
            self._add([x for x in missing if x[0] != " " or not x[1:2].strip()], other := {})
            sizes.update({" " + x: len(v) // width for x, v in into.items()} | {x: len(v) // width for x, v in other.items()})
        out = [sizes[x] for x in parts]
        for x in missing:
            if len(x) > self.LONGEST:
                del sizes[x]
        return out

    def encode_all(self, texts: list[str | None]) -> list[list[bytes]]:
        """The ids of each part of each text."""
        for kept in (self.cache, self.words):
            if len(kept) > self.CACHED:
                kept.clear()
        cache, split = self.cache, [self.parts(t) if t else [] for t in texts]
        first = [p[0] if p else "" for p in split]
        rest = [p[1:] for p in split]
        extra = set().union(*rest).difference(cache)
        self._add_words(list(extra), encoded := {})
        self._add([x for x in first if x], begin := {"": b""})
        long = {x: encoded.pop(x) for x in extra if len(x) > self.LONGEST}
        cache.update(encoded)
        get = cache.__getitem__ if not long else lambda x: cache[x] if x in cache else long[x]
        return [[begin[x], *map(get, p)] if x or p else [] for x, p in zip(first, rest, strict=True)]


def encoder(vocabulary: str, dtype: str = "<u2") -> Encoder:
    """One encoder per worker process, vocabulary and type."""
    if (key := (vocabulary, dtype)) not in _loaded:
        _loaded[key] = Encoder(vocabulary, dtype)
    return _loaded[key]
