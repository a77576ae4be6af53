"""Encoding of texts with a public tokenizer file, cached by word inside each worker."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

CACHE_WORDS = 300_000  # entries of either cache; what comes later is encoded anew each time

# Lower-case words of one script block, and what may follow them in a word. The tokenizer's own rules cut between the two,
# and neither normalises further, so both parts can be encoded alone.
_SIMPLE = re.compile("([a-zà-öø-ÿ]+)([^a-z0-9'\\s\x00-\x20\x7f-\U0010ffff]*)").fullmatch


def _byte_letters() -> str:
    """The visible letter that byte-level tokenizers use for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return "".join(chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256))


class _Words(dict):
    """Words to ids; a word not seen before is encoded on first use."""

    def __init__(self, encode):
        super().__init__({"": b""})
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(self) < CACHE_WORDS:
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of white-space separated words as little-endian uint32 bytes.

    Holds for tokenizers that lower-case, drop white space and never merge across it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.words = _Words(self._word)
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            found = np.array([t.id for t in self.tokenizer.model.tokenize(shown)], "<u4").tobytes()
            if len(self.parts) < CACHE_WORDS:
                self.parts[part] = found
        return found

    def _word(self, word: str) -> bytes:
        simple = _SIMPLE(word.lower()) if word.isascii() or max(word) <= "ÿ" else None
        if simple:
            head, tail = simple.groups()
            return self._part(head) + self._part(tail) if tail else self._part(head)
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        for space in "\t\n\v\f\r":
            text = text.replace(space, " ")
        return b"".join(map(self.words.__getitem__, text.split(" ")))


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    return WordEncoder(path)
