"""Word-cached encoding with the lower-casing word BPE of the tokenizers library.

The tokenizer's normaliser and pre-tokenizer never look across white space, so a text's ids are the ids of its blank- or
newline-separated parts, in order. Each distinct part is encoded once per worker and kept in a cache of bounded size; parts of
plain ASCII go straight to the BPE model after the fixed pre-token pattern, all others through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_ENTRIES = 1_000_000  # of parts per worker, half as many of pre-tokens; a cache that is full is emptied
CACHE_PART_CHARS = 64  # longer parts are encoded each time

# The tokenizer's own pre-token pattern, for lower-case ASCII and Latin letters, and its byte alphabet.
_PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u024f]+|[0-9]|[^\sa-z0-9\u00df-\u00f6\u00f8-\u024f]+")
_PLAIN = re.compile(r"[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")  # without U+0130, which lower-cases to two characters
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_ALPHABET = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}
# How the model sees letters: the signs of their UTF-8 bytes. All that pieces hold is listed, since what is not costs an exception.
_SHOWN = {c: chr(c).encode().decode("latin-1").translate(BYTE_ALPHABET) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250))}


class _Cache(dict):
    """What encode gives for each key, of at most so many keys; one that is full is emptied, long keys are encoded each time."""

    def __init__(self, encode: Callable[[str], bytes], entries: int):
        self.encode, self.entries = encode, entries

    def __missing__(self, key: str) -> bytes:
        got = self.encode(key)
        if len(key) <= CACHE_PART_CHARS:
            if len(self) >= self.entries:
                self.clear()
            self[key] = got
        return got


class WordEncoder:
    """ids(text) as little-endian unsigned 32-bit bytes; equal to Tokenizer.encode(text, add_special_tokens=False).ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.parts = _Cache(self._part, CACHE_ENTRIES)
        self.pieces = _Cache(self._piece, CACHE_ENTRIES // 2)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.translate(_SHOWN)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _whole(self, part: str) -> bytes:
        return array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        if not part:
            return b""
        low = part.lower()
        if part.isascii() and low.isalpha():
            return self.pieces[low]
        if "<|" not in part and _PLAIN.fullmatch(part):
            if low.isalpha():
                return self.pieces[low]
            return b"".join(map(self.pieces.__getitem__, _PRETOKEN.findall(low)))
        return self._whole(part)

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=2)
def piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)
