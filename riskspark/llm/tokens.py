"""Tokenizer files on executors: encoding with per-worker reuse of repeated words, and the bytes of each id.

A tokenizer's file is a parameter; the file must be at that path on every machine (as the
installed vocabulary packages are). Nothing here trains or copies a vocabulary.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: A worker forgets its encoded words beyond so many (about 200 bytes each).
CACHE_WORDS = 400_000
#: Longer stretches without a break are encoded but not remembered.
CACHE_CHARS = 64

_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer in a file, without truncation and padding; once per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class _Broken(Exception):
    """A piece between spaces that is empty or has white space at an end."""


class _Cache(dict):
    """piece -> ids as packed little-endian integers; encodes what it has not seen."""

    def __init__(self, tokenizer, dtype: str, before: str = ""):
        super().__init__()
        self.encode, self.dtype, self.before = tokenizer.encode, dtype, before

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Broken
        return self.put(piece)

    def put(self, piece: str) -> bytes:
        ids = np.array(self.encode(self.before + piece, add_special_tokens=False).ids, self.dtype).tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[piece] = ids
        return ids


class SpacedEncoder:
    """Encoder for a byte-level BPE whose words take the space before them.

    A single space between two characters that are not white space always begins a word of
    the tokenizer's pattern, and what follows is split the same way whatever stands before.
    So the text between such spaces is encoded apart, with the space in front, and reused.
    """

    def __init__(self, path: str):
        t = load(path)
        self.dtype = "<u2" if t.get_vocab_size() <= 1 << 16 else "<u4"
        self.first, self.spaced = _Cache(t, self.dtype), _Cache(t, self.dtype, " ")

    def encode(self, text: str) -> bytes:
        """Ids of a text as packed integers; a text that begins with a space is taken to follow a word."""
        if not text:
            return b""
        after = text[0] == " " and len(text) > 1 and not text[1].isspace()
        body = text[1:] if after else text
        head = self.spaced if after else self.first
        parts = body.split(" ")
        try:
            return head[parts[0]] + b"".join(map(self.spaced.__getitem__, parts[1:]))
        except _Broken:
            parts = _BETWEEN_WORDS.split(body)
            got = [(head if not k else self.spaced) for k in range(min(2, len(parts)))]
            return b"".join((got[min(k, 1)].get(p) or got[min(k, 1)].put(p)) for k, p in enumerate(parts))


class WordEncoder:
    """Encoder for a lower-casing tokenizer that drops white space: each word of a text has the same ids anywhere.

    A word of Latin letters and closing punctuation is two words of the tokenizer's pattern, so
    its letters, lower-cased, are looked up by themselves: spellings with capitals or a comma
    share one entry.
    """

    def __init__(self, path: str):
        t = load(path)
        self.dtype = "<u2" if t.get_vocab_size() <= 1 << 16 else "<u4"
        self.cache = _BytesCache(t, self.dtype)

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.cache.__getitem__, text.split()))  # bytes.split(): ASCII white space only


#: A worker forgets its words, and the parts of words, beyond so many (about 180 bytes an entry).
WORD_ENTRIES, PART_ENTRIES = 500_000, 1_200_000
_LETTERS_AND_END = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]+)?")


class _BytesCache(_Cache):
    def __init__(self, tokenizer, dtype: str):
        super().__init__(tokenizer, dtype)
        self.parts: dict[str, bytes] = {}
        self.model = tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        m = _LETTERS_AND_END.fullmatch(text)
        ids = self.part(text) if m is None else self.part(m[1].lower(), True) + (self.part(m[2]) if m[2] else b"")
        if len(word) <= CACHE_CHARS:
            if len(self) >= WORD_ENTRIES:
                self.clear()
            self[word] = ids
        return ids

    def part(self, text: str, letters: bool = False) -> bytes:
        """Ids of a text; lower-case Latin letters go straight to the tokenizer's merges, as they are one pattern word."""
        ids = self.parts.get(text)
        if ids is None:
            if letters:
                shown = text if text.isascii() else "".join(map(byte_characters().__getitem__, text.encode("utf-8")))
                found = [x.id for x in self.model.tokenize(shown)]
            else:
                found = self.encode(text, add_special_tokens=False).ids
            ids = np.array(found, self.dtype).tobytes()
            if len(text) <= CACHE_CHARS:
                if len(self.parts) >= PART_ENTRIES:
                    self.parts.clear()
                self.parts[text] = ids
        return ids


@lru_cache(maxsize=4)
def spaced_encoder(path: str) -> SpacedEncoder:
    return SpacedEncoder(path)


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """How byte-level vocabularies write each byte: as itself where it is a printable character,
    else as the next free character from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def id_bytes(path: str) -> list[bytes]:
    """The bytes that each id of a byte-level BPE stands for."""
    char = {c: b for b, c in enumerate(byte_characters())}
    t = load(path)
    special = {i: a.content.encode() for i, a in t.get_added_tokens_decoder().items()}
    out = [b""] * t.get_vocab_size()
    for token, i in t.get_vocab().items():
        out[i] = special[i] if i in special else bytes(char[c] for c in token)
    return out
