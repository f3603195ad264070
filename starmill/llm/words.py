"""Token ids of whole texts with the ``tokenizers`` library, encoding each distinct chunk once per worker.

Both vocabularies split a text before the merges, so a text can be cut at these split
points, and equal chunks have equal ids.  Cutting and looking up is some ten times
faster than encoding the text.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

from starmill.llm.common import claim_memory

#: Ids as little-endian unsigned 32-bit integers.
ID = np.dtype("<u4")
# A worker's memory for chunks: about 250 bytes each.
MAX_CHUNKS = 1_600_000
# White space whose characters are not split one by one.
_RUN = re.compile(r"\s\s(?:\s|\Z)")
# Letters in every version of Unicode; what combines with the letter before it begins at _COMBINING.
_CORE = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+")
_COMBINING = "\u0300"
# White space to Python, but symbols to the tokenizer.
_ODD = re.compile("[\x1c-\x1f]")


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer; strings that look like special tokens are ordinary text to it."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: printable bytes as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()
_BLANK = _BYTE_LETTERS[32]
_UINT32 = next(code for code in "IL" if array(code).itemsize == ID.itemsize)


class ChunkIds:
    """``ids(text)``: the ids as bytes (``ID``); equal to encoding the whole text.

    A run of letters is a word of its own to both vocabularies: it goes to the tokenizer's model at once.
    What else a chunk holds is encoded as a text.
    """

    def __init__(self, path: str, lower: bool, max_chunks: int = MAX_CHUNKS):
        self.tokenizer, self.max_chunks = load(path), max_chunks
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.lead = "" if lower else " "
        self.whole = lru_cache(maxsize=200_000)(self.encode)
        self.bare = lru_cache(maxsize=200_000)(self._bare)
        self.ids: Callable[[str], bytes] = self._words if lower else self._spaced

    def forget(self) -> None:
        self.known.clear(), self.bare.cache_clear(), self.whole.cache_clear()

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, ID).tobytes()

    def _word(self, word: str, lead: str) -> bytes:
        """Ids of a run of letters, with a blank before it or without."""
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        tokens = self.model.tokenize(_BLANK + letters if lead else letters)
        return array(_UINT32, [t.id for t in tokens]).tobytes()

    def _bare(self, chunk: str) -> bytes:
        """Ids of a chunk as it is."""
        return self._split(chunk, "") if chunk else b""

    def _split(self, chunk: str, lead: str) -> bytes:
        found = _CORE.match(chunk)
        if not found:
            return self.encode(lead + chunk)
        word = found.group()
        if len(word) == len(chunk):
            return self._word(word, lead)
        if chunk[len(word)] >= _COMBINING:
            return self.encode(lead + chunk)
        return (self._chunk(word) if lead == self.lead else self.bare(word)) + self.bare(chunk[len(word):])

    def _chunk(self, key: str) -> bytes:
        ids = self.known.get(key)
        if ids is None:
            if key[:1] == "\n":
                ids = self.bare("\n") + self.bare(key[1:])
            else:
                ids = self._split(key, self.lead) if key else self.encode(" ")
            if len(self.known) >= self.max_chunks:
                self.known.clear()
            self.known[key] = ids
        return ids

    def _join(self, keys: list[str]) -> bytes:
        found = list(map(self.known.get, keys))
        if None in found:
            chunk = self._chunk
            found = [chunk(k) if ids is None else ids for k, ids in zip(keys, found)]
        return b"".join(found)

    def _spaced(self, text: str) -> bytes:
        """Byte-level vocabulary: a blank belongs to the word after it, other white space stands alone."""
        if _RUN.search(text):
            return self.encode(text)
        first, *keys = text.replace("\n", " \n").split(" ")
        return self.bare(first) + self._join(keys)

    def _words(self, text: str) -> bytes:
        """Lower-case vocabulary that drops white space."""
        if _ODD.search(text):
            return self.encode(text)
        try:
            text.encode("latin-1")  # where lower() is the tokenizer's own
        except UnicodeEncodeError:
            return b"".join([self.whole(chunk) for chunk in text.split()])  # the tokenizer normalises each
        return self._join(text.lower().split())


@lru_cache(maxsize=4)
def _chunk_ids(path: str, lower: bool) -> ChunkIds:
    return ChunkIds(path, lower)


def chunk_ids(path: str, lower: bool) -> ChunkIds:
    """One for each worker process, kept from task to task until another operator runs there."""
    found = _chunk_ids(path, lower)
    claim_memory(found, found.forget)
    return found
