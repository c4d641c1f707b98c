"""Token ids of whole texts, with a cache of pre-tokens in each worker.

The public vocabularies of byte-level kind split a text into pre-tokens first and encode
each by itself, so a pre-token's ids can be remembered. The split is done here only for
texts of characters about whose class all Unicode versions agree (Latin letters and
common punctuation) and without the vocabulary's special strings; any other text goes to
the library whole. The ids are the library's in either case.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"
#: The splits that the two vocabularies name in their files, for the
#: characters above; alternatives that begin differently are in the order of their use.
GPT_SPLIT = re.compile(
    rf" ?[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"
)
WORD_SPLIT = re.compile(rf"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")
#: Controls that are space to some libraries only, the dotted capital I, and all beyond Latin.
UNUSUAL = re.compile("[^\x00-\x1b\x20-\x84\x86-įı-ſ‐-‧‰-⁞]")
CACHE_SIZE = 500_000
CACHED_CHARS = 64
#: Byte-level vocabularies write a byte as the Latin-1 character, and the bytes that have none
#: to be seen as the characters from U+0100 on, in turn.
_HIDDEN = [b for b in range(256) if b < 33 or 127 <= b <= 160 or b == 173]
BYTE_LEVEL = {b: 256 + k for k, b in enumerate(_HIDDEN)}


class Encoder(dict):
    """Pre-token to its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [x["content"] for x in described["added_tokens"]]
        self.lower, self.split = False, None
        first, then = described["normalizer"], described["pre_tokenizer"]
        kinds = [x["type"] for x in (first or {}).get("normalizers", [])]
        if first is None and then["type"] == "ByteLevel" and then["use_regex"] and not then["add_prefix_space"]:
            self.split = GPT_SPLIT
        elif kinds == ["NFC", "Replace", "Lowercase"] and then["type"] == "Sequence":
            self.lower, self.split = True, WORD_SPLIT

    def of_library(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        # the library's model takes a pre-token as it is, without another split
        shown = piece.encode().decode("latin-1").translate(BYTE_LEVEL)
        ids = array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE_SIZE:
                self.clear()
            self[piece] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if self.split is None or UNUSUAL.search(text) or any(x in text for x in self.special):
            return self.of_library(text)
        pieces = self.split.findall(text.lower() if self.lower else text)
        return b"".join(map(self.__getitem__, pieces))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    return Encoder(path)
