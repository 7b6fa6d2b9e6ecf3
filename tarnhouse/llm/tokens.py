"""Byte-level BPE of one text: pre-tokens by pattern, each distinct one encoded once per task."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

# The pre-token pattern of the byte-level vocabulary. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Below this code point letters, numbers and spaces are listed for the fast pattern;
# texts with other characters are split by the tokenizers library itself.
LATIN = 0x250
SPACE = "\\t-\\r \\x85\\xa0"


def latin_class(kind: str) -> str:
    """The letters (L) or numbers (N) of the Latin blocks, as the inside of a character class."""
    return "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c))[0] == kind)


def byte_letters() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class PieceCache(dict):
    """Pre-token to its ids, as little-endian 32-bit numbers; emptied when it grows too large."""

    def __init__(self, encode, limit: int):
        self.encode, self.limit = encode, limit

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        got = self[piece] = array("I", self.encode(piece.encode())).tobytes()
        return got


class ByteEncoder:
    """Encodes as the tokenizers library does with the given byte-level vocabulary file."""

    def __init__(self, path: str, cache_pieces: int = 400_000):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.core = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.pieces = PieceCache(self.core._encode_single_piece, cache_pieces)
        le, nu = latin_class("L"), latin_class("N")
        self.fast = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{le}]+| ?[{nu}]+| ?[^{SPACE}{le}{nu}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        )
        self.other = re.compile(f"[^\\x00-{chr(LATIN - 1)}]")
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def segments(self, text: str) -> list[str]:
        """The text cut at special strings, which stay as parts of their own."""
        if self.splitter and any(s in text for s in self.special):
            return [s for s in self.splitter.split(text) if s]
        return [text] if text else []

    def pretokens(self, text: str) -> list[str]:
        if self.other.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self.fast.findall(text)

    def encode(self, text: str) -> bytes:
        parts = []
        for s in self.segments(text):
            if s in self.special:
                parts.append(array("I", [self.special[s]]).tobytes())
            else:
                parts.extend(map(self.pieces.__getitem__, self.pretokens(s)))
        return b"".join(parts)

    def decode(self, ids: list[int]) -> str:
        return self.core.decode(ids)


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """One encoder for each Python worker."""
    return ByteEncoder(path)
