"""Operator 6, BPE encoding and decoding with content-defined chunks.

A rolling hash over the bytes cuts each text into chunks whose borders depend on nearby bytes
only, so that documents which share a passage share its inner chunks. Each distinct chunk is
encoded once in a task and its ids are taken again wherever it returns. A border may fall inside
a pre-token, so every join is repaired: the text is encoded anew from a sure border before the
join until a pre-token border of the new encoding is also one of the right chunk's; from there
on both agree to the end. If they do not agree inside the window, the window grows.

The store of chunks is bounded and belongs to a task: shipping chunks to one place and their ids
back to every document would move more bytes than the texts have.

A null text is empty: no ids, and an empty decoded text. Repeated rows give repeated results,
other columns are not read, and an empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.common import tokenizer_path
from tarnhouse.llm.tokens import ByteEncoder, byte_encoder

WINDOW = 32  # bytes that decide on a border
SURE = 4  # a pre-token that ends so many characters before the end of a text is not changed by what follows


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, a hash of the WINDOW bytes that end there (fewer at the start)."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    step, factor = 1, np.uint64(0xD1B54A32D192ED03)
    while step < WINDOW:
        h[step:] += h[:-step] * factor
        factor = np.uint64(int(factor) ** 2 % (1 << 64))
        step *= 2
    return h


def chunk_ends(data: bytes, bits: int, longest: int) -> list[int]:
    """Where chunks end, at character borders: 2^bits bytes on average and few above ``longest``."""
    size = len(data)
    if size <= WINDOW:
        return [size]
    codes = np.frombuffer(data, dtype=np.uint8)
    h = rolling_hash(codes)
    ends, last = [], 0
    marks = np.flatnonzero((h >> np.uint64(40)) & np.uint64((1 << bits) - 1) == 0) + 1
    for mark in [*marks.tolist(), size]:
        while mark - last > longest:
            cut = last + longest
            while codes[cut] & 0xC0 == 0x80:
                cut -= 1
            ends.append(cut)
            last = cut
        while mark < size and codes[mark] & 0xC0 == 0x80:
            mark += 1
        if mark - last >= WINDOW or mark == size:
            if mark > last:
                ends.append(mark)
            last = mark
    return ends


class Piece:
    """An encoded stretch of text: its ids and where its pre-tokens start."""

    __slots__ = ("ids", "length", "starts", "offsets")

    def __init__(self, text: str, encoder: ByteEncoder):
        tokens = encoder.pretokens(text)
        codes = list(map(encoder.pieces.__getitem__, tokens))
        self.length = len(text)
        self.ids = b"".join(codes)
        # One more start than pre-tokens: the end.
        self.starts = array("I", accumulate(map(len, tokens), initial=0))
        self.offsets = array("I", accumulate(map(len, codes), initial=0))

    def sure_start(self) -> int:
        """Number of the last pre-token start that no following text can move."""
        return max(bisect_right(self.starts, self.length - SURE) - 2, 0)


class ChunkEncoder:
    def __init__(self, encoder: ByteEncoder, bits: int, longest: int, store_chunks: int, window: int = 24):
        self.encoder, self.bits, self.longest = encoder, bits, longest
        self.store_chunks, self.window = store_chunks, window
        self.store: dict[str, Piece] = {}
        self.hits = self.misses = 0

    def piece(self, text: str) -> Piece:
        got = self.store.get(text)
        if got is None:
            self.misses += 1
            if len(self.store) >= self.store_chunks:
                self.store.clear()
            got = self.store[text] = Piece(text, self.encoder)
        else:
            self.hits += 1
        return got

    def segment(self, text: str) -> bytes:
        """Ids of a text without special strings."""
        data = text.encode()
        ends = chunk_ends(data, self.bits, self.longest)
        if len(ends) == 1:
            return self.piece(text).ids
        chunks, last = [], 0
        for end in ends:
            chunks.append(data[last:end].decode())
            last = end
        out = []
        # The stretch in hand: its piece, its text, and the number of its first pre-token that counts.
        left, left_text, first = self.piece(chunks[0]), chunks[0], 0
        for chunk in chunks[1:]:
            right = self.piece(chunk)
            sure = left.sure_start()
            joined = self.join(left_text[left.starts[sure] :], chunk, right) if sure >= first else None
            if joined is None:
                # No sure border, or no agreement inside the chunk: both become one stretch.
                left_text = left_text[left.starts[first] :] + chunk
                left, first = Piece(left_text, self.encoder), 0
                continue
            repaired, at = joined
            out.append(left.ids[left.offsets[first] : left.offsets[sure]])
            out.append(repaired)
            left, left_text, first = right, chunk, at
        out.append(left.ids[left.offsets[first] :])
        return b"".join(out)

    def join(self, tail: str, chunk: str, right: Piece) -> tuple[bytes, int] | None:
        """Ids from the start of ``tail`` to a common border in the chunk, and that border's number."""
        window = self.window
        while True:
            fresh = Piece(tail + chunk[:window], self.encoder)
            last = fresh.sure_start() if window < len(chunk) else len(fresh.starts) - 2
            for k in range(bisect_left(fresh.starts, len(tail)), last + 1):
                start = fresh.starts[k] - len(tail)
                at = bisect_left(right.starts, start, 0, len(right.starts) - 1)
                if right.starts[at] == start and at < len(right.starts) - 1:
                    return fresh.ids[: fresh.offsets[k]], at
            if window >= len(chunk):
                return None
            window *= 2

    def encode(self, text: str) -> bytes:
        special = self.encoder.special
        return b"".join(
            np.array([special[s]], dtype="<u4").tobytes() if s in special else self.segment(s)
            for s in self.encoder.segments(text)
        )


def encode_text(
    text: Column,
    vocabulary: str | None = None,
    chunk_bits: int = 10,
    longest_chunk: int = 4096,
    store_chunks: int = 40_000,
) -> Column:
    """Token ids of a text, as little-endian unsigned 32-bit numbers, and the text they decode to."""
    path = vocabulary or tokenizer_path("byte_bpe_50k.json")

    @F.pandas_udf("struct<ids:binary,decoded:string>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = byte_encoder(path)
        chunked = ChunkEncoder(encoder, chunk_bits, longest_chunk, store_chunks)
        for texts in batches:
            ids = [chunked.encode(t) for t in texts]
            decoded = [encoder.decode(np.frombuffer(i, dtype="<u4").tolist()) for i in ids]
            yield pd.DataFrame({"ids": ids, "decoded": decoded})

    return encode(F.coalesce(text, F.lit("")))


def encode_documents(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, ids and decoded text of each document."""
    got = docs.select("doc_id", encode_text(F.col("text"), **parameters).alias("got"))
    return got.select("doc_id", "got.ids", "got.decoded")


def encoding_report(docs: DataFrame, **parameters) -> DataFrame:
    got = encode_documents(docs, **parameters)
    return got.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
