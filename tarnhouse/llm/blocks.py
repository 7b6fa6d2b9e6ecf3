"""Term frequencies of documents, packed by blocks of documents and buckets of terms.

A table with one row per document and term would be larger than the texts. Here a task gathers
up to ``BLOCK_CHARS`` of text as a block, sorts the block's terms by bucket, and emits one
compressed row per block and bucket. Joins with per-term values then move packed rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import zstandard

BLOCK_CHARS = 32 << 20
BLOCK_DOCS = 60_000  # places in a block are 16-bit numbers

# Blocks are named by the row number of their first document, whose upper bits are the scan
# task. Terms meet within as many scan tasks as this many low bits count, so that the rows of
# a very common term stay bounded however many blocks there are.
GROUP_BITS = 33 + 10


def pack(*arrays: np.ndarray | bytes, level: int = 1) -> bytes:
    """Arrays as one compressed value; sizes first."""
    parts = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    head = struct.pack(f"<{len(parts)}Q", *map(len, parts))
    return zstandard.ZstdCompressor(level=level).compress(head + b"".join(parts))


def unpack(data: bytes, *kinds: str) -> list[np.ndarray | bytes]:
    """What ``pack`` was given; "" as kind leaves bytes."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = struct.unpack_from(f"<{len(kinds)}Q", raw)
    out, at = [], 8 * len(kinds)
    for kind, size in zip(kinds, sizes, strict=True):
        part = raw[at : at + size]
        out.append(np.frombuffer(part, dtype=kind) if kind else part)
        at += size
    return out


def by_bucket(
    buckets: np.ndarray, terms: np.ndarray, docs: np.ndarray, counts: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Postings by bucket: its terms, postings of each, and the documents and counts of those.

    ``buckets`` has the bucket of each term number; the other three are parallel, and documents
    ascend.
    """
    order = np.argsort(buckets, kind="stable")
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    ranked = rank[terms]
    sort = np.argsort(ranked, kind="stable")
    per_term = np.bincount(ranked, minlength=len(order))
    ends = np.concatenate([[0], np.cumsum(per_term)])
    sorted_buckets = buckets[order]
    firsts = np.flatnonzero(np.concatenate([[True], sorted_buckets[1:] != sorted_buckets[:-1]]))
    for a, b in zip(firsts, [*firsts[1:], len(order)], strict=True):
        own = sort[ends[a] : ends[b]]
        yield int(sorted_buckets[a]), order[a:b], per_term[a:b], docs[own], counts[own]
