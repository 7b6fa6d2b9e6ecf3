"""Operator 7, token ids in fixed-length rows, packed best-fit decreasing.

Each document is encoded once where it lies. Documents of up to ``block_tokens`` tokens are
packed together in one block: pieces go longest first into the row with the least free space
that still fits, found by a search tree over the rows by free capacity. A document longer than
a row is cut into full rows and a rest, so no token is lost. Blocks are bounded and need no
shuffle, and the same rows come out if a task is run again.

A null or empty text has no tokens and gives no piece. Repeated rows are packed as often as they
occur; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.common import tokenizer_path
from tarnhouse.llm.tokens import byte_encoder

PACKED = (
    "block long, row int, n_tokens int, ids binary, doc_ids array<bigint>, doc_offsets array<bigint>, "
    "cu_seqlens array<int>, position_ids binary"
)


class CapacityTree:
    """Segment tree over free capacities 0..size: how many open rows have each one.

    ``least(n)`` gives the smallest capacity of at least n that an open row has.
    """

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, change: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += change
            node >>= 1

    def least(self, n: int) -> int | None:
        node = self.leaves + n
        if self.count[node]:
            return n
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Rows of piece numbers; every piece is between 1 and ``size`` long."""
    tree, open_rows, rows = CapacityTree(size), {}, []
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        capacity = tree.least(n)
        if capacity is None:
            row, capacity = len(rows), size
            rows.append([])
        else:
            row = open_rows[capacity].pop()
            tree.add(capacity, -1)
        rows[row].append(k)
        if capacity > n:
            open_rows.setdefault(capacity - n, []).append(row)
            tree.add(capacity - n, 1)
    return rows


def packed_rows(
    block: int, docs: list[tuple[int | None, np.ndarray]], size: int, pad: int
) -> Iterator[dict]:
    pieces = [
        (doc, start, ids[start : start + size]) for doc, ids in docs for start in range(0, len(ids), size)
    ]
    lengths = np.array([len(p[2]) for p in pieces], dtype=np.int64)
    for k, row in enumerate(best_fit_decreasing(lengths, size)):
        own = [pieces[i] for i in row]
        ends = np.cumsum([len(p[2]) for p in own])
        positions = np.concatenate([np.arange(len(p[2]), dtype="<u4") for p in own])
        matrix_row = np.full(size, pad, dtype="<u4")
        matrix_row[: ends[-1]] = np.concatenate([p[2] for p in own])
        yield {
            "block": block,
            "row": k,
            "n_tokens": int(ends[-1]),
            "ids": matrix_row.tobytes(),
            "doc_ids": [p[0] for p in own],
            "doc_offsets": [p[1] for p in own],
            "cu_seqlens": [0, *ends.tolist()],
            "position_ids": positions.tobytes(),
        }


def pack_tokens(
    docs: DataFrame,
    row_tokens: int = 2048,
    block_tokens: int = 4_000_000,
    pad_id: int = 50256,
    vocabulary: str | None = None,
) -> DataFrame:
    """Rows of an id matrix of width ``row_tokens`` with the places of their documents.

    ``ids`` holds the whole matrix row, filled up with ``pad_id`` behind ``n_tokens``, and
    ``position_ids`` the positions, which start at 0 in each segment; both are little-endian
    unsigned 32-bit numbers. ``cu_seqlens`` are the segment ends with a leading 0, and
    ``doc_offsets`` is where each segment begins within its document, so that cut documents can
    be put together again. ``block`` and ``row`` name the row.
    """
    path = vocabulary or tokenizer_path("byte_bpe_50k.json")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = byte_encoder(path)
        block, docs, tokens = None, [], 0
        for batch in batches:
            for rid, doc, text in zip(batch["rid"], batch["doc_id"], batch["text"], strict=True):
                ids = np.frombuffer(encoder.encode(text), dtype="<u4")
                if docs and tokens + len(ids) > block_tokens:
                    yield pd.DataFrame(list(packed_rows(block, docs, row_tokens, pad_id)))
                    docs, tokens = [], 0
                if len(ids):
                    block = rid if not docs else block
                    docs.append((None if doc is None else int(doc), ids))
                    tokens += len(ids)
        if docs:
            yield pd.DataFrame(list(packed_rows(block, docs, row_tokens, pad_id)))

    keyed = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("string").alias("doc_id"),  # pandas has no null in whole numbers
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return keyed.mapInPandas(pack, PACKED)


def packing_report(docs: DataFrame, **parameters) -> DataFrame:
    """Each row's place, documents and digests of its arrays."""
    return pack_tokens(docs, **parameters).select(
        "block", "row", "n_tokens", "doc_ids", "doc_offsets", "cu_seqlens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("position_ids", 256).alias("positions_sha256"),
    )


def write_packed(docs: DataFrame, path: str, **parameters) -> None:
    """The packed rows as Parquet files."""
    pack_tokens(docs, **parameters).write.parquet(path)
