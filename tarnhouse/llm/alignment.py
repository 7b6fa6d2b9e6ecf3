"""Operator 11, alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B). Tokens whose
byte ranges overlap belong together: every token points to its farthest-right overlapping token
of the other side, or to itself if none reaches farther, and doubling the pointers until they rest
leads every token of a group to the group's last token. All documents of a batch are grouped at
once, as one line of bytes.

The A and B tokens of a group are linked. The number of documents that hold a linked pair of ids
needs the whole corpus, so a scan task packs blocks of documents: the distinct pairs of the block,
each with its number of documents, and which documents hold which pairs how often. Pair counts are
summed by pair, which is combined on the map side, join the blocks' pairs, and meet the blocks'
documents again. A pair is one row of each block, so that a common pair is no hot key, and a
block's rows are bounded by its text. The blocks are stored once, with their numbers.

A null or empty text, and one whose joined token bytes are not a space and the text, has no tokens.
Special strings inside texts are plain text. There is one result row per input row, also for
repeated rows and null ids; other columns are not read; an empty table gives an empty result. A
text is one unit of work, however long.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.blocks import pack, unpack
from tarnhouse.llm.common import Stored, tokenizer_path
from tarnhouse.llm.tokens import byte_encoder

BLOCK_BYTES = 16 << 20
BLOCK_DOCS = 60_000
BATCH_BYTES = 1 << 20
PAIRS_AT_ONCE = 1 << 21  # links unfolded at once, to bound memory where groups are large
LARGE_GROUP = 1 << 16  # from this many links on, a group is linked by distinct ids

BLOCKS = pa.schema([
    ("block", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())),
    ("digests", pa.list_(pa.string())),
    ("sizes", pa.binary()),
    ("holds", pa.binary()),
    ("pairs", pa.list_(pa.int64())),
    ("docs", pa.list_(pa.int64())),
])
BLOCKS_DDL = (
    "block long, doc_ids array<long>, digests array<string>, sizes binary, holds binary, "
    "pairs array<long>, docs array<long>"
)
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
REPORT_DDL = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups_text_sha256 string"
TOKENS_DDL = "doc_id long, a_ids array<int>, a_groups array<int>, b_ids array<int>, b_groups array<int>"


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each A token and then each B token, the B token that ends its group.

    Both sides cover the same bytes; tokens are given by their ends, rising and not empty.
    """
    n_a, n_b = len(ends_a), len(ends_b)
    successor = np.empty(n_a + n_b, dtype=np.int64)
    successor[:n_a] = n_a + np.searchsorted(ends_b, ends_a)  # the one with the last byte reaches as far at least
    over = np.searchsorted(ends_a, ends_b)
    successor[n_a:] = np.where(ends_a[over] > ends_b, over, n_a + np.arange(n_b))
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor - n_a
        successor = doubled


class Aligned:
    """The tokens of some documents end to end, with the number of each token's group."""

    def __init__(self, a_ids, b_ids, ends_a, ends_b, doc_ends):
        self.a_ids, self.b_ids = a_ids, b_ids
        self.a_stops = np.searchsorted(ends_a, doc_ends, side="right")
        self.b_stops = np.searchsorted(ends_b, doc_ends, side="right")
        ends = terminals(ends_a, ends_b)
        last = ends[len(a_ids) :] == np.arange(len(b_ids))
        number = np.cumsum(last) - 1
        groups = number[ends]
        self.a_groups, self.b_groups = groups[: len(a_ids)], groups[len(a_ids) :]
        self.n_groups = int(last.sum())
        self.group_stops = np.searchsorted(ends_b[last], doc_ends, side="right")
        self.a_sizes = np.bincount(self.a_groups, minlength=self.n_groups)
        self.b_sizes = np.bincount(self.b_groups, minlength=self.n_groups)

    @staticmethod
    def per_doc(stops: np.ndarray) -> np.ndarray:
        return np.diff(stops, prepend=0)

    def group_docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.group_stops)), self.per_doc(self.group_stops))

    def links_per_doc(self) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(self.a_sizes * self.b_sizes)])
        return self.per_doc(sums[self.group_stops])

    def texts(self, tables: Tables) -> list[str]:
        """Each document's groups, as a1,a2|b1;a3|b2,b3."""
        a_before = np.cumsum(self.a_sizes)
        b_before = np.cumsum(self.b_sizes) - self.b_sizes
        parts = np.empty(len(self.a_ids) + len(self.b_ids), dtype=object)
        at_a = np.arange(len(self.a_ids)) + b_before[self.a_groups]
        at_b = np.arange(len(self.b_ids)) + a_before[self.b_groups]
        last_a = np.diff(self.a_groups, append=self.n_groups) > 0
        last_b = np.diff(self.b_groups, append=self.n_groups) > 0
        parts[at_a] = np.where(last_a, tables.bars[self.a_ids], tables.commas[self.a_ids])
        parts[at_b] = np.where(last_b, tables.semicolons[self.b_ids], tables.commas[self.b_ids])
        stops = (self.a_stops + self.b_stops).tolist()
        return ["".join(parts[a:b].tolist())[:-1] for a, b in zip([0, *stops], stops, strict=False)]

    def pairs(self, width: int, first_doc: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct document and pair of ids, as one number, and how often it is linked."""
        docs = self.group_docs() + first_doc
        links = self.a_sizes * self.b_sizes
        a_from = np.cumsum(self.a_sizes) - self.a_sizes
        b_from = np.cumsum(self.b_sizes) - self.b_sizes
        found = []
        for g in np.flatnonzero(links > LARGE_GROUP):
            a, n = np.unique(self.a_ids[a_from[g] : a_from[g] + self.a_sizes[g]], return_counts=True)
            b, m = np.unique(self.b_ids[b_from[g] : b_from[g] + self.b_sizes[g]], return_counts=True)
            found.append(((docs[g] << 32) + np.add.outer(a * width, b).ravel(), np.multiply.outer(n, m).ravel()))
        small = np.flatnonzero(links <= LARGE_GROUP)
        total = np.cumsum(links[small])
        for start in range(0, int(total[-1]) if len(total) else 0, PAIRS_AT_ONCE):
            own = small[np.searchsorted(total, start, side="right") : np.searchsorted(total, start + PAIRS_AT_ONCE, side="right")]
            n = links[own]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            per_a = np.repeat(self.b_sizes[own], n)
            a = self.a_ids[np.repeat(a_from[own], n) + inside // per_a]
            b = self.b_ids[np.repeat(b_from[own], n) + inside % per_a]
            found.append(np.unique((np.repeat(docs[own], n) << 32) + a * width + b, return_counts=True))
        return summed(found)


def summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their numbers."""
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(found) == 1:
        return found[0]
    keys, numbers = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(numbers, first)


class Tables:
    """Both vocabularies: encoders, the bytes of each token, and each id as text with a mark behind it."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor

        self.a = byte_encoder(a_path)
        self.b = SentencePieceProcessor(model_file=b_path)
        n_a, n_b = self.a.core.n_vocab, self.b.get_piece_size()
        self.width = n_b
        if n_a * n_b >= 1 << 32:
            raise ValueError("the vocabularies are too large for pairs of 32 bits")
        special = set(self.a.special.values())
        self.a_bytes = [b"" if k in special else self.a.core.decode_single_token_bytes(k) for k in range(n_a)]
        self.b_bytes = [self.piece_bytes(k) for k in range(n_b)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        ids = range(max(n_a, n_b))
        self.commas, self.bars, self.semicolons = (np.array([f"{k}{m}" for k in ids], dtype=object) for m in ",|;")

    def piece_bytes(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        if self.b.is_byte(k):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def align(self, texts: list[str]) -> Aligned:
        """The aligned tokens of the texts; one that the tokens do not spell has none."""
        a_ids, b_ids, lengths = [], [], []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            data = f" {text}".encode()
            a = b"".join(map(self.a.pieces.__getitem__, self.a.pretokens(f" {text}"))) if text else b""
            a = struct.unpack(f"<{len(a) // 4}I", a)
            spelt = text and all(
                data == b"".join(map(table.__getitem__, ids)) for table, ids in ((self.a_bytes, a), (self.b_bytes, b))
            )
            a_ids.append(np.array(a if spelt else (), dtype=np.int64))
            b_ids.append(np.array(b if spelt else (), dtype=np.int64))
            lengths.append(len(data) if spelt else 0)
        a_all, b_all = np.concatenate(a_ids), np.concatenate(b_ids)
        return Aligned(a_all, b_all, np.cumsum(self.a_sizes[a_all]), np.cumsum(self.b_sizes[b_all]), np.cumsum(lengths))


@lru_cache(maxsize=1)
def tables_of(a_path: str, b_path: str) -> Tables:
    """One pair of encoders for each Python worker."""
    return Tables(a_path, b_path)


def paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    return a_path or tokenizer_path("byte_bpe_50k.json"), b_path or tokenizer_path("piece_bpe_32k.model")


def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[str]]]:
    """The row number of the first document, the ids and the texts of some documents in turn."""
    for batch in batches:
        rids, ids, texts = (batch.column(c).to_pylist() for c in ("rid", "doc_id", "text"))
        start, size = 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= BATCH_BYTES or k + 1 == len(texts):
                yield rids[start], ids[start : k + 1], texts[start : k + 1]
                start, size = k + 1, 0


class Block:
    """Documents gathered for one row: their numbers, and which pairs they hold."""

    def __init__(self, name: int):
        self.name = name
        self.doc_ids, self.digests, self.sizes, self.keys, self.times = [], [], [], [], []
        self.bytes = 0

    def add(self, ids: list, texts: list[str], tables: Tables) -> None:
        aligned = tables.align(texts)
        keys, times = aligned.pairs(tables.width, len(self.doc_ids))
        self.keys.append(keys)
        self.times.append(times)
        self.doc_ids += ids
        self.digests += [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in aligned.texts(tables)]
        stops = (aligned.a_stops, aligned.b_stops, aligned.group_stops)
        self.sizes.append(np.stack([*map(aligned.per_doc, stops), aligned.links_per_doc()]))
        self.bytes += sum(map(len, texts))

    def row(self) -> pa.RecordBatch:
        """Pairs are numbered within the block, and documents hold these numbers."""
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        pairs, number, docs = np.unique(keys & 0xFFFFFFFF, return_inverse=True, return_counts=True)
        held = np.bincount(keys >> 32, minlength=len(self.doc_ids))
        sizes = np.concatenate(self.sizes, axis=1).astype(np.int64)
        values = [
            self.name, self.doc_ids, self.digests, pack(*sizes),
            pack(held.astype(np.int64), number.astype(np.uint32), times.astype(np.int64)), pairs, docs,
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, BLOCKS.types, strict=True)], schema=BLOCKS)


def texts_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text)


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, block = tables_of(a_path, b_path), None
        for name, ids, texts in text_batches(batches):
            block = block or Block(name)
            block.add(ids, texts, tables)
            if block.bytes >= BLOCK_BYTES or len(block.doc_ids) >= BLOCK_DOCS:
                yield block.row()
                block = None
        if block:
            yield block.row()

    return texts_of(docs).mapInArrow(gather, BLOCKS_DDL)


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """pair, the documents that hold it, and whether no pair of its A id is held by more."""
    rows = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select("p.pairs", "p.docs")
    counts = Stored(rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n")), "pair-counts").df
    a_id = F.floor(F.col("pair") / width).alias("a_id")
    most = counts.groupBy(a_id).agg(F.max("n").alias("most"))  # one row per id of the vocabulary at most
    joined = counts.withColumn("a_id", a_id).join(F.broadcast(most), "a_id")
    return joined.select("a_id", "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(block: pa.Table, counted: pa.Table) -> pa.Table:
    """The documents of one block, with the sums over their links."""
    row = block.slice(0, 1).to_pylist()[0] if block.num_rows else {"doc_ids": [], "digests": []}
    n_docs = len(row["doc_ids"])
    columns = [np.empty(0, np.int64)] * 6
    if n_docs:
        held, number, times = unpack(row["holds"], "i8", "u4", "i8")
        n, best = np.zeros((2, counted.num_rows), dtype=np.int64)
        place = counted["place"].to_numpy()
        n[place], best[place] = counted["n"].to_numpy(), counted["best"].to_numpy()
        stops = np.cumsum(held)
        sums = [np.concatenate([[0], np.cumsum(times * x[number])])[stops] for x in (best, n)]
        columns = [*unpack(row["sizes"], *["i8"] * 4), *map(Aligned.per_doc, sums)]
    arrays = [pa.array(row["doc_ids"], pa.int64()), *map(pa.array, columns), pa.array(row["digests"], pa.string())]
    return pa.table(arrays, names=["doc_id", *COUNTS, "groups_text_sha256"])


def tokens_in_groups(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, both sides' ids and the number of each token's group, counted from 0 in its document."""
    found = paths(a_path, b_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, texts in text_batches(batches):
            x = tables_of(*found).align(texts)
            rows = [pa.array(ids, pa.int64())]
            for tokens, groups, stops in ((x.a_ids, x.a_groups, x.a_stops), (x.b_ids, x.b_groups, x.b_stops)):
                first = np.repeat(x.group_stops - x.per_doc(x.group_stops), x.per_doc(stops))
                offsets = pa.array(np.concatenate([[0], stops]), pa.int32())
                rows += [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (tokens, groups - first)]
            yield pa.RecordBatch.from_arrays(rows, names=["doc_id", "a_ids", "a_groups", "b_ids", "b_groups"])

    return texts_of(docs).mapInArrow(work, TOKENS_DDL)


def align_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Per document its numbers and a digest of its groups; and a_id, b_id, n and best of each linked pair.

    ``n`` is how many documents hold the pair linked, ``best`` whether it is the most of its A id.
    """
    from sentencepiece import SentencePieceProcessor

    a_path, b_path = paths(a_path, b_path)
    width = SentencePieceProcessor(model_file=b_path).get_piece_size()
    blocks = Stored(aligned_blocks(docs, a_path, b_path), "aligned-blocks").df
    counts = Stored(pair_counts(blocks, width), "linked-pairs").df
    rows = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    counted = rows.join(counts, "pair").select(F.col("block").alias("of_block"), "place", "n", "best")
    whole = blocks.select("block", "doc_ids", "digests", "sizes", "holds").groupBy("block")
    report = whole.cogroup(counted.groupBy("of_block")).applyInArrow(with_counts, REPORT_DDL)
    pairs = counts.select("a_id", (F.col("pair") % width).alias("b_id"), "n", "best")
    return report, pairs


def alignment_report(docs: DataFrame, **parameters) -> DataFrame:
    report, _ = align_documents(docs, **parameters)
    return report.withColumnRenamed("groups_text_sha256", "groups_sha256")
