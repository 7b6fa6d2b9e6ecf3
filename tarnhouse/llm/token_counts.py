"""Operator 4, token counts without materialised ids.

Each document's pre-tokens are counted where it lies. A distinct pre-token is encoded once, its
number of pieces joins the documents' pre-token frequencies, and the products are summed by
document. Frequencies travel packed by blocks of documents and buckets of pre-tokens.

A null text is empty and has no tokens. There is one result row per input row, also for repeated
rows and null ids; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.blocks import BLOCK_CHARS, BLOCK_DOCS, GROUP_BITS, by_bucket, pack, unpack
from tarnhouse.llm.common import shuffle_width, tokenizer_path
from tarnhouse.llm.tokens import LATIN, SPACE, byte_letters, latin_class

PACKED = "bucket int, block long, kind int, data binary"
HEADER, POSTINGS, SUMS = 0, 1, 2


class WordCounter:
    """Pre-tokens of a text and their numbers of pieces, as the tokenizers library gives them.

    The vocabulary file lower-cases, drops white space and marks word ends.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        le, nu = latin_class("L"), latin_class("N")
        self.fast = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{le}]+|[{nu}]|[^{SPACE}{le}{nu}]+")
        self.other = re.compile(f"[^\\x00-{chr(LATIN - 1)}]")
        self.letters = {b: c for c, b in byte_letters().items()}

    def pretokens(self, text: str) -> list[str]:
        """Normalised pre-tokens; special strings stay whole."""
        if any(s in text for s in self.special):
            out = []
            for s in self.splitter.split(text):
                out.extend([s] if s in self.special else self.plain(s))
            return out
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        if not self.other.search(text):
            low = text.lower()
            if not self.other.search(low):
                return self.fast.findall(low)
        normal = self.library.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def pieces(self, pretoken: str) -> int:
        if pretoken in self.special:
            return 1
        return len(self.library.model.tokenize("".join(map(self.letters.__getitem__, pretoken.encode()))))


@lru_cache(maxsize=2)
def word_counter(path: str) -> WordCounter:
    return WordCounter(path)


class Block:
    """Documents gathered in one task."""

    def __init__(self, name: int):
        self.name, self.chars = name, 0
        self.ids: list[str | None] = []
        self.sizes: list[int] = []
        self.vocabulary: dict[str, int] = defaultdict(count().__next__)
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc: str | None, text: str, pretokens: list[str]) -> None:
        numbers = np.fromiter(map(self.vocabulary.__getitem__, pretokens), dtype=np.int32, count=len(pretokens))
        terms, counts = np.unique(numbers, return_counts=True)
        self.ids.append(doc)
        self.sizes.append(len(text.encode()))
        self.terms.append(terms)
        self.counts.append(counts)
        self.chars += len(text)

    def rows(self, n_buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
        ids = "\n".join("" if d is None else d for d in self.ids).encode()
        yield self.name % n_buckets, self.name, HEADER, pack(ids, np.array(self.sizes, dtype=np.int64))
        if not self.vocabulary:
            return
        words = [w.encode() for w in self.vocabulary]
        buckets = np.fromiter((zlib.crc32(w) % n_buckets for w in words), dtype=np.int32, count=len(words))
        docs = np.repeat(np.arange(len(self.ids), dtype=np.uint16), [len(t) for t in self.terms])
        terms, counts = np.concatenate(self.terms), np.concatenate(self.counts).astype(np.uint32)
        for bucket, own, per_term, d, c in by_bucket(buckets, terms, docs, counts):
            text = b"\n".join([words[k] for k in own])
            yield bucket, self.name, POSTINGS, pack(text, per_term.astype(np.uint32), d, c)


def frame(rows: list[tuple[int, int, int, bytes]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bucket", "block", "kind", "data"])


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row."""
    path = vocabulary or tokenizer_path("word_bpe_49k.json")
    n_buckets = 16 * shuffle_width(docs.sparkSession)

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter, block = word_counter(path), None
        for batch in batches:
            for rid, doc, text in zip(batch["rid"], batch["doc_id"], batch["text"], strict=True):
                block = block or Block(rid)
                block.add(doc, text, counter.pretokens(text))
                if block.chars >= BLOCK_CHARS or len(block.ids) >= BLOCK_DOCS:
                    yield frame(list(block.rows(n_buckets)))
                    block = None
        if block:
            yield frame(list(block.rows(n_buckets)))

    def counted(group: pd.DataFrame) -> pd.DataFrame:
        counter, known, out = word_counter(path), {}, []
        for bucket, block, kind, data in zip(group["bucket"], group["block"], group["kind"], group["data"], strict=True):
            if kind == HEADER:
                out.append((bucket, block, kind, data))
                continue
            text, per_term, d, c = unpack(data, "", "u4", "u2", "u4")
            pieces = []
            for word in text.decode().split("\n"):
                n = known.get(word)
                if n is None:
                    n = known[word] = counter.pieces(word)
                pieces.append(n)
            sums = np.bincount(d, weights=np.repeat(np.array(pieces), per_term) * c)
            own = np.flatnonzero(sums)
            out.append((bucket, block, SUMS, pack(own.astype(np.uint16), sums[own].astype(np.uint32))))
        return frame(out)

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        header = group["data"][group["kind"] == HEADER].iloc[0]
        ids, sizes = unpack(header, "", "i8")
        total = np.zeros(len(sizes), dtype=np.int64)
        for data in group["data"][group["kind"] == SUMS]:
            own, sums = unpack(data, "u2", "u4")
            total[own] += sums
        return pd.DataFrame({"doc_id": ids.decode().split("\n"), "n_bytes": sizes, "n_tokens": total})

    keyed = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("string").alias("doc_id"),  # pandas has no null in whole numbers
        F.coalesce("text", F.lit("")).alias("text"),
    )
    packed = keyed.mapInPandas(frequencies, PACKED)
    sums = packed.groupBy("bucket", F.shiftright("block", GROUP_BITS)).applyInPandas(counted, PACKED)
    rows = sums.groupBy("block").applyInPandas(summed, "doc_id string, n_bytes long, n_tokens long")
    return rows.withColumn("doc_id", F.nullif("doc_id", F.lit("")).cast("long"))


def token_report(docs: DataFrame, limit: int = 2048, **parameters) -> DataFrame:
    """Token counts, and whether a document is over the limit."""
    return token_counts(docs, **parameters).withColumn("over_limit", F.col("n_tokens") > limit)
