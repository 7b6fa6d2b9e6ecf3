"""Operators 4, 6 and 7 against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tarnhouse.llm.chunks import ChunkEncoder, encoding_report
from tarnhouse.llm.packing import best_fit_decreasing, pack_tokens, packing_report
from tarnhouse.llm.token_counts import WordCounter, token_report
from tarnhouse.llm.tokens import ByteEncoder

from .conftest import ROWS, as_text, by_row


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "'r", "'RE", "'", "e", "ab", "É", "ñ", "日本", "Σ", "İ", "Ⱦ", "1", "!!", "<|endoftext|>", "🙂", "\x85", "the "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 90))) for _ in range(n)]


def test_token_counts(docs, word_library):
    want = [(d, len((t or "").encode()), n := len(ids(word_library, t)), n > 2048) for d, t, *_ in ROWS]
    assert by_row(token_report(docs), "doc_id", "n_bytes", "n_tokens", "over_limit") == as_text(want)


def test_token_counts_of_odd_texts(word_library):
    counter = WordCounter(public_tokenizers.path("word_bpe_49k.json"))
    for text in odd_texts(1, 600):
        assert sum(map(counter.pieces, counter.pretokens(text))) == len(ids(word_library, text)), text


def test_encoding(docs, byte_library):
    want = []
    for d, t, *_ in ROWS:
        own = ids(byte_library, t)
        text = byte_library.decode(own, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        want.append((d, len(own), digest, hashlib.sha256(text.encode()).hexdigest()))
    assert by_row(encoding_report(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == as_text(want)


@pytest.mark.parametrize(("bits", "longest", "window"), [(3, 40, 1), (4, 100, 4), (6, 500, 24)])
def test_joins_of_short_chunks_are_repaired(byte_library, bits, longest, window):
    encoder = ByteEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    chunked = ChunkEncoder(encoder, bits, longest, 100, window)
    for text in odd_texts(bits, 400):
        own = np.frombuffer(chunked.encode(text), "<u4").tolist()
        assert own == ids(byte_library, text), text
        assert encoder.decode(own) == byte_library.decode(own, skip_special_tokens=False)


def test_shared_chunks_are_encoded_once():
    encoder = ByteEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    chunked = ChunkEncoder(encoder, 6, 4096, 10_000)
    passage = " ".join(f"word{k}" for k in range(2000))
    chunked.encode("first start " + passage)
    before = chunked.misses
    chunked.encode("another and longer start " + passage)
    assert chunked.misses - before < 5 < chunked.hits


def test_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(50):
        size = rng.randint(1, 40)
        lengths = np.array([rng.randint(1, size) for _ in range(rng.randint(0, 60))])
        rows = best_fit_decreasing(lengths, size)
        assert sorted(k for r in rows for k in r) == list(range(len(lengths)))
        # The same, by looking at every row.
        free: list[int] = []
        for n in sorted(lengths.tolist(), reverse=True):
            fits = [f for f in free if f >= n]
            if fits:
                free[free.index(min(fits))] -= n
            else:
                free.append(size - n)
        assert sorted(size - sum(lengths[k] for k in r) for r in rows) == sorted(free)


def test_packed_rows_hold_every_token(docs, byte_library):
    pieces = []
    for r in pack_tokens(docs, row_tokens=64, block_tokens=2000).collect():
        row, positions = (np.frombuffer(r[c], "<u4") for c in ("ids", "position_ids"))
        assert len(row) == 64 and r["cu_seqlens"][-1] == r["n_tokens"] == len(positions)
        assert set(row[r["n_tokens"] :].tolist()) <= {50256}
        for doc, at, a, b in zip(r["doc_ids"], r["doc_offsets"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
            pieces.append((str(doc), at, row[a:b].tolist()))
    want = []
    for d, t, *_ in ROWS:
        own = ids(byte_library, t)
        want += [(str(d), k, own[k : k + 64]) for k in range(0, len(own), 64)]
    assert sorted(pieces) == sorted(want)


def test_empty_tables(no_docs):
    for report in (token_report, encoding_report, packing_report):
        assert report(no_docs).collect() == []
