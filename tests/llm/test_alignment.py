"""Operator 11 against brute force over both libraries' tokens."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tarnhouse.llm import alignment
from tarnhouse.llm.alignment import align_documents, alignment_report, terminals, tokens_in_groups
from tarnhouse.llm.tokens import byte_letters

from .conftest import ROWS, SCHEMA, by_row, stored

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [" leading", "two  spaces\n\n\ttab", "▁ piece mark", "<s> </s> <unk> <0x41> <|endoftext|>", "\x00 null \x7f", "ﬁ ligature Å",
       "a" * 3000, "ぁ" * 700, "𝔘𝔫𝔦 🏳️‍🌈 ​", "\r\n mixed \r", " ", "\n", "don't we'll  I'M"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def groups_by_hand(text, libraries):
    """Each group as its A ids and B ids; none if the tokens do not spell the text."""
    a, b = libraries
    if not text:
        return []
    letters = byte_letters()
    ids = (a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text))
    pieces = ([bytes(letters[c] for c in a.id_to_token(k)) for k in ids[0]], [])
    for k in ids[1]:
        p = b.id_to_piece(k)
        pieces[1].append(bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode())
    if any(b"".join(p) != f" {text}".encode() for p in pieces):
        return []
    ends = []
    for p in pieces:
        at, own = 0, []
        for x in p:
            at += len(x)
            own.append(at)
        ends.append(own)
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out = []
    i = j = 0
    for c in cuts:
        group = ([], [])
        while i < len(ends[0]) and ends[0][i] <= c:
            group[0].append(ids[0][i])
            i += 1
        while j < len(ends[1]) and ends[1][j] <= c:
            group[1].append(ids[1][j])
            j += 1
        out.append(group)
    return out


def report_by_hand(rows, libraries):
    docs = [(d, groups_by_hand(t, libraries)) for d, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in docs]
    count = Counter(p for own in links for p in own)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (d, groups), own in zip(docs, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        best = sum(m for p, m in own.items() if count[p] == most[p[0]])
        out.append(repr((
            d, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()), best,
            sum(m * count[p] for p, m in own.items()), hashlib.sha256(text.encode()).hexdigest() if text else "",
        )))
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_report(spark, tmp_path, libraries, monkeypatch, small):
    """Also with blocks and batches of a few documents and links unfolded a few at a time."""
    rows = ROWS + [(1000 + k, t, None, None, None, None, None, None) for k, t in enumerate(ODD)]
    docs = stored(spark, tmp_path, rows, SCHEMA, "documents")
    if small:
        at_hand = [(r["doc_id"], r["text"]) for r in docs.collect()]
        blocks = []
        for name, value in (("BLOCK_BYTES", 4000), ("BATCH_BYTES", 900), ("PAIRS_AT_ONCE", 64), ("LARGE_GROUP", 3)):
            monkeypatch.setattr(alignment, name, value)
        block, tables = None, alignment.tables_of(*alignment.paths(None, None))
        for k, (d, t) in enumerate(at_hand):
            block = block or alignment.Block(k)
            block.add([d], [t or ""], tables)
            if block.bytes > 4000 or k + 1 == len(at_hand):
                blocks.append(block.row())
                block = None
        spark.createDataFrame(alignment.pa.Table.from_batches(blocks), alignment.BLOCKS_DDL).write.parquet(str(tmp_path / "blocks"))
        monkeypatch.setattr(alignment, "aligned_blocks", lambda *_: spark.read.parquet(str(tmp_path / "blocks")))
    got = alignment_report(docs)
    assert got.columns == COLUMNS
    assert by_row(got, *COLUMNS) == report_by_hand([r[:2] for r in rows], libraries)


def test_no_documents(no_docs):
    assert alignment_report(no_docs).collect() == []


def test_tokens_and_pairs(spark, tmp_path, libraries):
    rows = [(k, t, None, None, None, None, None, None) for k, t in enumerate([*ODD, "the cat", "the cat", None, ""])]
    docs = stored(spark, tmp_path, rows, SCHEMA, "documents")
    for r in tokens_in_groups(docs).collect():
        groups = groups_by_hand(dict((x[0], x[1]) for x in rows)[r["doc_id"]], libraries)
        assert r["a_ids"] == [x for a, _ in groups for x in a] and r["b_ids"] == [x for _, b in groups for x in b]
        assert r["a_groups"] == [k for k, (a, _) in enumerate(groups) for _ in a]
        assert r["b_groups"] == [k for k, (_, b) in enumerate(groups) for _ in b]
    _, pairs = align_documents(docs)
    count = Counter(p for _, t, *_ in rows for p in {(x, y) for a, b in groups_by_hand(t, libraries) for x in a for y in b})
    assert {(r["a_id"], r["b_id"]): r["n"] for r in pairs.collect()} == count


def test_terminals_of_a_long_chain():
    """Ends that meet only at the very end: one group, after doublings by the logarithm of its length."""
    n = 50_000
    a, b = np.arange(1, n + 1) * 2, np.append(np.arange(1, n) * 2 + 1, 2 * n)
    assert (terminals(a, b) == n - 1).all()
    assert (terminals(a, a) == np.tile(np.arange(n), 2)).all()
