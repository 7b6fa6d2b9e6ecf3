"""Operators 9 and 10 against brute force."""

from __future__ import annotations

import math
import random
import re
import time

import numpy as np
import pytest

from tarnhouse.llm.secrets import find_secrets, is_identifier, is_known, secret_report
from tarnhouse.llm.topk import top_k

from .conftest import ROWS, stored


def top_by_hand(rows, every, k):
    whole = [
        (v, [math.floor(1024 * x) for x in e])
        for v, e in rows
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, (q, a) in enumerate(whole):
        if q is None or q % every:
            continue
        found = [
            (-sum(x * y for x, y in zip(a, b, strict=True)), v is None, v or 0)
            for j, (v, b) in enumerate(whole)
            if j != i and len(a) == len(b)
        ]
        out += [(q, r, None if n else v, -s) for r, (s, n, v) in enumerate(sorted(found)[:k], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("n", [0, 3, 700])
def test_top_k(spark, tmp_path, n):
    rng = np.random.default_rng(5)
    rows = [(int(k), [float(x) for x in rng.normal(size=6).astype("f4")], 1) for k in range(n)]
    if n:
        rows += [(None, rows[0][1], 1), (900, None, 1), (901, [1.0, None], 1), (902, [float("nan")] * 6, 1)]
        rows += [(1000, [float("inf")] * 6, 1), (1100, [0.5, -2.0], 1), (1101, [3.0, 1.0], 1), rows[2], rows[0], rows[0]]
        rows += [(2000 + k, rows[1][1], 1) for k in range(60)]  # ties
    table = stored(spark, tmp_path, rows, "vec_id long, embedding array<float>, label int", "vectors")
    got = top_k(table, k=10, every=50, block_size=8, shard_blocks=4, part_queries=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == top_by_hand([r[:2] for r in rows], 50, 10)


BASE = [
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
    ("access", re.compile("AKIA[A-Z0-9]+")),
    ("hex", re.compile("[0-9a-f]+")),
]


def base_by_hand(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(found)]


def test_base_spans(docs):
    got = find_secrets(docs).collect()
    assert len(got) == len(ROWS)
    want = sorted((str(r[0]), base_by_hand(r[1])) for r in ROWS)
    assert want == sorted(
        (str(r["doc_id"]), [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["found"] if s["kind"] != "random"]) for r in got
    )
    assert any(spans for _, spans in want)


def test_secret_kinds(spark):
    texts = {
        1: "password=token: abcdefgh12",  # the first match is too short and takes the second's start
        2: "key Zq8vX2mP7tRk9LwB4nYc6HsD1fGj3K and some_long_identifier_name_2 someCamelCaseIdentifierName",
        3: "d41d8cd98f00b204e9800998ecf8427e 123e4567-e89b-12d3-a456-426614174000",
        4: "é🙂 Secret: 'abcdefgh-1' AKIAAKIAAKIAAKIA",
        5: "Rechtsschutzversicherungsgesellschaften entionoueauaichchelle",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secret_report(df).collect()}
    assert got == {1: "", 2: "random:4:34", 3: "hex:0:32", 4: "assign:3:22,access:24:40", 5: ""}
    counts = {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"]) for r in secret_report(df).collect()}
    assert counts[4] == (1, 1, 0) and counts[3] == (0, 0, 1)


def test_known_runs():
    assert all(map(is_known, ["d41d8cd98f00b204e9800998ecf8427e", "snake_case_name_with_words", "someCamelCaseNameHere1"]))
    assert not is_known("Zq8vX2mP7tRk9LwB4nYc6HsD1fGj3K")


def test_keys_joined_to_readable_text(spark):
    key = "Zq8vX2mP7tRk9LwB4nYc"
    texts = {
        1: f"/home/user/projects/settings/production/{key}",
        2: f"access_key_production_{key}",
        3: f"{key}_token=abcdefgh1234",  # the pattern is cut out, not the run dropped
        4: key[:16],
        5: f"/home/user/{key}/settings/{key[::-1]}",
        6: "/orders/2024-01-05-12-30-45/4111-1111-1111-1111 call 0049-171-1234567-89",
        7: "123e4567-e89b-12d3-a456-426614174000 /some/long/path/to_some_name-2/readme",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: [texts[r["doc_id"]][x["start"] : x["end"]] for x in r["found"] if x["kind"] == "random"] for r in find_secrets(df).collect()}
    assert all(any(key in x for x in got[k]) for k in (1, 2, 3))
    assert got[4] == [key[:16]]
    assert all(any(k in x for x in got[5]) for k in (key, key[::-1]))
    assert got[7] == []
    assert not any(len(x) < 20 for x in got[6])  # short numbers


def test_no_documents(no_docs):
    assert secret_report(no_docs).collect() == []


# As first written, which tries every way to cut a run of letters: for short runs only.
SLOW_IDENTIFIER = re.compile(
    r"[_\-/+=]*(?:(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[a-zA-Z]|[0-9]{1,4})[_\-/+=]+)*(?:[A-Z]?[a-z]{3,}|[A-Z]{3,})+[0-9]{0,4}[_\-/+=]*"
)


def test_identifiers_are_those_of_the_slow_pattern():
    rng = random.Random(4)
    seen = set()
    for _ in range(30_000):
        run = "".join(rng.choice(["a", "b", "C", "D", "abc", "XYZ", "Word", "7", "12345", "_", "-", "/"]) for _ in range(rng.randint(1, 7)))
        seen.add(is_identifier(run))
        assert is_identifier(run) == bool(SLOW_IDENTIFIER.fullmatch(run)), run
    assert seen == {True, False}


@pytest.mark.parametrize("n", [10, 60, 1000, 100_000])
def test_long_runs_take_no_longer_than_their_length(n):
    begun = time.perf_counter()
    for letters in ("a", "A", "aB", "abC", "Abc", "ab_", "abc-", "a1", "7", "_", "+/", "abcdef0123456789"):
        run = (letters * n)[:n]
        for tail in ("", "12345", "_12345", "!", "A1", "____"):
            is_known(run + tail)
    assert time.perf_counter() - begun < 6


@pytest.mark.parametrize("letters", ["a", "Ab", "a_", "0f", "zQ7"])
def test_a_document_of_one_long_run(spark, letters):
    begun = time.perf_counter()
    text = (letters * 100_000)[:100_000] + "12345"
    rows = spark.createDataFrame([(1, text), (2, f"x {text} y")], "doc_id long, text string")
    assert len(find_secrets(rows).collect()) == 2
    assert time.perf_counter() - begun < 30
