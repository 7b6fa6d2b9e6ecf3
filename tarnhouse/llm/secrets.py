"""Operator 10, secret scan: fixed patterns, and random strings found by their token efficiency.

Natural text needs few tokens: a BPE vocabulary covers it with long pieces. A random key falls
apart into pieces of one or two characters. Runs of key characters with a low number of
characters per token are therefore reported, except known digests and identifiers. Fixed patterns
are cut out of a run. If what is left is not random as a whole, its parts between / _ - = are
weighed, so that a key behind a path or a name is found.

A null text is empty and has no spans. Repeated rows give repeated results, other columns are
not read, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.common import tokenizer_path
from tarnhouse.llm.tokens import byte_encoder

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
SPANS = "array<struct<kind:string,start:int,end:int>>"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

# Lengths of common digests in hexadecimal digits: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
PART = re.compile(r"[A-Za-z0-9+]+")  # between / _ - =
SHORT = 3
LETTER = re.compile(r"[A-Za-z]")
HEXADECIMAL = re.compile(r"[0-9a-fA-F]+")
# Words joined by marks or capitals, with short numbers: some_name2, someLongName, path/to/name.
# Runs of letters are taken whole (possessive), so that a test takes one pass however long they are.
MARKS = re.compile(r"[_\-/+=]+")
WORD = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}|[a-zA-Z]|[0-9]{1,4}")
LAST_WORD = re.compile(r"(?=[A-Za-z])(?:(?:[A-Z]{3,}+|[A-Z])?[a-z]{3,}+)*+(?:[A-Z]{3,}+)?[0-9]{0,4}")


def is_identifier(run: str) -> bool:
    """Words between marks; the last one may be several joined by capitals, and a short number."""
    *words, last = MARKS.split(run.strip("_-/+="))
    return bool(LAST_WORD.fullmatch(last)) and all(map(WORD.fullmatch, words))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    # A greedy run of 32 and more is a whole run, so shorter ones need not be matched and dropped.
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def is_known(run: str) -> bool:
    """A digest, a UUID or an identifier: not reported as random."""
    if HEXADECIMAL.fullmatch(run) and len(run) in DIGEST_LENGTHS:
        return True
    return bool(UUID.fullmatch(run)) or is_identifier(run)


def without(start: int, end: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of a range without the taken ones, which are sorted by start."""
    for s, e in taken:
        if e <= start or s >= end:
            continue
        if s > start:
            yield start, s
        start = max(start, e)
    if start < end:
        yield start, end


def random_parts(piece: str, is_random, min_length: int) -> Iterator[tuple[int, int]]:
    """Neighbouring random parts between marks, as one; parts of up to three characters join others only."""
    group: list[tuple[int, int]] = []
    for m in [*PART.finditer(piece), None]:
        if m and (len(m[0]) <= SHORT or is_random(m[0])):
            group.append(m.span())
            continue
        long = [span for span in group if span[1] - span[0] > SHORT]
        group = []
        if long and long[-1][1] - long[0][0] >= min_length:
            start, end = long[0][0], long[-1][1]
            # Numbers joined by marks are dates, phone or account numbers.
            if LETTER.search(piece, start, end) and not is_known(piece[start:end]):
                yield start, end


def random_spans(
    text: str, runs: re.Pattern, count, max_ratio: float, taken: list[tuple[str, int, int]], min_length: int = 16, long: int = 20
):
    def is_random(run: str) -> bool:
        return len(run) < max_ratio * count(run)

    found = []
    cuts = sorted((s, e) for _, s, e in taken)
    for m in runs.finditer(text):
        if is_known(m[0]):
            continue
        for start, end in without(m.start(), m.end(), cuts):
            piece = text[start:end]
            if len(piece) < min_length or is_known(piece):
                continue
            if is_random(piece) and (len(piece) >= long or LETTER.search(piece)):
                found.append(("random", start, end))
            else:
                found += [("random", start + a, start + b) for a, b in random_parts(piece, is_random, min_length)]
    return found


def secret_spans(
    text: Column, vocabulary: str | None = None, min_length: int = 16, max_ratio: float = 1.9
) -> Column:
    """Spans of secrets in a text column, in code points, by start and then kind.

    ``vocabulary`` is a byte-level vocabulary file, ``min_length`` the shortest run or part weighed
    (below 20 characters only with a letter), and runs with fewer than ``max_ratio`` characters per token are random.
    """
    path = vocabulary or tokenizer_path("byte_bpe_50k.json")

    @F.pandas_udf(SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        core = byte_encoder(path).core
        runs = re.compile(rf"[A-Za-z0-9+/_=-]{{{min_length},}}")
        for texts in batches:
            rows = []
            for t in texts:
                base = base_spans(t)
                spans = base + random_spans(t, runs, lambda r: len(core.encode_ordinary(r)), max_ratio, base, min_length)
                spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                rows.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pd.Series(rows, dtype=object)

    return scan(F.coalesce(text, F.lit("")))


def find_secrets(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id and the array of spans of each document."""
    return docs.select("doc_id", secret_spans(F.col("text"), **parameters).alias("found"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def secret_report(docs: DataFrame, **parameters) -> DataFrame:
    """Counts by kind, a digest of the base spans, and all spans as text."""
    found = F.col("found")
    base = F.filter(found, lambda s: s["kind"] != "random")
    counts = [number_of(found, kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return find_secrets(docs, **parameters).select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(found).alias("spans")
    )
