"""Operator 12: segments and counts against brute force, scores by held-out accuracy."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnhouse.llm import toxicity
from tarnhouse.llm.toxicity import labelled, maximal_segments, toxic_passages, toxicity_report, train, word_counts

from .conftest import ROWS, SCHEMA, stored, words

LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ["doc_id", "held_out", "score", "predicted", "n_passages"]


def segments_by_hand(scores):
    """By definition: the best stretch, then the same on either side of it; of equal ones the shortest, first."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            total = round(sum(scores[a:b]), 6)
            if total > 0 and (best is None or (total, a - b) > (best[0], best[1] - best[2])):
                best = (total, a, b)
    if best is None:
        return []
    total, a, b = best
    right = [(x + b, y + b, s) for x, y, s in segments_by_hand(scores[b:])]
    return segments_by_hand(scores[:a]) + [(a, b - 1, total)] + right


@pytest.mark.parametrize("seed", range(60))
def test_maximal_segments(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 40)
    hits = sorted(rng.sample(range(n), rng.randint(1, n)))
    values = [rng.choice([0.5, 1.0, 1.7, 3.1]) + rng.random() / 100 for _ in hits]
    scores = [-0.8] * n
    for place, v in zip(hits, values, strict=True):
        scores[place] = v
    got = [(a, b, round(s, 6)) for a, b, s in maximal_segments(np.array(hits), np.array(values), 0.8)]
    assert got == segments_by_hand(scores)


def test_segments_in_linear_time():
    n = 300_000
    found = maximal_segments(np.arange(n) * 30, np.linspace(1, 2, n), 0.1)
    assert len(found) == n
    assert len(maximal_segments(np.arange(n), np.ones(n), 0.1)) == 1


def toxic_corpus(n):
    """Texts of which a fifth hold insults; one clean and one toxic text have many copies."""
    rng = random.Random(3)
    insults = ["Blarg", "fnord", "krumpf!", "zwack"]
    docs, labels = [], []
    for k in range(n):
        w = words(rng, rng.randint(20, 120))
        if k % 5 == 0:
            at = rng.randrange(len(w))
            for _ in range(rng.randint(3, 6)):
                w.insert(min(at + rng.randint(0, 4), len(w)), rng.choice(insults))
        docs.append((k, " ".join(w), "en", "s", 1, None, None, None))
        if k % 4:
            labels.append((k, 1, int(k % 5 == 0)))
    for k in range(n, n + n // 3):
        docs.append((k, docs[k % 2 * 5 + 1][1], "en", "s", 1, None, None, None))
        labels.append((k, 1, k % 2))  # copies of a text without insults, labelled either way
    docs += [(None, docs[0][1], None, None, None, None, None, None), (90_000, None, None, None, None, None, None, None), (90_001, "", None, None, None, None, None, None)]
    docs += [docs[5], docs[5]]
    labels += [(None, 1, 1), (2, 1, None), (90_000, 1, 0), (90_000, 1, 0)]
    return docs, labels


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("toxic")
    docs, labels = toxic_corpus(900)
    return docs, labels, stored(spark, path, docs, SCHEMA, "documents"), stored(spark, path, labels, LABELS, "labels")


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def test_counts(corpus):
    docs, labels, table, label_table = corpus
    toxic = {d: t for d, _, t in labels if d is not None and t is not None and fold(d)}
    seen = defaultdict(set)
    for d, text, *_ in docs:
        if d in toxic:
            w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
            for prev, word in zip(["", *w], w, strict=False):
                seen[word, toxic[d], prev].add(fold(d))
    got = {r["word"]: (list(r["t"]), list(r["c"])) for r in word_counts(labelled(table, label_table)).collect()}
    want = defaultdict(lambda: ([0] * 5, [0] * 5))
    for (word, t, _), folds in seen.items():
        own = want[word][0 if t else 1]
        own[0] += 1
        for f in range(1, 5):
            own[f] += folds != {f}
    assert got == dict(want)


def test_held_out_documents(corpus):
    docs, _, table, label_table = corpus
    got = toxicity_report(table, label_table)
    assert got.columns == COLUMNS and dict(got.dtypes)["predicted"] == "int"
    rows = got.collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (r["doc_id"] is not None and fold(r["doc_id"]) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    unseen = [r for r in rows if r["held_out"] and r["doc_id"] < 900]
    assert all(r["predicted"] == (r["doc_id"] % 5 == 0) for r in unseen) and len(unseen) > 100
    # Copies of an innocent text stay innocent, however many are labelled toxic.
    assert not any(r["predicted"] for r in rows if r["doc_id"] is not None and r["doc_id"] >= 900)
    again = sorted(map(repr, toxicity_report(table.withColumn("lang", F.lit("x")).drop("source"), label_table).collect()))
    assert again == sorted(map(repr, rows))


def test_passages_are_where_the_insults_are(corpus):
    docs, _, table, label_table = corpus
    texts = {d: [x for x in re.split(r"[\W_]+", (t or "").lower()) if x] for d, t, *_ in docs}
    for r in toxic_passages(table, label_table).where("score > 0.5 AND doc_id IS NOT NULL").collect():
        assert r["passages"] and r["n_words"] == len(texts[r["doc_id"]])
        found = [w for p in r["passages"] for w in texts[r["doc_id"]][p["start"] : p["end"] + 1]]
        assert {"blarg", "fnord", "krumpf", "zwack"} & set(found)


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_either_way_to_join_the_words(corpus, spark, monkeypatch, limit, broadcast_limit):
    """Telling words broadcast, or shuffled."""
    _, _, table, label_table = corpus
    want = sorted(repr((r[0], round(r[2], 9))) for r in toxicity_report(table, label_table).collect())
    by_size = toxicity.measured
    monkeypatch.setattr(toxicity, "measured", lambda df, size: by_size(df, size, limit))
    got = sorted(repr((r[0], round(r[2], 9))) for r in toxicity_report(table, label_table).collect())
    assert got == want


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_labels_of_one_kind_or_none(spark, docs, tmp_path, toxic):
    rows = [] if toxic is None else [(k, 1, toxic) for k in range(20)]
    got = toxicity_report(docs, stored(spark, tmp_path, rows, LABELS, "labels")).collect()
    assert len(got) == len(ROWS) and {r["score"] for r in got} == {float(toxic or 0)}


def test_empty_tables(spark, no_docs, tmp_path):
    labels = stored(spark, tmp_path, [(1, 1, 1), (2, 1, 0)], LABELS, "labels")
    got = toxicity_report(no_docs, labels)
    assert got.columns == COLUMNS and got.collect() == []
    assert train(no_docs, labels).calibration is None
