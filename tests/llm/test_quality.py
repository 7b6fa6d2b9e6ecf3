"""Operator 5 against a Kneser-Ney model in plain Python, and the pipeline against brute force."""

from __future__ import annotations

import collections
import math
import random

import pytest

import corpus_pipeline
from tarnhouse.llm.decontamination import contamination_report
from tarnhouse.llm.quality import document_scores, keep_good, quality, quality_report, quantile

from .conftest import ROWS, words
from .test_dedup import contamination_by_hand, groups_by_hand, lines_by_hand

LABELS = "doc_id long, quality int, toxic int"


def grams(text):
    folded = "   " + " ".join((text or "").split()) + " "
    folded = [min(ord(c), 0xFFFF) for c in folded]
    if len(folded) <= 4:
        return collections.Counter()
    return collections.Counter(tuple(folded[i : i + 4]) for i in range(len(folded) - 3))


class Model:
    """Interpolated modified Kneser-Ney, straight from the definition."""

    def __init__(self, counts):
        self.counts = {4: counts}
        for k in (3, 2, 1):
            self.counts[k] = collections.Counter(g[1:] for g in self.counts[k + 1])
        self.discounts, self.contexts = {}, {}
        for k, c in self.counts.items():
            n = [max(sum(v == i for v in c.values()), 1) for i in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1])
            self.discounts[k] = [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i) for i in (1, 2, 3)]
            self.contexts[k] = collections.defaultdict(list)
            for g, v in c.items():
                self.contexts[k][g[:-1]].append(v)

    def p(self, g):
        k = len(g)
        if not k:
            return 1 / (len(self.counts[1]) + 1)
        seen = self.contexts[k].get(g[:-1])
        if not seen:
            return self.p(g[1:])
        less = lambda v: self.discounts[k][min(v, 3) - 1] if v else 0
        own = self.counts[k].get(g, 0)
        return (own - less(own) + sum(map(less, seen)) * self.p(g[1:])) / sum(seen)


def label_kinds(labels):
    by_doc = collections.defaultdict(list)
    for doc, good, toxic in labels:
        if doc is not None:
            by_doc[doc].append((good or 0, toxic or 0))
    kinds = {}
    for doc, own in by_doc.items():
        if max(t for _, t in own) > 0:
            kinds[doc] = "toxic"
        elif min(g for g, _ in own) > 0:
            kinds[doc] = "trusted"
    return kinds


def scores_by_hand(rows, labels):
    kinds = label_kinds(labels)
    counts = collections.defaultdict(collections.Counter)
    for doc, text, lang in rows:
        if doc in kinds:
            counts[kinds[doc], lang or ""].update(grams(text))
    models = {key: Model(c) for key, c in counts.items() if c}
    out = []
    for doc, text, lang in rows:
        own, good, bad = grams(text), models.get(("trusted", lang or "")), models.get(("toxic", lang or ""))
        n = sum(own.values())
        if not good or not n:
            out.append((doc, lang or "", n, None, None, kinds.get(doc)))
            continue
        surprise = sum(c * -math.log(good.p(g)) for g, c in own.items())
        evidence = sum(c * max(0, math.log(bad.p(g)) - math.log(good.p(g)) - 2) for g, c in own.items()) if bad else 0
        out.append((doc, lang or "", n, math.exp(surprise / n), evidence * 1000 / n, kinds.get(doc)))
    return out


FEW = [(k, k % 4 != 1, k % 5 == 2) for k in range(0, 36)] + [(9, 1, 1), (None, 1, 0), (10, None, None), (11, 1, None), (99, 1, 0)]
FEW = [(d, None if q is None else int(q), None if t is None else int(t)) for d, q, t in FEW]


def test_scores_are_those_of_the_model(spark, docs):
    labels = spark.createDataFrame(FEW, LABELS)
    want = sorted(scores_by_hand([r[:3] for r in ROWS], FEW), key=repr)
    for limit in (64 << 20, 0):
        rows = document_scores(docs, labels, shards=3, broadcast_bytes=limit).collect()
        got = sorted(((r["doc_id"], r["lang"], r["n_grams"], r["perplexity"], r["toxicity"], r["kind"]) for r in rows), key=repr)
        assert [(r[0], r[1], r[2], r[5]) for r in got] == [(r[0], r[1], r[2], r[5]) for r in want]
        for a, b in zip(got, want, strict=True):
            for x, y in zip(a[3:5], b[3:5], strict=True):
                assert (x is None) == (y is None) and (x is None or x == pytest.approx(y, rel=1e-3, abs=0.2)), (a, b)
    assert sum(r[3] is not None for r in want) > 20 and sum((r[4] or 0) > 0 for r in want) > 3


def test_quantile_covers_all_rows(spark):
    rng = random.Random(1)
    rows = [(lang, rng.lognormvariate(1, 1)) for lang in "ab" for _ in range(500)] + [("c", None)]
    got = {r["lang"]: r["x"] for r in quantile(spark.createDataFrame(rows, "lang string, v double"), "v", 0.9, "x").collect()}
    assert set(got) == {"a", "b"}
    for lang, x in got.items():
        own = sorted(v for k, v in rows if k == lang)
        assert own[449] <= x <= own[449] * 1.011


def corpus(seed=21):
    """Clean, shouting and toxic documents in one language, with labels for half of them."""
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(240):
        w = words(rng, rng.randint(40, 90))
        kind = "clean" if k % 4 else ("loud" if k % 8 else "toxic")
        if kind == "loud":
            w = [x.upper() + "!!" for x in w]
        if kind == "toxic":
            for at in range(5, len(w), 9):
                w[at] = rng.choice(["zzgrumpf", "kwaxly", "vozzik"])
        rows.append((k, " ".join(w), "en", f"s{k % 12}", k))
        if k % 2 == 0 or k % 16 == 1:
            labels.append((k, int(kind != "loud"), int(kind == "toxic")))
    return rows, labels


def test_bad_documents_are_rejected_and_clean_ones_kept(spark):
    rows, labels = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["rejected"] for r in quality(df, spark.createDataFrame(labels, LABELS)).collect()}
    clean = [got[k] for k in got if k % 4]
    assert sum(clean) <= 3 and len(clean) == 180
    assert all(got[k] for k in got if k % 4 == 0)


def test_without_labels_all_stay(spark, docs, no_docs):
    none = spark.createDataFrame([], LABELS)
    report = quality_report(docs, none).collect()
    assert len(report) == len(ROWS) and not any(r["rejected"] for r in report)
    assert keep_good(docs, none).count() == len(ROWS)
    assert keep_good(docs, none).columns == docs.columns
    some = spark.createDataFrame(FEW, LABELS)
    assert quality_report(no_docs, some).collect() == []


def test_pipeline_stages(spark, tmp_path):
    """Each stage on what the one before kept, against brute force."""
    rows, labels = corpus(5)
    rng = random.Random(9)
    line, passage = "a shared line of boilerplate", " ".join(words(rng, 25))
    for k in range(240, 262):
        text = f"{line}\n{' '.join(words(rng, 50))}"
        rows.append((k, text, "en", f"s{k % 12}", k))
        labels.append((k, 1, 0))
    rows.append((262, rows[1][1] + " more", "en", "s1", 0))
    rows.append((263, rows[2][1], "en", "s2", 0))
    rows.append((264, " ".join(words(rng, 20)) + " " + passage, "en", "s3", 0))
    rows.append((265, None, None, None, None))
    items = [(1, passage)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    sf = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{sf}/{name}")
        docs = spark.read.parquet(f"{sf}/{name}")
        kept.append(sorted((r["doc_id"], r["text"]) if "text" in r else (r["doc_id"], r["n_tokens"]) for r in docs.select(*[c for c in ("doc_id", "text", "n_tokens") if c in docs.columns]).collect()))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    good, lines, single, clean, encoded = kept
    assert {264, 265, 262, 263, 240} <= {d for d, _ in good} and not any(d % 8 == 0 and d < 240 for d, _ in good)
    source = {r[0]: r[3] for r in rows}
    by_hand = lines_by_hand([(d, t, source[d]) for d, t in good], 8)
    assert lines == sorted((d, t if t is None else k) for d, _, g, k, t in by_hand if not g or k.strip())
    groups = groups_by_hand(lines, 80)
    assert single == [row for row, g in zip(lines, groups, strict=True) if g[3] or not g[1]]
    assert {262, 263} & {d for d, _ in single} == set()
    assert clean == [row for row, c in zip(single, contamination_by_hand(single, items), strict=True) if not c[5]]
    assert 264 not in {d for d, _ in clean}
    assert [d for d, _ in encoded] == [d for d, _ in clean]
    assert contamination_report(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated").count() == 1
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()) == [d for d, _ in encoded]


SYLLABLES = ["ach", "lich", "keit", "ver", "ung", "sch", "ein", "te", "ge", "zu"]


def syllable_words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def hidden(lang="de", start=0, seed=3, n=240):
    """Every fourth document holds three words of the same syllables as all others; the first half is labelled."""
    rng = random.Random(seed)
    bad = ["achlichver", "keitachlich", "achkeitsch", "verachlich"]
    rows, labels = [], []
    for k in range(start, start + n):
        w = [x for x in syllable_words(rng, rng.randint(300, 600)) if x not in bad]
        if k % 4 == 0:
            at = rng.randrange(100)
            w[at:at] = rng.sample(bad, 3)
        rows.append((k, " ".join(w), lang, "s", 0))
        if k < start + n // 2:
            labels.append((k, 1, int(k % 4 == 0)))
    return rows, labels


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_toxic_words_of_common_syllables(spark):
    """On documents without a label; the mean over characters alone misses them."""
    rows, labels = hidden()
    for limit in (64 << 20, 0):
        got = {r["doc_id"]: r["rejected"] for r in quality(
            spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS), shards=3, broadcast_bytes=limit
        ).collect()}
        assert len(got) == len(rows)
        assert sum(got[k] for k in range(120, 240) if k % 4 == 0) >= 28
        assert sum(got[k] for k in range(120, 240) if k % 4) <= 3


def test_languages_without_labels_are_judged(spark):
    """A null language without labels, one with trusted documents only; good ones stay."""
    rows, labels = corpus()
    for k, (doc, text, *_) in enumerate(corpus(22)[0]):
        rows.append((1000 + doc, text, None if k % 2 else "xx", "s", 0))
    for doc, text, *_ in corpus(23)[0]:
        rows.append((2000 + doc, text, None, "s", 0))
    labels += [(1000 + k, 1, 0) for k in (2, 6, 10)]  # of xx
    report = quality(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS), shards=3)
    got = {r["doc_id"]: r["rejected"] for r in report.collect()}
    assert sum(got[k] for k in got if k % 4) <= 10
    assert all(got[k] for k in got if k % 8 == 0), "toxic"
    assert all(got[k] for k in got if k % 8 == 4), "loud"
