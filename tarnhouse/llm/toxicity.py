"""Operator 12, toxic passages by maximum-scoring segments of token log-odds.

A word counts once for each word that stands before it, in documents labelled toxic and in the
others, so that copies of a text count once. A word's score is its log-odds between the two, with a
Dirichlet prior of the word's share of all, less its standard error: what a word says for sure.
Words that say something toxic count with their score, every other word with ``-gap``. One linear
scan over a document's scores finds all maximal segments: those that no longer or shorter stretch
betters.

How high a segment comes by chance is learnt from the documents labelled not toxic: high scores
fall off exponentially, at a rate ``lam``, so a text of m words holds K m exp(-lam s) segments of
score s by chance, its extreme value. The segments of a document are summed as ln of what they
exceed this by, and a logistic curve turns the sum into a score from 0 to 1. While rate and curve
are learnt, documents are scored by counts of the other folds alone.

Words are runs of letters and digits in lower case. A null or empty text has no words. Rows whose
label is null teach nothing; a document with several labels is toxic if any says so. Rows are
documents one by one, also repeated ones; a null id has no label and is not held out. Other columns
are not read. Without words in labelled documents of both kinds the score is 1 or 0, as the one kind
is, and 0 without any; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.common import Stored, measured

PRIOR = 0.025  # weight of the prior, as a share of what is counted
MARGIN = 1.0  # log-odds that a word must have beyond its standard error
GAP = 0.1
FOLDS = 5  # the first is held out
SEGMENTS = "array<struct<start:int,end:int,score:double>>"
BIN = 0.25  # width of the bins that the logistic curve is fitted on
STEEPEST = 2.0  # log-odds in nats fall off at a rate of about 1; a few small ones can look steeper
HIGHEST = 12.0  # evidence beyond this says no more


def words_of(text: Column) -> Column:
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(found, lambda w: w != "")


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold_of(doc_id) == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic (0 or 1) and fold of the documents to learn from."""
    by_id = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    known = Stored(by_id.where(fold_of(F.col("doc_id")) != 0), "toxic-labels").df
    fold = fold_of(F.col("doc_id")).cast("int").alias("fold")
    return docs.select("doc_id", "text").join(measured(known, 16), "doc_id").select("text", "toxic", fold)


def word_score(toxic: Column, clean: Column, n_toxic: Column, n_clean: Column, prior: float) -> Column:
    """Log-odds less their standard error, from the counts of the word and of all words."""
    a, b = toxic + (toxic + clean) * prior, clean + (toxic + clean) * prior
    weight = (n_toxic + n_clean) * prior
    odds = F.log(a / (n_toxic + weight - a)) - F.log(b / (n_clean + weight - b))
    return F.when(toxic > 0, odds - F.sqrt(1 / a + 1 / b) - MARGIN)


def word_counts(known: DataFrame) -> DataFrame:
    """word, and its numbers of different words before it: toxic (t) and clean (c), of all folds and without each."""
    words = known.select("toxic", "fold", words_of(F.col("text")).alias("word"))
    both = words.select("toxic", "fold", F.concat(F.array(F.lit("")), "word").alias("prev"), "word")
    pairs = both.select("toxic", "fold", F.explode(F.arrays_zip("prev", "word")).alias("p")).where("p.word IS NOT NULL")
    # These rows are many: the word before goes as 24 bits of a hash, and a bit stands for each kind and
    # fold. Only where a word has millions of words before it, and its odds are certain, do some coincide.
    bit = F.call_function("shiftleft", F.lit(1), F.col("fold") - 1 + F.col("toxic") * (FOLDS - 1)).cast("short")
    pairs = pairs.select("p.word", F.hash("p.prev").bitwiseAND(F.lit(0xFFFFFF)).alias("before"), bit.alias("bit"))
    seen = pairs.groupBy("word", "before").agg(F.bit_or("bit").cast("int").alias("folds"))

    def number(toxic: int) -> Column:
        bits = [1 << (f + toxic * (FOLDS - 1)) for f in range(FOLDS - 1)]
        left_out = [0, *bits]
        return F.array(*[F.count_if(F.col("folds").bitwiseAND(F.lit(sum(bits) - out)) != 0) for out in left_out])

    return seen.groupBy("word").agg(number(1).alias("t"), number(0).alias("c"))


def maximal_segments(places: np.ndarray, scores: np.ndarray, gap: float) -> list[tuple[int, int, float]]:
    """All maximal segments, as first place, last place and score; each word between places costs ``gap``.

    Candidates wait on a list with the sums before and after them. Each knows the last one before
    it that began lower, so that a new one skips those that it cannot join, and the scan is linear.
    """
    held: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, -1
    for place, score in zip(places.tolist(), scores.tolist(), strict=True):
        total -= gap * (place - at - 1)
        before, total, at = total, total + score, place
        start = place
        k = len(held) - 1
        while True:
            while k >= 0 and held[k][2] >= before:
                k = held[k][4]
            if k < 0 or held[k][3] >= total:
                held.append((start, place, before, total, k))
                break
            start, before = held[k][0], held[k][2]
            del held[k:]
            k -= 1
    return [(a, b, after - before) for a, b, before, after, _ in held]


def segments(places: Column, scores: Column, gap: float) -> Column:
    @F.pandas_udf(SEGMENTS)
    def find(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for rows_places, rows_scores in batches:
            out = []
            for p, s in zip(rows_places, rows_scores, strict=True):
                order = np.argsort(p)
                found = maximal_segments(np.asarray(p)[order], np.asarray(s)[order], gap) if len(p) else []
                out.append([{"start": a, "end": b, "score": x} for a, b, x in found])
            yield pd.Series(out, dtype=object)

    return find(places, scores)


def document_segments(docs: DataFrame, telling: DataFrame, score: Column, gap: float, *keep: str) -> DataFrame:
    """The columns ``keep`` of each document, its number of words and its maximal segments.

    ``telling`` has a row for each word that may say something, and ``score`` may use its columns
    and those kept. Only these words leave the task in which a document is scanned.
    """
    first = F.array(F.lit(""))  # a row that every document has
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), *keep, F.concat(first, words_of(F.col("text"))).alias("w"))
    words = texts.select("rid", *keep, (F.size("w") - 1).alias("n_words"), F.posexplode("w").alias("place", "word"))
    scored = words.join(telling, "word", "left").withColumn("s", score).where("place = 0 OR s > 0")
    hit = F.when(F.col("place") > 0, F.struct((F.col("place") - 1).alias("at"), "s"))
    by_doc = scored.groupBy("rid").agg(*[F.first(c).alias(c) for c in (*keep, "n_words")], F.collect_list(hit).alias("hits"))
    return by_doc.select(*keep, "n_words", segments(F.col("hits.at"), F.col("hits.s"), gap).alias("segments"))


@dataclass(frozen=True)
class Calibration:
    """Rate and constant of chance segments, and the logistic curve over their excess."""

    lam: float
    k: float
    intercept: float
    slope: float

    def excess(self, score: Column, n_words: Column) -> Column:
        """ln of how far a segment exceeds what a text of this length holds by chance.

        Chance has one place at least, so that small segments of short texts do not add up.
        """
        return self.lam * score - F.log(F.greatest(n_words * self.k, F.lit(1.0)))

    def evidence(self) -> Column:
        """Over all segments that exceed chance."""
        each = F.transform("segments", lambda s: self.excess(s["score"], F.col("n_words")))
        over = F.aggregate(each, F.lit(0.0), lambda total, x: total + F.greatest(x, F.lit(0.0)))
        return F.least(over, F.lit(HIGHEST))

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-(self.intercept + self.slope * self.evidence())))


def chance_segments(found: DataFrame) -> tuple[float, float]:
    """lam and K, from the segments of documents that are not toxic.

    Two quantiles give the rate, so that a few documents with a wrong label do not move it.
    """
    clean = found.where("toxic = 0")
    n_words = clean.agg(F.sum("n_words")).first()[0] or 1
    scores = clean.select(F.explode("segments.score").alias("score"))
    n, high = scores.agg(F.count("*"), F.percentile_approx("score", [0.9, 0.98], 10_000)).first()
    if not n:
        return 1.0, 1.0 / n_words
    lam = min(math.log(5) / max(high[1] - high[0], 1e-9), STEEPEST)
    return lam, 0.1 * n * math.exp(lam * high[0]) / n_words


def logistic(x: np.ndarray, yes: np.ndarray, no: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Intercept and slope by Newton's method, over bins; the ridge keeps the slope finite."""
    beta = np.zeros(2)
    design = np.stack([np.ones(len(x)), x])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(beta @ design)))
        gradient = design @ (yes - (yes + no) * p) - ridge * beta * [0, 1]
        curve = (design * ((yes + no) * p * (1 - p))) @ design.T + np.diag([1e-9, ridge])
        step = np.linalg.solve(curve, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


@dataclass(frozen=True)
class ToxicModel:
    """Telling words with their scores, and the calibration; without it, the score of all documents."""

    words: DataFrame
    calibration: Calibration | None
    constant: float
    gap: float

    def passages(self, docs: DataFrame, *keep: str) -> DataFrame:
        """``keep``, n_words, score and passages: word numbers, score and extreme value of each."""
        if self.calibration is None:
            none = F.array().cast("array<struct<start:int,end:int,score:double,chance:double>>")
            n_words = F.size(words_of(F.col("text"))).alias("n_words")
            return docs.select(*keep, n_words, F.lit(self.constant).alias("score"), none.alias("passages"))
        c = self.calibration
        found = document_segments(docs, measured(self.words, F.length("word") + 24), F.col("s_word"), self.gap, *keep)
        chance = lambda s: F.exp(-c.excess(s["score"], F.col("n_words")))
        each = F.transform("segments", lambda s: s.withField("chance", chance(s)))
        passages = F.filter(each, lambda s: s["chance"] < 1).alias("passages")
        return found.select(*keep, "n_words", c.probability().alias("score"), passages)


def train(docs: DataFrame, labels: DataFrame, prior: float = PRIOR, gap: float = GAP) -> ToxicModel:
    """A model of all labelled documents outside the held-out fold."""
    known = labelled(docs, labels)
    counts = Stored(word_counts(known), "word-counts").df
    sums = counts.agg(*[F.sum(F.col(k)[f]) for k in "tc" for f in range(FOLDS)]).first()
    if not (sums[0] and sums[FOLDS]):
        return ToxicModel(counts, None, float(bool(sums[0])), gap)
    totals = [F.array(*map(F.lit, sums[k : k + FOLDS])) for k in (0, FOLDS)]

    def score(of: Column) -> Column:
        """Of all folds (0), or without a fold (its number)."""
        return word_score(F.col("t")[of], F.col("c")[of], totals[0][of], totals[1][of], prior)

    scores = counts.select("word", F.array(*[score(F.lit(f)) for f in range(FOLDS)]).alias("s"))
    telling = Stored(scores.where(F.exists("s", lambda x: x > 0)).withColumnRenamed("s", "by_fold"), "telling-words")
    of_fold = F.col("by_fold")[F.col("fold")]
    found = document_segments(known, measured(telling.df, F.length("word") + 80), of_fold, gap, "toxic", "fold")
    found = Stored(found, "training-segments").df
    calibration = Calibration(*chance_segments(found), 0.0, 1.0)
    bins = F.round(calibration.evidence() / BIN) * BIN
    rows = found.groupBy(bins.alias("x")).agg(F.sum("toxic").alias("yes"), F.sum(1 - F.col("toxic")).alias("no")).collect()
    x, yes, no = np.array([tuple(r) for r in rows], dtype=float).T
    curve = logistic(x, yes, no)
    words = telling.df.select("word", F.col("by_fold")[0].alias("s_word")).where("s_word > 0")
    return ToxicModel(words, Calibration(calibration.lam, calibration.k, *curve), 0.0, gap)


def toxic_passages(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """doc_id, n_words, score and passages of every document."""
    return train(docs, labels, **parameters).passages(docs, "doc_id")


def toxicity_report(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    return toxic_passages(docs, labels, **parameters).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )
