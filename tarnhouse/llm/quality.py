"""Operator 5, quality by an interpolated modified Kneser-Ney model of character n-grams.

All documents labelled good and not toxic train a model for each language, and all labelled toxic
train a second one. Counts, continuation counts and discounts are aggregations; probabilities of
the corpus's distinct n-grams come from joins with them, order by order. Documents' n-gram
frequencies, packed by blocks of documents and shards of n-grams, join the shards of the model,
and the products are summed to each document's perplexity and toxic evidence: how far n-grams are
likelier under the toxic model, per thousand.

Words are a second order beside the characters, as toxic words made of common syllables leave
little trace in those. A word's share of toxic documents, among the labelled ones that hold it,
is interpolated by language with all languages and these with the share of all words; a word
speaks against a document if most documents that hold it are toxic, by the logarithm of the odds.
The words of the worst stretch of a text count, each once, so that a long text hides nothing. A
labelled document is left out of the counts that judge it.

A document is rejected if its perplexity is far above what nearly all trusted documents of its
language reach, or its evidence is, and also reaches half of what nearly all toxic ones have, or
if its worst stretch is above that of nearly all trusted ones.
Quantiles are taken from histograms, so they cover all labelled documents and do not depend on
task order.

Texts are read with white space folded to single blanks; characters outside the basic plane
count as one symbol. A language that lacks trusted or toxic documents is
judged by the models of all languages together, and each language's limits are interpolated with
those of all, by its number of labelled documents. A null or empty text has no perplexity and is
kept; a null language is a language of its own. Labels that repeat are
combined: trusted if all are good and none is toxic, toxic if one is. Rows are documents one by
one, also repeated ones and those with a null id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnhouse.llm.blocks import BLOCK_DOCS, by_bucket, pack, unpack
from tarnhouse.llm.common import BROADCAST_BYTES, Stored, free_name, measured, numbered, release

ORDER = 4
BITS = 16  # of a character in an n-gram's code
UNIT = 10_000  # log probabilities are whole numbers of 1 / UNIT, so that sums are exact
BLOCK_CHARS = 3 << 20  # a task holds several numbers for each character of a block
GROUP_TASKS = 16  # scan tasks whose blocks meet one copy of a model shard
SHARD_CODES = 1 << 20  # n-grams of a language in a shard of its model
EVIDENCE = 2.0  # nats by which an n-gram must be likelier under the toxic model to count
BINS = 100  # histogram bins for each factor of e
STRETCH = 200  # words; stretches overlap by half
PRIOR = 4.0  # documents that a wider count weighs in a word's share of toxic ones
OVER = 2.0  # nats by which a word's odds must at least exceed those of all labelled documents
THIN = 20  # labelled documents of a language that weigh as much as all languages' limit
EVERY = "\x01every"  # stands for all languages together
LEAST_WORST = 0.5  # evidence that a worst stretch must at least have
WORDS = r"[^\p{L}\p{M}\p{N}]+"

KEYED = "rid long, doc_id string, lang string, text string"
PACKED = "lang string, shard int, block long, kind int, data binary"
HEADER, POSTINGS, SUMS = 0, 1, 2


def codes_of(text: str) -> np.ndarray:
    """Codes of the n-grams of a text, as signed 64-bit numbers."""
    folded = " " * (ORDER - 1) + " ".join(text.split()) + " "
    chars = np.frombuffer(folded.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if len(chars) <= ORDER:
        return np.empty(0, dtype=np.int64)
    chars = np.minimum(chars, np.uint64((1 << BITS) - 1))
    n = len(chars) - ORDER + 1
    codes = np.zeros(n, dtype=np.uint64)
    for k in range(ORDER):
        codes = (codes << np.uint64(BITS)) | chars[k : k + n]
    return codes.view(np.int64)


def shard_numbers(codes: np.ndarray, shards: int) -> np.ndarray:
    return np.mod(codes ^ (codes.view(np.uint64) >> np.uint64(29)).view(np.int64), shards).astype(np.int32)


def shard_column(code: Column, shards: int) -> Column:
    """The same as ``shard_numbers``, in Spark."""
    return F.pmod(code.bitwiseXOR(F.shiftrightunsigned(code, 29)), F.lit(shards)).cast("int")


def keyed(docs: DataFrame, row: str) -> DataFrame:
    return docs.select(
        F.col(row).alias("rid"),
        F.col("doc_id").cast("string").alias("doc_id"),  # pandas has no null in whole numbers
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


class Tally:
    """Counts of n-grams in bounded memory: folded whenever enough have come."""

    def __init__(self, fold_at: int = 2_000_000):
        self.codes, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size, self.fold_at = 0, fold_at

    def add(self, codes: np.ndarray) -> None:
        self.waiting.append(codes)
        self.size += len(codes)
        if self.size >= self.fold_at:
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        new, counts = np.unique(np.concatenate([np.empty(0, np.int64), *self.waiting]), return_counts=True)
        codes = np.concatenate([self.codes, new])
        self.codes, at = np.unique(codes, return_inverse=True)
        self.counts = np.bincount(at, weights=np.concatenate([self.counts, counts]), minlength=len(self.codes)).astype(np.int64)
        self.waiting, self.size = [], 0
        return self.codes, self.counts


def tallied(texts: DataFrame, by: str) -> DataFrame:
    """Columns ``by`` (strings), code and n, partly summed: one row for each task and n-gram."""
    names = by.split()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tallies: dict[tuple, Tally] = {}
        for batch in batches:
            for *key, text in zip(*(batch[c] for c in names), batch["text"], strict=True):
                tallies.setdefault(tuple(key), Tally()).add(codes_of(text))
        for key, tally in tallies.items():
            codes, counts = tally.fold()
            yield pd.DataFrame({**dict(zip(names, key, strict=True)), "code": codes, "n": counts})

    schema = ", ".join(f"{c} string" for c in names) + ", code long, n long"
    return texts.select(*names, "text").mapInPandas(count, schema)


def label_classes(labels: DataFrame) -> DataFrame:
    """label_id and kind (trusted or toxic) of the labelled documents that train."""
    by_doc = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("label_id")).agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    kind = F.when(F.col("toxic") > 0, "toxic").when(F.col("good") > 0, "trusted")
    return by_doc.select("label_id", kind.alias("kind")).where("kind IS NOT NULL")


def suffix(code: Column, order: int) -> Column:
    return code.bitwiseAND(F.lit((1 << BITS * order) - 1)) if order < ORDER else code


def context(code: Column) -> Column:
    return F.shiftrightunsigned(code, BITS)


class KneserNey:
    """Count tables of all orders, and what their contexts leave to the lower order."""

    def __init__(self, counts: DataFrame):
        self.key = ["kind", "lang"]
        self.stored: list[Stored] = []
        self.counts = {ORDER: self.keep(counts, "counts")}
        for k in range(ORDER - 1, 0, -1):
            lower = self.counts[k + 1].groupBy(*self.key, suffix(F.col("code"), k).alias("code"))
            self.counts[k] = self.keep(lower.agg(F.count("*").alias("n")), "counts")
        self.discounted, self.contexts = {}, {}
        for k, table in self.counts.items():
            rows = table.join(self.discounts(table), self.key)
            less = F.get("discount", F.least("n", F.lit(3)).cast("int") - 1)
            rows = rows.select(*self.key, "code", "n", less.alias("less"))
            self.discounted[k] = rows.withColumn("rest", F.col("n") - F.col("less")).drop("n", "less")
            self.contexts[k] = self.keep(
                rows.groupBy(*self.key, context(F.col("code")).alias("context")).agg(
                    F.sum("n").alias("total"), F.sum("less").alias("mass")
                ),
                "contexts",
            )

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        stored = Stored(df, name)
        self.stored.append(stored)
        return stored.df

    def discounts(self, table: DataFrame) -> DataFrame:
        """D1, D2 and D3+ from the numbers of n-grams that occur once to four times."""
        n = [F.greatest(F.count(F.when(F.col("n") == k, 1)), F.lit(1)).alias(f"n{k}") for k in (1, 2, 3, 4)]
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        d = [F.lit(k) - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}") for k in (1, 2, 3)]
        bounded = [F.least(F.greatest(x, F.lit(0.05)), F.lit(float(k))) for k, x in enumerate(d, 1)]
        return table.groupBy(*self.key).agg(*n).select(*self.key, F.array(*bounded).alias("discount"))

    def probabilities(self, codes: DataFrame) -> DataFrame:
        """kind, lang, code and p of the given n-grams, for all kinds with that language."""
        symbols = self.counts[1].groupBy(*self.key).agg((1 / (F.count("*") + 1)).alias("p"))
        lower = symbols.select(*self.key, F.lit(0).cast("long").alias("code"), "p")
        for k in range(1, ORDER + 1):
            own = codes.select("lang", suffix(F.col("code"), k).alias("code"))
            own = own.distinct() if k < ORDER else own
            rows = own.withColumn("below", suffix(F.col("code"), k - 1)).withColumn("context", context(F.col("code")))
            rows = rows.join(lower.withColumnRenamed("code", "below"), ["lang", "below"])
            rows = rows.join(self.contexts[k], [*self.key, "context"], "left")
            rows = rows.join(self.discounted[k], [*self.key, "code"], "left")
            mixed = (F.coalesce("rest", F.lit(0.0)) + F.col("mass") * F.col("p")) / F.col("total")
            lower = rows.select(*self.key, "code", F.when(F.col("total").isNull(), F.col("p")).otherwise(mixed).alias("p"))
            if k < ORDER:
                lower = self.keep(lower, "probabilities")
        return lower

    def remove(self) -> None:
        for stored in self.stored:
            stored.remove()


def hashed_words(text: Column) -> Column:
    return F.transform(F.filter(F.split(F.lower(text), WORDS), lambda w: w != ""), lambda w: F.xxhash64(w))


def share(toxic: Column, trusted: Column, wider: Column) -> Column:
    return (toxic + PRIOR * wider) / (toxic + trusted + PRIOR)


def word_counts(known: DataFrame) -> DataFrame:
    """word, toxic and trusted (documents that hold it) and the same by language, as own; of words in toxic documents."""
    rows = known.select("kind", "lang", F.explode(F.array_distinct(hashed_words(F.col("text")))).alias("word"))
    counts = [F.count(F.when(F.col("kind") == kind, 1)).alias(kind) for kind in ("toxic", "trusted")]
    own = rows.groupBy("word", "lang").agg(*counts)
    return own.groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("trusted").alias("trusted"), F.collect_list(F.struct("lang", "toxic", "trusted")).alias("own")
    ).where("toxic > 0")


def odds(lang: Column, toxic_less: Column, trusted_less: Column, prior: float) -> Column:
    """Log odds of a word in a language, less the bar, without so many labelled documents."""
    bar = max(0.0, math.log(prior / (1 - prior)) + OVER)
    every = share(F.col("toxic") - toxic_less, F.col("trusted") - trusted_less, F.lit(prior))
    own = F.get(F.filter("own", lambda x: x["lang"] == lang), F.lit(0))
    mixed = F.when(own.isNull(), every).otherwise(share(own["toxic"] - toxic_less, own["trusted"] - trusted_less, every))
    return F.log(mixed / (1 - mixed)) - bar


def worst_stretches(texts: DataFrame, known: DataFrame, classes: DataFrame, broadcast_bytes: int) -> DataFrame:
    """rid and worst, the evidence of the words of the worst stretch, of rows that have any; stored."""
    n = known.groupBy().agg(F.count("*").alias("n"), F.count(F.when(F.col("kind") == "toxic", 1)).alias("toxic")).first()
    prior = (n["toxic"] + 0.5) / (n["n"] + 1)
    none, one = F.lit(0), F.lit(1)
    counts = word_counts(known)
    # Without one trusted document, whichever language it is in, a word has its highest odds.
    less = F.least(F.col("trusted"), one)
    highest = F.array_max(F.transform("own", lambda x: odds(x["lang"], none, F.least(x["trusted"], one), prior)))
    telling = Stored(counts.where(F.greatest(highest, odds(F.lit(None).cast("string"), none, less, prior)) > 0), "words")
    words = measured(telling.df, 60 + 40 * F.size("own"), broadcast_bytes)
    found = texts.select("rid", "doc_id", "lang", F.posexplode(hashed_words(F.col("text"))).alias("at", "word")).join(words, "word")
    found = found.join(classes, found["doc_id"] == F.col("label_id").cast("string"), "left")
    held = [F.coalesce((F.col("kind") == kind).cast("int"), none) for kind in ("toxic", "trusted")]
    halves = F.floor(F.col("at") / (STRETCH // 2))
    rows = found.select("rid", F.explode(F.array(halves, halves + 1)).alias("stretch"), "word", odds(F.col("lang"), *held, prior).alias("odds"))
    each = rows.where("odds > 0").groupBy("rid", "stretch", "word").agg(F.max("odds").alias("odds"))
    # Whole numbers of 1 / UNIT, so that sums are exact.
    sums = each.groupBy("rid", "stretch").agg(F.sum(F.round(F.col("odds") * UNIT).cast("long")).alias("sum"))
    out = Stored(sums.groupBy("rid").agg((F.max("sum") / UNIT).alias("worst")), "worst-stretches").df
    telling.remove()
    release(texts.sparkSession)
    return out


def postings(texts: DataFrame, shards: int) -> DataFrame:
    """N-gram frequencies of blocks of documents of one language, by shard."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            for rid, doc, lang, text in zip(batch["rid"], batch["doc_id"], batch["lang"], batch["text"], strict=True):
                codes, counts = np.unique(codes_of(text), return_counts=True)
                held.setdefault(lang, []).append((rid, doc, codes, counts))
                size += len(text)
                if size >= BLOCK_CHARS or len(held[lang]) >= BLOCK_DOCS:
                    yield from map(block_rows, held.items())
                    held, size = {}, 0
        yield from map(block_rows, held.items())

    def block_rows(item: tuple[str, list]) -> pd.DataFrame:
        lang, rows = item
        block = int(rows[0][0])
        ids = "\n".join("" if r[1] is None else r[1] for r in rows).encode()
        rids = np.array([r[0] for r in rows], dtype=np.int64)
        totals = np.array([r[3].sum() for r in rows], dtype=np.int64)
        out = [(lang, block % shards, block, HEADER, pack(ids, rids, totals))]
        docs = np.repeat(np.arange(len(rows), dtype=np.uint16), [len(r[2]) for r in rows])
        codes, terms = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
        counts = np.concatenate([r[3] for r in rows]).astype(np.uint32)
        if len(codes):
            for shard, own, per_term, d, c in by_bucket(shard_numbers(codes, shards), terms, docs, counts):
                out.append((lang, shard, block, POSTINGS, pack(codes[own], per_term.astype(np.uint32), d, c)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in PACKED.split(", ")])

    return texts.mapInPandas(gather, PACKED)


def scored(rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    """Sums over one shard of the model, for the documents of each block."""
    model = model.sort_values("code")
    known, surprise, evidence = (model[c].to_numpy(np.int64) for c in ("code", "surprise", "evidence"))
    out = []
    for lang, shard, block, kind, data in rows.itertuples(index=False):
        if kind == HEADER:
            out.append((lang, shard, block, kind, data))
        elif len(known):
            codes, per_term, d, c = unpack(data, "i8", "u4", "u2", "u4")
            at = np.repeat(np.searchsorted(known, codes), per_term)
            sums = [np.bincount(d, weights=v[at] * c.astype(np.int64)).astype(np.int64) for v in (surprise, evidence)]
            out.append((lang, shard, block, SUMS, pack(*sums)))
    return pd.DataFrame(out, columns=[c.split()[0] for c in PACKED.split(", ")])


def summed(group: pd.DataFrame) -> pd.DataFrame:
    header = group[group["kind"] == HEADER].iloc[0]
    ids, rids, totals = unpack(header["data"], "", "i8", "i8")
    surprise, evidence = np.zeros(len(rids), np.int64), np.zeros(len(rids), np.int64)
    parts = group["data"][group["kind"] == SUMS]
    for data in parts:
        s, e = unpack(data, "i8", "i8")
        surprise[: len(s)] += s
        evidence[: len(e)] += e
    return pd.DataFrame({
        "rid": rids, "doc_id": ids.decode().split("\n"), "lang": header["lang"], "n_grams": totals,
        "known": len(parts) > 0, "surprise": surprise, "evidence": evidence,
    })


SCORES = "rid long, doc_id string, lang string, n_grams long, known boolean, surprise long, evidence long"


def document_scores(
    docs: DataFrame,
    labels: DataFrame,
    shards: int = 32,
    broadcast_bytes: int = BROADCAST_BYTES,
    row: str | None = None,
) -> DataFrame:
    """rid, doc_id, lang, n_grams, perplexity, toxicity, worst and kind (of label) of each row; stored.

    There are ``shards`` of a language's model, and more for one of many n-grams. ``row`` is the
    column that numbers the rows; without one they are numbered here.
    """
    spark = docs.sparkSession
    if row is None:
        row = free_name(docs, "row")
        docs = numbered(docs, row)
    classes = measured(Stored(label_classes(labels), "label-classes").df, 40, broadcast_bytes)
    texts = keyed(docs, row)
    known = texts.join(classes, texts["doc_id"] == F.col("label_id").cast("string"))
    worst = worst_stretches(texts, known, classes, broadcast_bytes)
    counts = tallied(known, "kind lang").groupBy("kind", "lang", "code").agg(F.sum("n").alias("n"))
    both = known.where(F.col("text").rlike(r"\S")).groupBy("lang").agg(F.count_distinct("kind").alias("kinds")).where("kinds = 2")
    thin = Stored(texts.select("lang").distinct().join(both, "lang", "left_anti"), "thin-languages")
    borrows = not thin.df.isEmpty()
    if borrows:
        stored = Stored(counts, "counts")
        every = stored.df.groupBy("kind", F.lit(EVERY).alias("lang"), "code").agg(F.sum("n").alias("n"))
        counts = stored.df.unionByName(every)
    model = KneserNey(counts)
    release(spark)
    codes = Stored(tallied(texts, "lang").select("lang", "code").distinct(), "codes")
    most = codes.df.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    shards = max(shards, -(-most // SHARD_CODES))
    lent = codes.df.join(thin.df, "lang")
    asked = codes.df.unionByName(lent.select(F.lit(EVERY).alias("lang"), "code").distinct()) if borrows else codes.df
    p = model.probabilities(asked).select("kind", "lang", "code", F.log("p").alias("log"), F.lit(False).alias("wide"))
    if borrows:
        logs = Stored(p, "logs")
        wide = logs.df.where(F.col("lang") == EVERY).select("kind", "code", "log").join(lent, "code")
        p = logs.df.where(F.col("lang") != EVERY).unionByName(wide.withColumn("wide", F.lit(True)))
    of = lambda kind, wide: F.max(F.when((F.col("kind") == kind) & (F.col("wide") == wide), F.col("log")))
    by_kind = p.groupBy("lang", "code").agg(
        of("trusted", False).alias("own"), of("toxic", False).alias("own_toxic"), of("trusted", True).alias("wide"), of("toxic", True).alias("wide_toxic")
    )
    # Both sides of the evidence come from the same languages.
    by_kind = by_kind.select(
        "lang", "code", F.coalesce("own", "wide").alias("trusted"),
        F.coalesce(F.col("own_toxic") - F.col("own"), F.col("wide_toxic") - F.col("wide")).alias("apart"),
    ).where("trusted IS NOT NULL")
    more = F.greatest(F.coalesce("apart", F.lit(-1e9)) - EVIDENCE, F.lit(0.0))
    values = Stored(
        by_kind.select(
            "lang",
            shard_column(F.col("code"), shards).alias("shard"),
            "code",
            F.round(-F.col("trusted") * UNIT).cast("long").alias("surprise"),
            F.round(more * UNIT).cast("long").alias("evidence"),
        ),
        "model",
    )
    model.remove()
    codes.remove()
    thin.remove()
    if borrows:
        stored.remove()
        logs.remove()
    release(spark)

    n_parts = max(1, -(-docs.rdd.getNumPartitions() // GROUP_TASKS))  # a plan's number of scan tasks, no job
    rows = postings(texts, shards).withColumn("part", F.pmod(F.xxhash64("block"), F.lit(n_parts)).cast("long"))
    copies = values.df.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))))

    def score(r: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        return scored(r.drop(columns="part"), m)

    keys = ["lang", "shard", "part"]
    sums = rows.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInPandas(score, PACKED)
    whole = sums.groupBy("block").applyInPandas(summed, SCORES)
    per = F.col("n_grams")
    usable = F.col("known") & (per > 0)
    scores = whole.select(
        "rid",
        F.nullif("doc_id", F.lit("")).cast("long").alias("doc_id"),
        "lang",
        "n_grams",
        F.when(usable, F.exp(F.col("surprise") / (per * UNIT))).alias("perplexity"),
        F.when(usable, F.col("evidence") * 1000 / (per * UNIT)).alias("toxicity"),
    )
    labelled = scores.join(classes, scores["doc_id"] == F.col("label_id"), "left").drop("label_id")
    labelled = labelled.join(measured(worst, 16, broadcast_bytes), "rid", "left").withColumn("worst", F.coalesce("worst", F.lit(0.0)))
    out = Stored(labelled, "quality-scores").df
    values.remove()
    release(spark)
    return out


def quantile(scores: DataFrame, value: str, share: float, name: str) -> DataFrame:
    """The quantile of a positive value by language, to one bin above, from a histogram."""
    floor = F.greatest(F.col(value), F.lit(1e-3))
    bins = scores.where(F.col(value).isNotNull()).groupBy("lang", F.ceil(F.log(floor) * BINS).alias("bin")).count()
    # A window over bins, of which there are a few thousand, not over documents.
    up_to = Window.partitionBy("lang").orderBy("bin")
    whole = Window.partitionBy("lang")
    reached = F.sum("count").over(up_to) >= share * F.sum("count").over(whole)
    least = bins.select("lang", "bin", reached.alias("reached")).where("reached").groupBy("lang").agg(F.min("bin").alias("bin"))
    return least.select("lang", F.exp(F.col("bin") / BINS).alias(name))


def everywhere(scores: DataFrame, value: str, share: float) -> Column:
    """The quantile over all languages; null if there are no rows."""
    row = quantile(scores.withColumn("lang", F.lit(EVERY)), value, share, "limit").first()
    return F.lit(row["limit"] if row else None).cast("double")


def quality(
    docs: DataFrame,
    labels: DataFrame,
    trusted_share: float = 0.995,
    margin: float = 1.5,
    toxic_share: float = 0.02,
    toxic_part: float = 0.5,
    **parameters,
) -> DataFrame:
    """Scores of each row and whether it is rejected.

    The limits of a language are ``margin`` times the ``trusted_share`` quantiles of its trusted
    documents. The toxicity limit is at least ``toxic_part`` of the ``toxic_share`` quantile of
    its toxic documents; without any in all languages, none is rejected by its n-grams as toxic. The
    limit of the worst stretch is the ``trusted_share`` quantile itself.
    """
    scores = document_scores(docs, labels, **parameters)
    trusted = scores.where("kind = 'trusted'")
    usable = scores.where("perplexity IS NOT NULL")
    limits = scores.join(quantile(scores, "perplexity", 0.5, "middle"), "lang", "left")
    # A language's level shows in all its documents; how far trusted ones exceed it, in all languages.
    far = trusted.join(quantile(usable, "perplexity", 0.5, "middle"), "lang").withColumn("far", F.col("perplexity") / F.col("middle"))
    toxic = scores.where("kind = 'toxic'")
    for rows, value, share_of, name, wide in (
        (trusted, "perplexity", trusted_share, "high", F.col("middle") * everywhere(far, "far", trusted_share)),
        (trusted, "toxicity", trusted_share, "usual", everywhere(trusted, "toxicity", trusted_share)),
        (toxic, "toxicity", toxic_share, "toxic_from", everywhere(toxic, "toxicity", toxic_share)),
        (trusted, "worst", trusted_share, "stretch", everywhere(trusted, "worst", trusted_share)),
    ):
        own = quantile(rows, value, share_of, "own").join(rows.groupBy("lang").agg(F.count(value).alias("n")), "lang")
        mixed = (F.col("n") * F.log("own") + THIN * F.log(wide)) / (F.col("n") + THIN)
        limits = limits.join(own, "lang", "left").withColumn(name, F.coalesce(F.exp(mixed), wide)).drop("own", "n")
    is_toxic = F.col("toxicity") >= F.greatest(F.col("usual") * margin, F.col("toxic_from") * toxic_part)
    bad = (F.col("perplexity") > F.col("high") * margin) | (F.col("toxic_from").isNotNull() & is_toxic)
    # Without trusted documents anywhere there is no limit.
    above = F.col("stretch").isNotNull() & (F.col("worst") > F.greatest("stretch", F.lit(LEAST_WORST)))
    bad = F.coalesce(bad, F.lit(False)) | above
    return limits.select(
        "rid", "doc_id", "lang", "n_grams", "perplexity", "toxicity", F.coalesce(bad, F.lit(False)).alias("rejected")
    )


def quality_report(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    return quality(docs, labels, **parameters).select(
        "doc_id", "lang", "n_grams", F.round("perplexity", 3).alias("perplexity"), F.round("toxicity", 3).alias("toxicity"), "rejected"
    )


def keep_good(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The documents that are not rejected."""
    row = free_name(docs, "row")
    rows = numbered(docs, row)
    rejected = quality(rows, labels, row=row, **parameters).where("rejected").select(F.col("rid").alias(row))
    return rows.join(
        measured(Stored(rejected, "rejected").df, 24), row, "left_anti"
    ).select(*docs.columns)
