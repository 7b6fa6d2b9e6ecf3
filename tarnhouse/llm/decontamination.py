"""Operator 2, benchmark decontamination, in DataFrame functions only.

The benchmark's word windows form a table of distinct n-grams. Its size is measured, and up to
``broadcast_bytes`` it is sent to every task as a hash table; beyond that the same join shuffles.
Documents are cut into token windows as they are scanned, and each window looks itself up. The
lookup compares the whole n-gram, so a hit needs no second check. A row without window stands for
the document itself, so that the texts are scanned once.

A null text has no words. Rows are documents one by one, also repeated ones and those with a null
id; other columns are not read; an empty table gives an empty result. Items without words have no
window. Windows of an item with a null id hit, but the item is not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.common import BROADCAST_BYTES, Stored, ascii_lower, free_name, measured, numbered

# What separates words, once A-Z are lower-case. Fixed value.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Long documents are cut into stretches of so many window starts.
STRETCH = 4096


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), SEPARATORS), "")


def gram(words: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def windows_from(words: Column, length: int, starts: int) -> Column:
    """The n-grams at the first ``starts`` places, with the number of words before each."""
    last = F.least(F.size(words) - (length - 1), F.lit(starts))
    found = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct((i - 1).alias("at"), F.lit(length).alias("length"), gram(words, i, length).alias("gram")),
    )
    return F.when(last >= 1, found).otherwise(F.array().cast("array<struct<at:int,length:int,gram:string>>"))


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct windows of the items: gram, length, and the ids of the items that hold it."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(size))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1))
    grams = items.withColumn("length", length).select("item_id", "words", "length", starts.alias("start"))
    grams = grams.select(
        "item_id", "length", F.array_join(F.slice("words", F.col("start"), F.col("length")), " ").alias("gram")
    )
    return grams.groupBy("gram", "length").agg(F.collect_set("item_id").alias("items"))


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    broadcast_bytes: int = BROADCAST_BYTES,
    row: str | None = None,
) -> DataFrame:
    """Per row: rid, doc_id, n_words, hits (at, length) in order of words, and the items they are from.

    ``row`` is the column that numbers the rows; without one they are numbered here.
    """
    if row is None:
        row = free_name(docs, "row")
        docs = numbered(docs, row)
    known = Stored(benchmark_windows(benchmark, size), "benchmark-windows").df
    lengths = sorted(r["length"] for r in known.select("length").distinct().collect())  # at most ``size`` rows
    header = F.struct(F.lit(-1).alias("at"), F.lit(0).alias("length"), F.lit("").alias("gram"))
    words = F.col("words")
    split = docs.select(
        F.col(row).alias("rid"), "doc_id", words_of(F.col("text")).alias("words")
    ).withColumn("n_words", F.size(words).cast("long"))
    overlap = max(lengths, default=1) - 1
    begins = F.explode(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(STRETCH)))
    stretches = split.select("rid", "doc_id", "n_words", words, begins.alias("begin")).select(
        "rid", "doc_id", "n_words", "begin", F.slice(words, F.col("begin") + 1, STRETCH + overlap).alias("words")
    )
    found = [windows_from(words, n, STRETCH) for n in lengths]
    rows = stretches.select("rid", "doc_id", "n_words", "begin", F.inline(F.concat(F.array(header), *found)))
    no_items = F.array().cast(known.schema["items"].dataType)
    lookup = known.select("gram", "items").unionByName(
        known.sparkSession.range(1).select(F.lit("").alias("gram"), no_items.alias("items"))
    )
    lookup = measured(lookup, F.octet_length("gram") + 64 + 8 * F.size("items"), broadcast_bytes)
    hits = rows.join(lookup, "gram")
    own = F.when(F.col("at") >= 0, F.struct((F.col("begin") + F.col("at")).alias("at"), "length"))
    return hits.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_list(own)).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )


def covered(hits: Column) -> Column:
    """Number of words inside at least one of the hits, which come in order."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(state: Column, hit: Column) -> Column:
        end = hit["at"] + hit["length"]
        fresh = F.greatest(end - F.greatest(state["end"], hit["at"]), F.lit(0))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + fresh).alias("n"))

    return F.aggregate(hits, start, add, lambda state: state["n"])


def contamination_report(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    found = benchmark_hits(docs, benchmark, **parameters).withColumn("n_hit", covered(F.col("hits")))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **parameters) -> DataFrame:
    """The documents without benchmark passages, in their own columns.

    ``remove`` is "documents", which drops every document with a hit, or "spans", which drops
    the words inside hits, each with the separators behind it, and keeps all rows.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove documents or spans, not {remove}")
    row, words = free_name(docs, "row"), free_name(docs, "hit_words")
    rows = numbered(docs, row)
    hits = benchmark_hits(rows, benchmark, row=row, **parameters).where(F.size("hits") > 0)
    hits = Stored(hits.select(F.col("rid").alias(row), F.col("hits").alias(words)), "benchmark-hits").df
    hits = measured(hits, 40 + 8 * F.size(words))
    if remove == "documents":
        return rows.join(hits, row, "left_anti").select(*docs.columns)
    joined = rows.join(hits, row, "left")
    text = F.when(F.col(words).isNull(), F.col("text")).otherwise(without_words(F.col("text"), F.col(words)))
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])


def without_words(text: Column, hits: Column) -> Column:
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    words = F.regexp_extract_all(text, F.lit(word), F.lit(0))
    between = F.split(text, word)
    kept = F.transform(
        words,
        lambda w, i: F.when(
            F.exists(hits, lambda h: (i >= h["at"]) & (i < h["at"] + h["length"])), F.lit("")
        ).otherwise(F.concat(w, F.get(between, i + 1))),
    )
    return F.concat(F.get(between, F.lit(0)), F.array_join(kept, ""))


CONTAMINATION_SQL = r"""
WITH item AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
known AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n,
    array_to_string(list_slice(words, i, i + least(len(words), 10) - 1), ' ') AS gram
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
        FROM item WHERE len(words) > 0)),
doc AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(words, i, i + n - 1), ' ') AS gram
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM doc CROSS JOIN (SELECT DISTINCT n FROM known) WHERE len(words) >= n)),
hit AS (SELECT doc_id, item_id, i, places.n FROM places JOIN known ON places.gram = known.gram AND places.n = known.n),
word AS (SELECT doc_id, count(DISTINCT w) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""
