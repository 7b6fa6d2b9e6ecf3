"""Operator 3, line dedup by distinct-site spread, in DataFrame functions only.

For every distinct line a HyperLogLog sketch of the sites that hold it is built and merged by
aggregation. Lines whose estimate is clearly above the threshold are boilerplate, lines near it
are counted exactly, and all others stay. A boilerplate line is removed everywhere but where it
stands first (smallest doc_id, then row, then line), so that a page that many sites copied keeps
one whole copy.

Lines are compared without blanks at their ends, by a 128-bit hash; blank lines always stay. A
null text stays null and has no lines; a null site is a site of its own. Rows are documents one
by one, also repeated ones and those with a null id, which come last. An empty table gives an
empty result. Columns keep their names and order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.common import Stored, free_name, measured, numbered

# Estimates this far from the threshold, as a share of it, are decided without an exact count:
# over ten standard errors of the sketch.
BAND = 0.25
SKETCH_BITS = 12


def lines_of(docs: DataFrame, row: str, site: str) -> DataFrame:
    """rid, doc_id, site, at, and the two halves of the hash of each line that is not blank."""
    keyed = docs.select(
        F.col(row).alias("rid"), "doc_id", F.col(site).alias("site"), "text"
    )
    lines = keyed.select("rid", "doc_id", "site", F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    line = F.btrim("raw", F.lit(" \t\r"))
    return lines.select("rid", "doc_id", "site", "at", line.alias("line")).where("line <> ''").select(
        "rid", "doc_id", "at",
        F.coalesce(F.concat(F.lit("s"), F.col("site").cast("string")), F.lit("none")).alias("site"),
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
    )


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """Hashes of lines on at least ``min_sites`` sites, and where each stands first."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid", "at")
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"), F.min(place).alias("first")
    )
    # Lines certainly below the threshold end here, which are nearly all.
    wide = Stored(spread.where(F.col("sites") >= min_sites * (1 - BAND)), "line-spread").df
    clear = wide.where(F.col("sites") > min_sites * (1 + BAND))
    near = wide.where(F.col("sites") <= min_sites * (1 + BAND))
    exact = (
        lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .select("h1", "h2", "site")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("exact_sites"))
        .where(F.col("exact_sites") >= min_sites)
    )
    return clear.select("h1", "h2", "first").unionByName(
        near.join(exact, ["h1", "h2"], "left_semi").select("h1", "h2", "first")
    )


def removed_lines(docs: DataFrame, row: str, min_sites: int, site: str) -> DataFrame:
    """Per row with removals: its number and the places of its removed lines."""
    lines = lines_of(docs, row, site)
    found = lines.join(boilerplate(lines, min_sites), ["h1", "h2"])
    later = (F.col("rid") != F.col("first.rid")) | (F.col("at") != F.col("first.at"))
    return found.where(later).groupBy(F.col("rid").alias("line_rid")).agg(F.collect_list("at").alias("removed_at"))


def kept_text(text: Column, removed: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(removed, i))
    return F.when(removed.isNull(), text).otherwise(F.array_join(lines, "\n"))


def dedup_lines(docs: DataFrame, min_sites: int = 8, site: str = "source", drop_empty: bool = False) -> DataFrame:
    """The documents without later copies of boilerplate lines.

    ``drop_empty`` drops documents that lost lines and have nothing but blanks left.
    """
    joined, removed = with_removals(docs, min_sites, site)
    if drop_empty:
        left = F.btrim(kept_text(F.col("text"), removed), F.lit(" \t\r\n"))
        joined = joined.where(removed.isNull() | (left != ""))
    text = kept_text(F.col("text"), removed)
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])


def with_removals(docs: DataFrame, min_sites: int, site: str) -> tuple[DataFrame, Column]:
    """The documents with the column of their removed lines."""
    row, places = free_name(docs, "row"), free_name(docs, "removed_at")
    rows = numbered(docs, row)
    removed = removed_lines(rows, row, min_sites, site).select(
        F.col("line_rid").alias(row), F.col("removed_at").alias(places)
    )
    removed = measured(Stored(removed, "removed-lines").df, 40 + 4 * F.size(places))
    return rows.join(removed, row, "left"), F.col(places)


def line_report(docs: DataFrame, min_sites: int = 8, site: str = "source") -> DataFrame:
    """Per document the numbers of lines and of removed ones, and a digest of the rest."""
    joined, removed = with_removals(docs, min_sites, site)
    text = F.coalesce("text", F.lit(""))
    return joined.select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(removed), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(kept_text(text, removed), 256).alias("kept_sha256"),
    )


LINE_SQL = """
WITH line AS (
  SELECT doc_id, source, pos, trim(lines[pos], ' ' || chr(9) || chr(13)) AS line, lines[pos] AS raw
  FROM (SELECT doc_id, source, lines, unnest(range(1, len(lines) + 1)) AS pos
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents))),
spread AS (
  SELECT line, count(DISTINCT coalesce('s' || source, '')) AS sites, min((doc_id, pos)) AS first
  FROM line WHERE line <> '' GROUP BY line HAVING sites >= 8),
marked AS (
  SELECT doc_id, pos, raw, spread.line IS NOT NULL AND (doc_id, pos) <> first AS gone
  FROM line LEFT JOIN spread USING (line)),
per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN per_doc USING (doc_id)
"""
