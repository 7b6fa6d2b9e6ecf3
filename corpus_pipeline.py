"""From raw documents to encoded ones: quality, lines, near duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnhouse.llm.chunks import encoding_report
from tarnhouse.llm.common import Stored, table
from tarnhouse.llm.decontamination import decontaminate
from tarnhouse.llm.line_dedup import dedup_lines
from tarnhouse.llm.near_dedup import keep_first
from tarnhouse.llm.quality import keep_good


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of lines that many sites share; emptied documents go."""
    return dedup_lines(docs, drop_empty=True)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by shingles of five words, similarity 0.8."""
    return keep_first(docs, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the remaining documents."""
    return encoding_report(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_boilerplate),
    ("near dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("BPE encoding", encoded),
]

# SQL can express neither the language model nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = Stored(docs, name.replace(" ", "-")).df
    return docs
