"""Row numbers that hold however the files are cut, and the shards of the quality model."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from tarnhouse.llm import common, quality
from tarnhouse.llm.common import Stored, are_whole_files, numbered
from tarnhouse.llm.decontamination import contamination_report, decontaminate
from tarnhouse.llm.line_dedup import dedup_lines, line_report
from tarnhouse.llm.near_dedup import keep_first, near_report
from tarnhouse.llm.quality import document_scores, keep_good
from tarnhouse.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import ROWS, by_row

LABELS = "doc_id long, quality long, toxic long"


def test_sql_is_text_for_known_queries():
    assert set(ORACLE) <= set(QUERIES) and all(isinstance(sql, str) for sql in ORACLE.values())


@pytest.fixture()
def new_split(spark, monkeypatch):
    """Files are cut anew after each stored step."""
    name = "spark.sql.files.maxPartitionBytes"
    before, sizes = spark.conf.get(name), itertools.cycle(["300b", "10mb", "1kb"])
    kept = Stored.__init__

    def then_cut(self, *args, **kwargs):
        kept(self, *args, **kwargs)
        spark.conf.set(name, next(sizes))

    yield lambda: monkeypatch.setattr(common.Stored, "__init__", then_cut)
    spark.conf.set(name, before)


@pytest.fixture(scope="module")
def long_docs(spark, tmp_path_factory):
    """Files of several row groups, so that a task may get a part of a file."""
    path = str(tmp_path_factory.mktemp("long") / "documents")
    rows = [(k, *r[1:]) for k, r in enumerate(ROWS * 2)]
    names = "doc_id long, text string, lang string, source string, n_chars long, rid long, row string, block string"
    df = spark.createDataFrame(rows, names).repartition(2, F.xxhash64("doc_id"))
    df.write.option("parquet.block.size", 4096).option("parquet.page.size", 512).parquet(path)
    return spark.read.parquet(path)


def test_numbers_are_unique_and_stay(spark, long_docs, new_split):
    n = numbered(long_docs, "n")
    first = by_row(n, "n", "doc_id")
    assert n.select("n").distinct().count() == long_docs.count() and n.where("n < 0").isEmpty()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    assert n.rdd.getNumPartitions() > 4
    assert by_row(n, "n", "doc_id") == first


def test_files_that_hash_alike_are_told_apart(long_docs, monkeypatch):
    """Without a hash that tells files apart, numbered rows are stored."""
    monkeypatch.setattr(common.F, "xxhash64", lambda *_: F.lit(5).cast("long"))
    n = numbered(long_docs, "n")
    monkeypatch.undo()
    assert n.select("n").distinct().count() == long_docs.count()


def test_rows_not_of_files_are_stored(spark, long_docs):
    assert are_whole_files(long_docs)
    twice = long_docs.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    named = long_docs.withColumn("_metadata", F.lit(1))
    for df in (twice, named, long_docs.unionAll(long_docs), long_docs.where("doc_id > 3"), spark.range(9)):
        assert not are_whole_files(df)
        n = numbered(df, "n")
        assert n.select("n").distinct().count() == df.count() and n.columns == [*df.columns, "n"]


@pytest.mark.parametrize("from_files", [True, False])
def test_a_new_split_between_steps_changes_nothing(spark, long_docs, new_split, from_files):
    texts = [t for t in (r[1] for r in ROWS) if t and len(t.split()) > 25]
    items = spark.createDataFrame([(k, texts[k]) for k in range(5)], "item_id long, text string")
    labels = spark.createDataFrame([(k, k % 3, int(k % 5 == 0)) for k in range(0, 80, 2)], LABELS)
    df = long_docs if from_files else long_docs.repartition(5)
    steps = {
        "lines": lambda: dedup_lines(df, min_sites=3, drop_empty=True),
        "line report": lambda: line_report(df, min_sites=3),
        "near": lambda: keep_first(df, percent=80),
        "near report": lambda: near_report(df),
        "benchmark": lambda: decontaminate(df, items),
        "spans": lambda: decontaminate(df, items, remove="spans"),
        "benchmark report": lambda: contamination_report(df, items),
        "quality": lambda: keep_good(df, labels),
    }
    if not from_files:
        steps = {name: steps[name] for name in ("lines", "benchmark")}
    want = {name: by_row(step(), "*") for name, step in steps.items()}
    assert 0 < len(want["benchmark"]) < df.count()
    new_split()
    for name, step in steps.items():
        assert by_row(step(), "*") == want[name], name


def test_more_shards_for_more_n_grams(spark, long_docs, monkeypatch):
    labels = spark.createDataFrame([(k, 1 + k % 2, int(k % 5 == 0)) for k in range(0, 80, 2)], LABELS)
    want = by_row(document_scores(long_docs, labels, shards=2), "*")
    monkeypatch.setattr(quality, "SHARD_CODES", 100)
    assert by_row(document_scores(long_docs, labels, shards=2), "*") == want
