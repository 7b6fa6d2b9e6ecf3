"""Physical plans: what reaches the scan, what is shuffled, and what never is."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tarnhouse.catalogue import model as m
from tarnhouse.catalogue.all_queries import QUERIES
from tarnhouse.operators.ranking import surrogate_key, top_n_ties
from tarnhouse.operators.upsert import merged_rows

from .conftest import plan


def read_schemas(text):
    return re.findall(r"ReadSchema: struct<([^>]*)", text)


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["filter_year"](spark, sf).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in text
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in text
    assert "o_totalprice" not in text


def test_report_reads_only_its_columns(spark, sf):
    text = plan(QUERIES["sales_by_year"](spark, sf))
    assert any(s.startswith("l_orderkey:bigint,l_quantity:double") and s.count(":") == 2 for s in read_schemas(text))
    assert any(s.startswith("o_orderkey:bigint,o_orderdate") and s.count(":") == 2 for s in read_schemas(text))


def test_calendar_is_broadcast(spark, sf):
    text = plan(QUERIES["join_left_dim"](spark, sf))
    assert re.search(r"BroadcastHashJoin \[DateKey.*LeftOuter", text)


def test_lines_are_summed_before_their_shuffle(spark, sf):
    text = plan(QUERIES["sales_by_year"](spark, sf))
    assert re.search(r"Exchange hashpartitioning\(OrderID[^\n]*\n[^\n]*partial_sum", text)


def test_keys_need_no_second_shuffle(spark, sf):
    text = plan(surrogate_key(m.table(spark, sf, "orders"), ["o_orderkey"], "key"))
    assert "Window" not in text and "Exchange hashpartitioning" not in text
    assert "Exchange SinglePartition" not in text


def test_top_n_is_a_filter(spark, sf):
    text = plan(top_n_ties(m.table(spark, sf, "orders"), 5, ("o_orderdate", True)))
    assert "Exchange" not in text and "LessThan(o_orderdate" in text


def test_small_increment_does_not_shuffle_the_target(spark, sf, tmp_path):
    orders = m.table(spark, sf, "orders")
    path = str(tmp_path / "increment")
    orders.filter("o_orderkey < 10").write.parquet(path)
    text = plan(merged_rows(orders, spark.read.parquet(path), ["o_orderkey"]))
    updates = text.split("LeftAnti")[0]
    assert "BroadcastHashJoin" in updates and "SortMergeJoin" not in updates
    assert "hashpartitioning" not in updates


def test_partition_filter_prunes_folders(spark, tmp_path):
    from tarnhouse.sources.files import write_partitioned

    path = str(tmp_path / "p")
    write_partitioned(spark.range(100).withColumn("y", F.col("id") % 4), path, "y")
    stored = spark.read.parquet(path).filter("y = 2")
    assert "PartitionFilters: [isnotnull(y" in plan(stored)
    assert stored.count() == 25
