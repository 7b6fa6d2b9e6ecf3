"""Tables in months: what an increment replaces, and what it leaves alone."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnhouse.operators.upsert import create_or_upsert, merged_rows, update_then_insert, upsert
from tarnhouse.plans import loads
from tarnhouse.session import child_names, scratch_path
from tarnhouse.sources.monthly import NO_MONTH, MonthlyTable

from .conftest import plan, rows

SCHEMA = "k int, v string, day date, at timestamp_ntz"


def table(spark, mark="at"):
    return MonthlyTable(spark, scratch_path(spark, "months"), SCHEMA, "day", ("k",), mark)


def row(k, v, month, day=1, at=1):
    return (k, v, date(2024, month, day) if month else None, datetime(2024, 1, at))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def files(t):
    return {m: sorted(n for n in child_names(t.spark, f"{t.path}/_month={m}") if n.startswith("part")) for m in t.months()}


def content(t):
    return rows(t.read().select("k", "v", F.month("day")))


def test_only_touched_months_are_replaced(spark, broadcast_limit):
    t = table(spark)
    assert t.create(frame(spark, *[row(k, "a", k) for k in range(1, 7)], row(None, "n", None))) == 7
    before = files(t)
    assert t.months() == [NO_MONTH, 202401, 202402, 202403, 202404, 202405, 202406]
    done = upsert(t, frame(spark, row(2, "b", 2, at=9), row(9, "new", 8)))
    assert (done.rows, done.inserted, done.updated, done.max_mark) == (2, 1, 1, datetime(2024, 1, 9))
    after = files(t)
    assert {m for m in before if before[m] == after[m]} == {NO_MONTH, 202401, 202403, 202404, 202405, 202406}
    assert content(t) == [(1, "a", 1), (2, "b", 2), (3, "a", 3), (4, "a", 4), (5, "a", 5), (6, "a", 6), (9, "new", 8), (None, "n", None)]


def test_a_row_that_changes_month_leaves_the_old_one(spark, broadcast_limit):
    t = table(spark)
    t.create(frame(spark, row(1, "a", 1), row(2, "a", 1), row(3, "a", 2), row(4, "a", 3)))
    before = files(t)
    upsert(t, frame(spark, row(1, "b", 3), row(3, "b", 4)))
    assert content(t) == [(1, "b", 3), (2, "a", 1), (3, "b", 4), (4, "a", 3)]
    assert t.months() == [202401, 202403, 202404]  # nothing is left of February
    upsert(t, frame(spark, row(4, "c", None), row(1, "c", None)))
    assert content(t) == [(1, "c", None), (2, "a", 1), (3, "b", 4), (4, "c", None)]
    assert t.months() == [NO_MONTH, 202401, 202404]
    assert before.keys() == {202401, 202402, 202403}


def test_source_duplicates_fail_only_when_they_match_and_change_nothing(spark):
    t = table(spark)
    t.create(frame(spark, row(1, "a", 1)))
    assert upsert(t, frame(spark, row(2, "x", 1), row(2, "y", 1), row(None, "n", 1), row(None, "n", 1))).inserted == 4
    before = files(t)
    with pytest.raises(ValueError, match="same target row"):
        upsert(t, frame(spark, row(1, "x", 2), row(1, "y", 3)))
    assert files(t) == before and len(content(t)) == 5


def test_an_empty_increment_changes_nothing(spark):
    t = table(spark)
    t.create(frame(spark, row(1, "a", 1)))
    before = files(t)
    assert upsert(t, frame(spark)).rows == 0 and files(t) == before
    with pytest.raises(FileNotFoundError):
        upsert(table(spark), frame(spark))


def test_a_table_without_rows(spark):
    t = table(spark)
    assert not t.exists() and t.max_mark() is None
    assert t.create(frame(spark)) == 0
    assert t.exists() and t.read().collect() == [] and t.read().columns == ["k", "v", "day", "at"]
    assert t.max_mark() is None and t.row_count() == 0
    with pytest.raises(FileExistsError):
        t.create(frame(spark))
    assert create_or_upsert(t, frame(spark, row(1, "a", 1))).inserted == 1
    assert t.truncate_load(frame(spark, row(2, "b", 2))) == 1 and content(t) == [(2, "b", 2)]


def test_many_appends_leave_one_folder_to_read(spark):
    t = table(spark)
    t.create(frame(spark, row(0, "a", 1)))
    for k in range(1, 12):
        before = files(t)
        assert t.append(frame(spark, row(k, "a", 1 + k % 2))) == 1
        assert all(set(before[m]) <= set(files(t)[m]) for m in before)
    assert t.row_count() == 12 and t.months() == [202401, 202402]
    text = plan(t.read())
    assert "InMemoryFileIndex(1 paths)" in text


def test_dates_prune_months(spark):
    t = table(spark)
    t.create(frame(spark, *[row(k, "a", k, 15) for k in range(1, 10)], row(0, "a", None)))
    some = t.read(date(2024, 2, 16), date(2024, 5, 15))
    assert "PartitionFilters: [isnotnull(_month" in plan(some)
    assert rows(some.select("k")) == [(3,), (4,)]
    assert rows(t.read(start="2024-09-15").select("k")) == [(9,)]
    assert rows(t.read(end=date(2024, 1, 16)).select("k")) == [(1,)]
    by_date = MonthlyTable(spark, t.path, SCHEMA, "day", ("k",), "day")
    assert by_date.max_mark() == datetime(2024, 9, 15)


def test_loads_go_into_months(spark):
    t = table(spark)
    staging = scratch_path(spark, "files")
    data = frame(spark, row(1, "a", 1, at=1), row(2, "b", 2, at=3), row(3, "c", 3, at=9))
    first = loads.load_incremental(data, t, staging, datetime(2024, 1, 1), datetime(2024, 1, 8))
    assert (first.rows_read, first.inserted, first.max_mark) == (2, 2, datetime(2024, 1, 3))
    before = files(t)
    done = update_then_insert(t, data)  # from the newest mark on, which is inside
    assert (done.inserted, done.updated, done.max_mark) == (1, 1, datetime(2024, 1, 9))
    assert files(t)[202401] == before[202401] and files(t)[202402] != before[202402]
    assert loads.load_full(data, t, datetime(2024, 1, 3)).rows_copied == 2 and t.months() == [202402, 202403]


dated = st.dictionaries(st.integers(0, 9), st.tuples(st.sampled_from("abc"), st.integers(0, 4)), max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(dated, dated)
def test_upsert_into_months_equals_a_dictionary(spark, old, new):
    t = table(spark)
    t.create(frame(spark, *[row(k, v, m) for k, (v, m) in old.items()]))
    for _ in range(2):
        upsert(t, frame(spark, *[row(k, v, m) for k, (v, m) in new.items()]))
        assert {r[0]: (r[1], r[2] or 0) for r in t.read().select("k", "v", F.month("day")).collect()} == {**old, **new}
        held = {202400 + m if m else NO_MONTH for _, m in {**old, **new}.values()}
        assert set(t.months()) == held


def test_a_large_source_reads_and_shuffles_the_target_once(spark, sf, tmp_path):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    path = str(tmp_path / "increment")
    orders.filter("o_orderkey % 2 = 0").write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merged_rows(orders, spark.read.parquet(path), ["o_orderkey"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("FileScan parquet") == 2 and text.count("Exchange hashpartitioning") == 2
    assert "FullOuter" in text and "Window" not in text


def test_null_keys_are_spread(spark, tmp_path):
    """Rows with a null key match nothing and do not all go to one task."""
    target = spark.range(4000).selectExpr("if(id % 40 = 0, id, null) k", "id v")
    source = spark.range(1000).selectExpr("if(id < 900, null, id) k", "-id v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        merged = merged_rows(target, source, ["k"])
        assert merged.count() == 4998 and merged.filter("_change = 'update'").count() == 2  # 920 and 960
        assert "_spread" in plan(merged)
        sizes = [r["n"] for r in merged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) > 1 and max(sizes) < 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_table_without_rows_reads_the_source_once(spark, tmp_path):
    t = table(spark)
    t.overwrite(frame(spark))
    seen = spark.sparkContext.accumulator(0)
    data = [row(1, "a", 1), row(1, "b", 2, at=9), row(None, "n", None)]
    source = spark.createDataFrame(spark.sparkContext.parallelize(data).map(lambda r: (seen.add(1), r)[1]), SCHEMA)
    done = upsert(t, source)
    assert (done.rows, done.inserted, done.updated, done.max_mark) == (3, 3, 0, datetime(2024, 1, 9))
    assert t.months() == [NO_MONTH, 202401, 202402] and t.row_count() == 3
    assert seen.value == 3
