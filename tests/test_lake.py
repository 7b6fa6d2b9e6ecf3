from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnhouse.operators.upsert import create_or_upsert, update_then_insert, upsert
from tarnhouse.session import scratch_path
from tarnhouse.sources.lake import LakeTable, hash_layout, range_layout

from .conftest import rows

SCHEMA = "k int, v string"


def table(spark, *keys, **kw):
    return LakeTable(spark, scratch_path(spark, "t"), keys, **kw)


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_first_save_then_replace(spark):
    t = table(spark)
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.create(frame(spark, [(1, "a")])) == 1
    with pytest.raises(FileExistsError):
        t.create(frame(spark, [(1, "a")]))
    assert t.overwrite(t.read().union(t.read())) == 2
    assert rows(t.read()) == [(1, "a"), (1, "a")]


def test_failed_load_leaves_the_previous_version(spark):
    t = table(spark)
    t.create(frame(spark, [(1, "a")]))
    broken = frame(spark, [(2, "x")]).select("k", F.raise_error(F.lit("broken")).cast("string").alias("v"))
    with pytest.raises(Exception, match="broken"):
        t.overwrite(broken)
    assert rows(t.read()) == [(1, "a")] and t.row_count() == 1
    t.overwrite(frame(spark, [(3, "c")]))
    assert rows(t.read()) == [(3, "c")]


def test_a_second_writer_is_noticed(spark):
    t = table(spark)
    t.create(frame(spark, [(1, "a")]))
    base = t.snapshot()
    t.overwrite(frame(spark, [(2, "b")]))
    with pytest.raises(RuntimeError, match="another writer"):
        t.publish(base, base.folders, None, base.schema)
    assert rows(t.read()) == [(2, "b")]


def test_a_reader_keeps_the_version_it_started_with(spark):
    t = table(spark)
    t.create(frame(spark, [(1, "a")]))
    before = t.read()
    t.overwrite(frame(spark, [(2, "b")]))
    assert rows(before) == [(1, "a")]


def test_truncate_load_keeps_the_stored_columns(spark):
    t = table(spark)
    t.create(frame(spark, [(1, "a"), (2, "b")]))
    t.truncate_load(frame(spark, [("z", "7", 1.0)], "v string, k string, extra double"))
    assert t.read().schema.simpleString() == "struct<k:int,v:string>"
    assert rows(t.read()) == [(7, "z")]
    assert t.truncate_load(t.read().limit(0)) == 0
    assert t.read().columns == ["k", "v"] and t.row_count() == 0
    with pytest.raises(ValueError, match="'v'"):
        t.truncate_load(spark.range(1).withColumnRenamed("id", "k"))


def test_append_leaves_stored_folders_alone(spark):
    t = table(spark, mark="at")
    schema = "k int, at timestamp_ntz"
    t.create(frame(spark, [(1, datetime(2024, 1, 5))], schema))
    before = t.snapshot().folders
    t.append(frame(spark, [(2, datetime(2024, 1, 3, 0, 0, 0, 5))], schema))
    assert t.snapshot().folders[:1] == before
    assert t.row_count() == 2 and t.max_mark() == datetime(2024, 1, 5)
    assert rows(t.read().select("k")) == [(1,), (2,)]


def test_marks_keep_microseconds(spark):
    t = table(spark, mark="at")
    t.create(frame(spark, [(1, datetime(2024, 1, 5, 1, 2, 3, 4))], "k int, at timestamp_ntz"))
    assert t.max_mark() == datetime(2024, 1, 5, 1, 2, 3, 4)


@pytest.mark.parametrize("layout", [None, hash_layout(3), range_layout(2)])
def test_upsert_new_changed_unchanged_and_blank_keys(spark, layout, broadcast_limit):
    t = table(spark, "k", layout=layout)
    t.create(frame(spark, [(1, "a"), (2, "b"), (None, "n"), (9, "z")]))
    source = frame(spark, [(2, "B"), (9, "z"), (5, "e"), (None, "m")])
    first = upsert(t, source)
    # An unchanged match counts as updated, a blank key always as new.
    assert (first.rows, first.inserted, first.updated) == (4, 2, 2)
    assert rows(t.read()) == [(1, "a"), (2, "B"), (5, "e"), (9, "z"), (None, "m"), (None, "n")]


def test_upsert_updates_every_target_row_of_a_key(spark):
    t = table(spark, "k")
    t.create(frame(spark, [(1, "a"), (1, "b")]))
    done = upsert(t, frame(spark, [(1, "c")]))
    assert (done.inserted, done.updated) == (0, 2)
    assert rows(t.read()) == [(1, "c"), (1, "c")]


@pytest.mark.parametrize("layout", [None, hash_layout(3)])
def test_source_duplicates_fail_only_when_they_match(spark, layout):
    t = table(spark, "k", layout=layout)
    t.create(frame(spark, [(1, "a")]))
    assert upsert(t, frame(spark, [(2, "x"), (2, "y")])).inserted == 2
    with pytest.raises(ValueError, match="same target row"):
        upsert(t, frame(spark, [(1, "x"), (1, "y"), (3, "c")]))
    assert rows(t.read()) == [(1, "a"), (2, "x"), (2, "y")]


def test_upsert_needs_all_columns_and_takes_them_by_name(spark):
    t = table(spark, "k")
    t.create(frame(spark, [(1, "a")]))
    with pytest.raises(ValueError, match="'v'"):
        upsert(t, frame(spark, [(1,)], "k int"))
    upsert(t, frame(spark, [("b", 1)], "v string, k int"))
    assert rows(t.read()) == [(1, "b")]


def test_only_touched_buckets_are_rewritten(spark):
    t = table(spark, "k", layout=range_layout(10))
    t.create(spark.range(50).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")))
    before = {f.bucket: f.folder for f in t.snapshot().folders}
    assert sorted(before) == [0, 1, 2, 3, 4]
    upsert(t, frame(spark, [(45, "b"), (51, "c")]))
    after = {f.bucket: f.folder for f in t.snapshot().folders}
    assert {b for b in before if before[b] == after[b]} == {0, 1, 2, 3}
    assert sorted(after) == [0, 1, 2, 3, 4, 5]
    assert t.row_count() == t.read().count() == 51


@pytest.mark.parametrize("layout", [None, range_layout(10)])
def test_removing_old_data_keeps_the_live_folders(spark, layout):
    t = table(spark, "k", layout=layout)
    t.create(spark.range(30).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")))
    upsert(t, frame(spark, [(5, "b"), (31, "c")]))
    upsert(t, frame(spark, [(5, "d")]))
    with pytest.raises(ValueError):
        t.remove_old(0)
    # Unbucketed: the first version. In buckets: bucket 0 of the first version.
    assert t.remove_old(2) == 1
    assert t.remove_old(1) == 1
    assert t.remove_old(1) == 0
    assert t.read().count() == 31 and rows(t.read().filter("k in (5, 31)")) == [(31, "c"), (5, "d")]


pairs = st.dictionaries(st.integers(0, 12), st.sampled_from("abc"), max_size=10)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, pairs, st.sampled_from([None, hash_layout(2), range_layout(5)]))
def test_upsert_twice_equals_once(spark, old, new, layout):
    t = table(spark, "k", layout=layout)
    t.create(frame(spark, list(old.items())))
    source = frame(spark, list(new.items()))
    done = upsert(t, source)
    assert (done.inserted, done.updated) == (len(new.keys() - old.keys()), len(new.keys() & old.keys()))
    assert dict(t.read().collect()) == {**old, **new}
    again = upsert(t, source)
    assert (again.inserted, again.updated) == (0, len(new))
    assert dict(t.read().collect()) == {**old, **new}
    assert t.row_count() == len({**old, **new})


def test_create_or_upsert_counts_a_first_load_as_inserted(spark):
    t = table(spark, "k")
    assert create_or_upsert(t, frame(spark, [(1, "a"), (2, "b")])).inserted == 2
    assert create_or_upsert(t, frame(spark, [(2, "c")])).updated == 1


def test_update_then_insert_uses_a_closed_window_and_returns_the_new_mark(spark):
    schema = "k1 int, k2 int, v string, at timestamp_ntz"
    t = table(spark, "k1", "k2", mark="at")
    t.create(frame(spark, [(1, 1, "a", datetime(2024, 1, 1)), (1, 2, "b", datetime(2024, 1, 5))], schema))
    source = frame(
        spark,
        [
            (1, 1, "A", datetime(2024, 1, 4)),
            (1, 2, "B", datetime(2024, 1, 5)),
            (2, 1, "c", datetime(2024, 1, 9)),
            (2, 2, "d", datetime(2024, 1, 9, 0, 0, 0, 1)),
        ],
        schema,
    )
    done = update_then_insert(t, source, end=datetime(2024, 1, 9))
    assert (done.inserted, done.updated, done.max_mark) == (1, 1, datetime(2024, 1, 9))
    assert rows(t.read().select("v")) == [("B",), ("a",), ("c",)]
    assert update_then_insert(t, source).max_mark == datetime(2024, 1, 9, 0, 0, 0, 1)
