from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnhouse.plans import control as ct
from tarnhouse.plans import loads
from tarnhouse.plans.stages import without_geography
from tarnhouse.plans.warehouse import TABLES, create_tables, warehouse_table
from tarnhouse.session import scratch_path
from tarnhouse.sources.lake import LakeTable, range_layout

from .conftest import rows

SCHEMA = "id int, v string, at timestamp_ntz"


def day(n, micro=0):
    return datetime(2013, 1, n, 0, 0, 0, micro)


@pytest.fixture()
def lake(spark):
    return scratch_path(spark, "lake")


def events(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_full_load_applies_the_window_and_reports_the_mark(spark, lake):
    t = LakeTable(spark, f"{lake}/t", mark="at")
    source = events(spark, (1, "a", day(1)), (2, "b", day(7, 5)), (3, "c", day(8)))
    done = loads.load_full(source, t, day(1), day(8))
    assert (done.rows_copied, done.inserted, done.updated, done.max_mark) == (2, 2, 0, day(7, 5))
    # The next full load replaces what is there.
    assert loads.load_full(source, t, day(8)).rows_copied == 1
    assert rows(t.read().select("id")) == [(3,)]


@pytest.mark.parametrize("layout", [None, range_layout(2)])
def test_incremental_loads_continue_at_the_mark(spark, lake, layout):
    t = LakeTable(spark, f"{lake}/t", ("id",), "at", layout)
    first = loads.load_incremental(
        events(spark, (1, "a", day(1)), (2, "b", day(3)), (3, "c", day(9))), t, lake, day(1), day(8)
    )
    assert (first.rows_read, first.inserted, first.updated, first.max_mark) == (2, 2, 0, day(3))
    # Unchanged end, nothing new: the row on the mark is read again and stays as it is.
    again = loads.load_incremental(
        events(spark, (1, "a", day(1)), (2, "b", day(3)), (3, "c", day(9))), t, lake, first.max_mark, day(8)
    )
    assert (again.rows_read, again.inserted, again.updated, again.max_mark) == (1, 0, 1, day(3))
    last = loads.load_incremental(
        events(spark, (1, "A", day(10)), (2, "b", day(3)), (3, "c", day(9))), t, lake, again.max_mark
    )
    assert (last.inserted, last.updated, last.max_mark) == (1, 2, day(10))
    assert rows(t.read().select("id", "v")) == [(1, "A"), (2, "b"), (3, "c")]


def test_an_increment_without_rows_changes_nothing(spark, lake):
    t = LakeTable(spark, f"{lake}/t", ("id",), "at")
    loads.load_incremental(events(spark, (1, "a", day(1))), t, lake, day(1))
    done = loads.load_incremental(events(spark, (1, "a", day(1))), t, lake, day(2))
    assert (done.rows_read, done.inserted, done.updated, done.max_mark) == (0, 0, 0, day(1))
    assert t.row_count() == 1


class Asked:
    """A source that notes what each table is asked for."""

    def __init__(self, data):
        self.data, self.asked = data, {}

    def read(self, spark, schema, table, mark, start, end, key):
        self.asked[table] = (schema, mark, start, end, key)
        return self.data[table]


@pytest.mark.parametrize("geography", [False, True])
def test_a_source_is_told_mark_window_and_key(spark, lake, geography):
    data = {"facts": events(spark, (1, "a", day(2)), (2, "b", day(9))), "names": spark.range(3)}
    data["broken"] = data["names"]
    source, control = Asked(data), start(spark, lake)
    done = loads.run_loads(spark, control, without_geography(source) if geography else source, lake)
    assert {r.status for r in done.values()} == {"Succeeded"}
    assert source.asked == {
        "facts": ("s", "at", datetime(2013, 1, 1), day(8), "id"),
        "names": ("s", None, None, None, None),
        "broken": ("s", None, None, None, None),
    }
    assert done["Facts"].rows_read == 1  # the window is applied, whatever the source gives
    control.overwrite(control.read().withColumn("enddate", F.lit(None).cast("timestamp_ntz")))
    loads.run_loads(spark, control, source, lake)
    assert source.asked["facts"] == ("s", "at", day(2), None, "id")  # from the newest mark, open at the end


CONTROL = [
    ("s", "facts", "at", "2013-01-08 00:00:00", "Facts", ct.INCREMENTAL, "id", None),
    ("s", "names", None, None, "Names", ct.FULL, None, None),
    ("s", "broken", None, None, "Broken", ct.FULL, None, None),
    ("s", "skipped", None, None, "Skipped", ct.FULL, None, None),
]


def start(spark, lake):
    plan = ct.control_table(ct.control_rows(spark, "p", CONTROL), ct.control_rows(spark, "p", CONTROL[:1]))
    plan = plan.withColumn("skipload", F.col("sourcetable") == "skipped")
    return loads.control_lake_table(spark, f"{lake}/control", plan)


def log(control):
    return {r["sinktable"]: r for r in control.read().collect()}


def test_runs_write_their_outcome_back(spark, lake):
    data = {
        "facts": events(spark, (1, "a", day(2)), (2, "b", day(9))),
        "names": spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string"),
    }
    control = start(spark, lake)
    assert control.row_count() == 4

    def source(schema, name):
        return data[name]

    batch = datetime(2024, 1, 1)
    done = loads.run_loads(spark, control, source, lake, batch=batch)
    assert {k: r.status for k, r in done.items()} == {
        "Facts": "Succeeded", "Names": "Succeeded", "Broken": "Failed",
    }
    assert "broken" in done["Broken"].error
    after = log(control)
    facts = after["Facts"]
    assert (facts["rowsread"], facts["rowsinserted"], facts["rowsupdated"]) == (1, 1, 0)
    assert facts["maxdatetime"] == facts["startdate"] == day(2) and facts["batchloaddatetime"] == batch
    assert facts["pipelinestarttime"] <= facts["pipelineendtime"]
    assert after["Names"]["rowscopied"] == 2 and after["Names"]["startdate"] is None
    assert (after["Broken"]["loadstatus"], after["Broken"]["rowsread"]) == ("Failed", None)
    assert after["Skipped"]["loadstatus"] is None

    # The cause is repaired and the window opened; the run goes on from the mark.
    data["broken"] = data["names"]
    control.overwrite(control.read().withColumn("enddate", F.lit(None).cast("timestamp_ntz")))
    loads.run_loads(spark, control, source, lake)
    after = log(control)
    assert after["Broken"]["loadstatus"] == "Succeeded"
    assert (after["Facts"]["rowsinserted"], after["Facts"]["rowsupdated"]) == (1, 1)
    assert after["Facts"]["startdate"] == day(9)
    assert LakeTable(spark, f"{lake}/Tables/Facts").row_count() == 2


def test_a_stage_that_is_off_loads_nothing(spark, lake):
    control = start(spark, lake)
    assert loads.run_loads(spark, control, lambda schema, name: None, lake, stage=0) == {}


def test_a_failed_load_keeps_table_and_mark(spark, lake):
    rows_in = events(spark, (1, "a", day(2)), (2, "b", day(3)))
    control = start(spark, lake)
    loads.run_loads(spark, control, lambda schema, name: rows_in, lake)
    bad = rows_in.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    done = loads.run_loads(spark, control, lambda schema, name: bad, lake)
    assert done["Facts"].status == "Failed"
    assert log(control)["Facts"]["startdate"] == day(3)
    assert rows(LakeTable(spark, f"{lake}/Tables/Facts").read().select("v")) == [("a",), ("b",)]


def test_reference_control_rows(spark):
    bronze = ct.control_rows(spark, "p", ct.BRONZE)
    assert bronze.count() == 19
    assert bronze.filter("loadtype = 'incremental'").count() == 4
    assert bronze.filter("enddate is not null").count() == 4
    assert bronze.filter(F.col("startdate") == F.lit("2013-01-01").cast("timestamp_ntz")).count() == 19
    gold = ct.control_rows(spark, "p", ct.GOLD)
    assert gold.count() == 6 and gold.filter("tablekey2 is not null").count() == 2
    sinks = {r["sinktable"] for r in ct.control_rows(spark, "p", ct.WAREHOUSE, "Gold").collect()}
    assert sinks == set(TABLES)
    assert ct.control_table(bronze, bronze).count() == 19


def test_warehouse_loads(spark, lake):
    create_tables(spark, f"{lake}/Tables/Gold")
    assert warehouse_table(spark, f"{lake}/Tables/Gold", "Products").read().count() == 0
    orders = spark.createDataFrame(
        [(1, 1, 7, 5, 3, datetime(2013, 1, 1), 2, 4.5, day(3)), (1, 2, 7, 6, 3, datetime(2013, 1, 1), 1, 1.0, day(4))],
        "OrderID int, OrderLineID int, CustomerID int, StockItemID int, SalespersonPersonID int, "
        "OrderDate timestamp_ntz, Quantity int, ExtendedPrice double, LastUpdated timestamp_ntz",
    )
    people = spark.createDataFrame([("b", 2)], "FullName string, PersonID long")
    lists = [r for r in ct.WAREHOUSE if r[4] in ("SalesOrders", "Salesperson")]
    control = loads.control_lake_table(spark, f"{lake}/wh", ct.control_rows(spark, "p", lists, "Gold"))
    views = {"vSalesOrders": orders, "vSalesperson": people}

    def run():
        return loads.run_loads(spark, control, lambda schema, name: views[name], lake, warehouse=True)

    first = run()
    assert (first["Gold.SalesOrders"].inserted, first["Gold.SalesOrders"].updated) == (2, 0)
    assert (first["Gold.Salesperson"].inserted, first["Gold.Salesperson"].updated) == (1, 0)
    # The mark moves on, and the closed window reads the row on it again.
    assert log(control)["SalesOrders"]["startdate"] == day(4)
    assert (run()["Gold.SalesOrders"].inserted, run()["Gold.SalesOrders"].updated) == (0, 1)
    sold = warehouse_table(spark, f"{lake}/Tables/Gold", "SalesOrders").read()
    assert sold.schema["ExtendedPrice"].dataType.simpleString() == "decimal(18,2)"
    assert sold.count() == 2


@pytest.mark.parametrize(
    ("start_day", "end_day", "want"), [(None, None, [1, 2, 3]), (2, None, [2, 3]), (None, 3, [1, 2]), (2, 3, [2])]
)
def test_windows_may_be_open_at_either_end(spark, lake, start_day, end_day, want):
    source = events(spark, (1, "a", day(1)), (2, "b", day(2)), (3, "c", day(3)))
    window = [d and day(d) for d in (start_day, end_day)]
    whole = LakeTable(spark, f"{lake}/whole", ("id",), "at")
    loads.load_full(source, whole, *window)
    part = LakeTable(spark, f"{lake}/part", ("id",), "at")
    assert loads.load_incremental(source, part, lake, *window).rows_read == len(want)
    for table in (whole, part):
        assert sorted(r["id"] for r in table.read().collect()) == want


TWINS = [
    ("s", "one", "at", None, "Orders", ct.INCREMENTAL, "id", None),
    ("s", "two", "at", None, "Orders", ct.INCREMENTAL, "id", None),
    ("s", "one", "at", None, "Copy", ct.INCREMENTAL, "id", None),
]


def twins(spark, lake):
    plan = ct.control_rows(spark, "p", TWINS[:1], "sa").unionByName(ct.control_rows(spark, "p", TWINS[1:], "sb"))
    return loads.control_lake_table(spark, f"{lake}/control", plan)


def test_equal_sink_names_and_shared_sources_stay_apart(spark, lake):
    data = {"one": events(spark, *[(k, "a", day(1)) for k in range(5)]), "two": events(spark, (7, "b", day(2)))}
    control = twins(spark, lake)
    done = loads.run_loads(spark, control, lambda schema, name: data[name], lake)
    assert {k: (r.status, r.rows_read) for k, r in done.items()} == {
        "sa.Orders": ("Succeeded", 5), "sb.Orders": ("Succeeded", 1), "sb.Copy": ("Succeeded", 5),
    }
    assert rows(LakeTable(spark, f"{lake}/Tables/sb/Orders").read()) == [(7, "b", day(2))]
    logged = {(r["sinkschema"], r["sinktable"]): r for r in control.read().collect()}
    assert len(logged) == 3 and all(r["loadstatus"] == "Succeeded" for r in logged.values())
    assert logged["sb", "Copy"]["startdate"] == day(1) and logged["sb", "Orders"]["startdate"] == day(2)


def test_a_stopped_run_keeps_the_marks_of_finished_tables(spark, lake, monkeypatch):
    control = twins(spark, lake)
    logged = loads.run_log

    def stop_at_second(control, batch, results):
        if any(r["loadstatus"] for r in control.read().collect()):
            raise KeyboardInterrupt
        logged(control, batch, results)

    monkeypatch.setattr(loads, "run_log", stop_at_second)
    with pytest.raises(KeyboardInterrupt):
        loads.run_loads(spark, control, lambda schema, name: events(spark, (1, "a", day(5))), lake)
    assert sum(r["startdate"] == day(5) for r in control.read().collect()) == 1


def test_two_rows_for_one_target_are_refused(spark, lake):
    control = loads.control_lake_table(spark, f"{lake}/control", ct.control_rows(spark, "p", TWINS[:2], "s"))
    with pytest.raises(ValueError, match="s.Orders"):
        loads.run_loads(spark, control, lambda schema, name: None, lake)
