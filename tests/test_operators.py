from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnhouse.operators import aggregates as ag
from tarnhouse.operators import discounts as dc
from tarnhouse.operators import filters as fl
from tarnhouse.operators import joins as jn
from tarnhouse.operators import ranking as rk
from tarnhouse.operators import sets
from tarnhouse.operators import shaping as sh
from tarnhouse.operators.bitmaps import count_bitmaps, distinct_bitmaps, united_bitmaps
from tarnhouse.operators.routing import Aggregate, Measure, aggregate_routing, choose_aggregate
from tarnhouse.operators.upsert import latest_per_key

from .conftest import plan, rows

QUICK = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


# -- filters -------------------------------------------------------------------


@pytest.fixture(scope="module")
def moments(spark):
    text = [
        "2024-01-01 00:00:00",
        "2023-12-31 23:59:59.999999",
        "2024-01-08 00:00:00",
        "2024-01-07 23:59:59.999999",
        "2024-01-08 00:00:00.000001",
        None,
    ]
    return spark.createDataFrame([(t,) for t in text], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t")
    )


def test_window_takes_its_start_and_not_its_end(moments):
    got = moments.filter(fl.window_predicate(moments, "t", datetime(2024, 1, 1), datetime(2024, 1, 8)))
    assert rows(got) == [(datetime(2024, 1, 1),), (datetime(2024, 1, 7, 23, 59, 59, 999999),)]


def test_open_window_has_no_end(moments):
    assert moments.filter(fl.window_predicate(moments, "t", date(2024, 1, 8))).count() == 2


def test_between_takes_both_ends(moments):
    assert fl.filter_between(moments, "t", "2024-01-01", "2024-01-08").count() == 3


def test_stage_that_is_off_has_no_rows(spark):
    control = spark.createDataFrame([("a", True), ("b", False)], "name string, skipload boolean")
    assert rows(fl.filter_enabled(control)) == [("b", False)]
    assert rows(fl.filter_enabled(control, 0)) == []


# -- shaping -------------------------------------------------------------------


def test_replacements_run_in_order(spark):
    df = spark.createDataFrame([("M",), ("F",), (None,), ("m",)], "g string")
    got = sh.replace_text(df, "g", ("M", "Male"), ("F", "Female"))
    assert rows(got) == [("Female",), ("Male",), ("m",), (None,)]


def test_split_and_combine_keep_the_place_of_the_column(spark):
    df = spark.createDataFrame([(1, "a > b", "x"), (2, "a", None), (3, None, "y"), (4, "a > b > c", "z")], "i int, c string, d string")
    got = sh.split_column(df, "c", " > ", ["c1", "c2"])
    assert got.columns == ["i", "c1", "c2", "d"]
    assert [tuple(r)[1:3] for r in got.orderBy("i").collect()] == [("a", "b"), ("a", None), (None, None), ("a", "b")]
    joined = sh.combine_columns(df, ["c", "d"], "e", "-")
    assert joined.columns == ["i", "e"]
    assert [r["e"] for r in joined.orderBy("i").collect()] == ["a > b-x", "a", "y", "a > b > c-z"]


def test_removing_an_unknown_column_fails(spark):
    with pytest.raises(ValueError, match="nope"):
        sh.remove_columns(spark.range(1), "nope")


# -- joins ---------------------------------------------------------------------


def test_left_lookups_keep_unknown_rows_and_inner_ones_drop_them(spark):
    items = spark.createDataFrame([(1, "red"), (2, None), (3, "pink")], "id int, color string")
    colors = spark.createDataFrame([("red", "RED")], "color string, name string")
    assert rows(jn.join_lookups(items, [(colors, "color", "left")]).select("id", "name")) == [(1, "RED"), (2, None), (3, None)]
    assert rows(jn.join_lookups(items, [(colors, "color", "inner")]).select("id", "name")) == [(1, "RED")]


def test_anti_join_keeps_blank_keys(spark):
    source = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    target = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(jn.anti_join_new(source, target, ["k"])) == [(2,), (None,)]


def test_text_that_is_no_number_matches_nothing(spark):
    left = spark.createDataFrame([(1, "one")], "id int, name string")
    right = spark.createDataFrame([("1",), ("x",), (None,), (" 1 ",)], "id_text string")
    assert rows(jn.join_mixed_type(left, right, "id", "id_text")) == [(1, "one", " 1 "), (1, "one", "1")]


def test_headers_without_lines_keep_blanks(spark):
    header = spark.createDataFrame([(1,), (2,)], "k int")
    line = spark.createDataFrame([(1, 5), (1, 6), (3, 7)], "k int, v int")
    assert rows(jn.related_rows(header, line, "k", total=F.sum("v"))) == [(1, 11), (2, None)]
    assert rows(jn.related_lookup(line, header.withColumn("h", F.col("k") * 10), "k", "h")) == [
        (1, 5, 10), (1, 6, 10), (3, 7, None)
    ]


# -- aggregates ----------------------------------------------------------------


def test_size_check_follows_the_limit(spark, broadcast_limit):
    assert jn.is_small(spark.range(10)) == (broadcast_limit != "-1")
    assert not jn.is_small(spark.range(1 << 40))


def test_summarize_has_a_blank_group_and_no_empty_one(spark, broadcast_limit):
    fact = spark.createDataFrame([(1, 2), (1, 3), (9, 4), (None, 5), (2, None)], "k int, q int")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, name string")
    got = ag.summarize_columns(fact, dim, "k", ["name"], {"qty": "q"})
    money = fact.withColumn("q", F.col("q").cast("decimal(18,2)"))
    typed = ag.summarize_columns(money, dim, "k", ["name"], {"qty": "q"})
    # The type of a sum depends on its column alone, not on the size of the dimension.
    assert typed.schema["qty"].dataType.simpleString() == "decimal(28,2)"
    # b has only a blank measure and c has no fact, so both are left out.
    assert rows(got) == [("a", 5), (None, 9)]


def test_distinct_count_counts_the_blank(spark, broadcast_limit):
    fact = spark.createDataFrame(
        [(1, 10), (1, 10), (1, None), (1, None), (2, 11), (7, 12)], "k int, c int"
    )
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    assert rows(ag.distinct_count(fact, dim, "k", ["name"], "c", "n")) == [("a", 2), ("b", 1), (None, 1)]


def test_total_row_differs_from_a_blank_group(spark):
    df = spark.createDataFrame([(2001, 1), (None, 2), (2001, 4)], "y int, q int")
    got = ag.rollup_subtotal(df, "y", "q", "sum")
    assert rows(got) == [(2001, False, 5), (None, False, 2), (None, True, 7)]


def test_mark_of_an_empty_table_is_the_default(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 1),)], "t timestamp_ntz")
    assert rows(ag.max_mark(df, "t")) == [(datetime(2020, 1, 1),)]
    assert rows(ag.max_mark(df.limit(0), "t")) == [(datetime(2013, 1, 1),)]


def test_distinct_values_and_sum_of_nothing(spark):
    df = spark.createDataFrame([(1,), (None,), (1,)], "q int")
    assert rows(ag.distinct_values(df, "q")) == [(1,), (None,)]
    assert rows(ag.calculate_sum(df.limit(0), "q", "s")) == [(None,)]


# -- ranking -------------------------------------------------------------------


@QUICK
@given(
    st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 4))), max_size=30),
    st.integers(1, 35),
    st.booleans(),
    st.booleans(),
)
def test_top_n_equals_rank(spark, data, n, up1, up2):
    df = spark.createDataFrame(data, "a int, b int")
    order = (("a", up1), ("b", up2))
    rank = F.rank().over(Window.orderBy(*rk._sort(order)))
    want = df.withColumn("r", rank).filter(F.col("r") <= n).drop("r")
    assert rows(rk.top_n_ties(df, n, *order)) == rows(want)


@QUICK
@given(st.lists(st.integers(-50, 50), max_size=40, unique=True))
def test_surrogate_key_equals_row_number(spark, ids):
    df = spark.createDataFrame([(str(i), i) for i in ids], "id string, v int").repartition(5)
    got = rk.surrogate_key(df, ["id"], "key")
    want = df.select(F.row_number().over(Window.orderBy("id")).alias("key"), "id", "v")
    assert rows(got) == rows(want)


def test_surrogate_key_of_many_ties_still_numbers_every_row(spark):
    df = spark.range(2000).select(F.lit(7).alias("k"), F.col("id").alias("v")).repartition(8)
    got = rk.surrogate_key(df, ["k"], "key")
    assert sorted(r["key"] for r in got.collect()) == list(range(1, 2001))
    assert got.select("v").distinct().count() == 2000


# -- unions ---------------------------------------------------------------------


def test_union_keeps_or_drops_duplicates(spark):
    days = [(date(2024, 1, d), d) for d in (1, 1, 5, 9)]
    df = spark.createDataFrame(days, "d date, v int")
    parts = [(df, date(2024, 1, 1), date(2024, 1, 9)), (df, date(2024, 1, 5), date(2024, 1, 6))]
    assert sorted(r["v"] for r in sets.union_ranges(parts, "d").collect()) == [1, 1, 5, 5]
    assert sets.union_distinct(df, df).count() == 3


# -- discounts -------------------------------------------------------------------


def test_discounts_agree_and_divide_safely(spark):
    header = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 5.0)], "OrderId int, TotalDiscount double")
    detail = spark.createDataFrame(
        [(1, 20.0, 2), (1, 10.0, 6), (2, 0.0, 4), (9, 3.0, 1)], "OrderId int, UnitPrice double, Quantity int"
    )
    pct = dc.discount_pct(header, detail)
    # Order 2 is worth nothing, order 3 has no lines.
    assert rows(pct) == [(1, 10.0, 0.1), (2, 5.0, None), (3, 5.0, None)]
    lines = dc.line_discount(pct, detail)
    assert [r["LineDiscount"] for r in lines.orderBy("OrderId", "UnitPrice").collect()] == [6.0, 4.0, None, None]
    assert rows(dc.discount_value(lines)) == rows(dc.discount_value_correct(pct, detail)) == [(10.0,)]


# -- aggregate tables --------------------------------------------------------------


def test_routing_gives_the_same_from_everywhere(spark):
    base = spark.createDataFrame(
        [(2000, 1, 5), (2000, 1, 6), (2000, 2, 7), (2000, 4, None), (2001, None, 8), (2002, 5, None), (None, 3, 9)],
        "year int, customer int, q int"
    )
    fine = ag.sum_by(base, ["year", "customer"], {"sq": "q"})
    coarse = ag.sum_by(base, ["year"], {"sq": "q"})
    tables = [
        Aggregate("fine", lambda: fine, frozenset({"year", "customer"}), {"q": "sq"}, True),
        Aggregate("coarse", lambda: coarse, frozenset({"year"}), {"q": "sq"}),
    ]
    total, count = Measure("s", "sum", "q"), Measure("n", "distinct_count", "customer")
    assert choose_aggregate(tables, ["year"], [total]).name == "coarse"
    assert choose_aggregate(tables, ["year"], [total, count]).name == "fine"
    assert choose_aggregate(tables, ["customer"], [total]).name == "fine"
    assert choose_aggregate(tables, ["year"], [Measure("s", "sum", "other")]) is None
    for by, measures in ((["year"], [total]), (["year"], [total, count]), (["customer"], [total])):
        assert rows(aggregate_routing(base, tables, by, measures)) == rows(
            aggregate_routing(base, [], by, measures)
        )
    assert rows(aggregate_routing(base, [], ["year"], [count])) == [(2000, 3), (2001, 1), (2002, 1), (None, 1)]
    # An aggregate that lacks groups without a sum cannot count their values.
    partial = [Aggregate("fine", lambda: fine.filter("sq is not null"), tables[0].grain, {"q": "sq"})]
    assert choose_aggregate(partial, ["year"], [count]) is None
    two = [total, count, Measure("y", "distinct_count", "year")]
    got = aggregate_routing(base, tables, ["year"], two)
    assert rows(got) == [(2000, 18, 3, 1), (2001, 8, 1, 1), (2002, None, 1, 1), (None, 9, 1, 1)]
    assert "Expand" not in plan(got)


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 1, 5, "a"), (1, 1, 7, "b"), (1, 1, 7, "c"), (1, 2, None, "d"), (2, 1, 1, "e")],
        "k1 int, k2 int, at int, v string",
    )
    got = latest_per_key(df, ["k1", "k2"], "at")
    assert got.columns == df.columns
    assert rows(got) == [(1, 1, 7, "c"), (1, 2, None, "d"), (2, 1, 1, "e")]
    blank = spark.createDataFrame([(None, 1, 5, "x"), (None, 1, 7, "y"), (1, 1, 1, "z")], df.schema)
    assert rows(latest_per_key(blank, ["k1", "k2"], "at")) == rows(blank)


def test_surrogate_keys_have_one_type(spark, monkeypatch):
    df = spark.range(5)
    assert rk.surrogate_key(df, ["id"], "k").schema["k"].dataType.simpleString() == "int"
    assert rk.surrogate_key(df, ["id"], "k", key_type="long").schema["k"].dataType.simpleString() == "bigint"
    monkeypatch.setitem(rk._KEYS, "int", 4)
    with pytest.raises(OverflowError, match="5 rows"):
        rk.surrogate_key(df, ["id"], "k")


# -- bitmaps -----------------------------------------------------------------


def sales_rows(spark):
    data = [(2000 + k % 3, k % 7 or None, None if k % 11 == 0 else (k * k - 900) * (40_000 if k % 5 == 0 else 1)) for k in range(400)]
    return spark.createDataFrame([*data, (None, 1, 5), (None, None, None)], "y int, d int, c long")


@pytest.mark.parametrize("by", [["y", "d"], ["y"], ["d"], []])
def test_bitmaps_count_as_the_base_does(spark, by):
    """Negative and large values, blanks among values and groups, and counts by fewer columns."""
    base = sales_rows(spark)
    stored = distinct_bitmaps(base, ["y", "d"], "c")
    assert max(len(r["_bits"]) for r in stored.collect()) == 4096
    want = base.groupBy(*by).agg((F.countDistinct("c") + F.max(F.col("c").isNull().cast("int"))).alias("n"))
    assert rows(count_bitmaps(stored, by, "n")) == rows(want)
    assert rows(count_bitmaps(united_bitmaps(stored, by), by, "n")) == rows(want)


def test_bitmaps_need_whole_numbers(spark):
    with pytest.raises(TypeError, match="c is none"):
        distinct_bitmaps(spark.createDataFrame([("a", 1.5)], "y string, c double"), ["y"], "c")
    assert count_bitmaps(distinct_bitmaps(sales_rows(spark).limit(0), ["y"], "c"), ["y"], "n").collect() == []


def test_routing_counts_from_bitmaps(spark):
    base = sales_rows(spark).withColumn("q", F.lit(2))
    bitmaps = distinct_bitmaps(base, ["y"], "c")
    by_year = Aggregate(
        "by_year", lambda: ag.sum_by(base, ["y"], {"s": "q"}), frozenset({"y"}), {"q": "s"}, distinct={"c": lambda: bitmaps}
    )
    measures = [Measure("n", "distinct_count", "c"), Measure("total", "sum", "q")]
    assert choose_aggregate([by_year], ["y"], measures) is by_year
    assert choose_aggregate([by_year], ["y", "d"], measures) is None
    assert choose_aggregate([by_year], ["y"], [Measure("n", "distinct_count", "d")]) is None
    for by in (["y"], []):
        got = aggregate_routing(base, [by_year], by, measures)
        assert rows(got.select(*by, "n", "total")) == rows(aggregate_routing(base, [], by, measures).select(*by, "n", "total"))
