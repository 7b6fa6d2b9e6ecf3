"""The stored star: keys given once, months pruned by what is asked of the dates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tarnhouse.catalogue import star as queries
from tarnhouse.plans import star
from tarnhouse.session import child_names

from .conftest import plan, rows


@pytest.fixture(scope="module")
def stored(spark, sf):
    return queries.stored_star(spark, sf)


def test_dimensions_are_stored_once(spark, stored):
    before = {n: child_names(spark, stored.path(n)) for n in (star.CUSTOMER, star.ITEM, star.SUPPLIER, star.DATE)}
    assert all(before.values())
    assert stored.store_dimensions({n: spark.range(1) for n in before}) == []
    assert before == {n: child_names(spark, stored.path(n)) for n in before}
    again = star.Star(spark, f"{stored.root}/again")
    assert again.store_dimensions({"A": spark.range(2), "B": spark.range(3)}) == ["A", "B"]
    assert again.store_dimensions({"A": spark.range(5), "C": spark.range(1)}) == ["C"]
    assert again.read("A").count() == 2
    assert again.store_dimensions({"A": spark.range(5)}, again=True) == ["A"] and again.read("A").count() == 5


def test_the_fact_reads_key_and_id(spark, sf, stored):
    text = plan(stored.sales())
    assert "Sort" not in text and "Exchange" not in text
    lines, orders = queries.silver_sales(spark, sf)
    text = plan(star.fact_sales(lines, orders, *(stored.read(n) for n in (star.CUSTOMER, star.ITEM, star.SUPPLIER))))
    assert "ReadSchema: struct<CustomerKey:int,CustomerID:int>" in text
    assert "ReadSchema: struct<SupplierKey:int,SupplierID:int>" in text and "Window" not in text


def test_dates_prune_the_months_of_the_fact(spark, stored):
    some = stored.sales_on(F.col("Year") == 1997)
    text = plan(some)
    assert "dynamicpruningexpression(OrderMonth" in text
    months = [n for n in child_names(spark, stored.path(star.FACT)) if n.startswith(f"{star.MONTH}=")]
    assert len(months) > 12
    seen = rows(some.select(F.expr("OrderDateKey div 10000")).distinct())
    assert seen == [(1997,)]
    whole = stored.sales_on()
    assert whole.count() == stored.sales().count() > 0
    assert rows(whole.filter("Year = 1997").agg(F.count("*"))) == rows(some.agg(F.count("*")))


def test_every_line_has_its_keys(spark, sf, stored):
    sales = stored.sales()
    customers = stored.read(star.CUSTOMER).select("CustomerKey", "CustomerID")
    assert sales.join(customers, "CustomerKey", "left_anti").count() == 0
    assert sales.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()
