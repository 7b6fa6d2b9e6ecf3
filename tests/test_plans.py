"""Calendars, silver views and the star on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tarnhouse.plans import calendars as cal
from tarnhouse.plans import gold, silver

from .conftest import rows


def test_default_calendar(spark):
    df = cal.build_calendar(spark)
    assert df.count() == 4748
    assert tuple(df.orderBy("date").head()) == (
        date(2013, 1, 1), 1, 3, "Tuesday", 1, "January", 1, "Q1", 2013,
    )
    assert df.agg(F.max("date")).head()[0] == date(2025, 12, 31)
    assert cal.v_calendar(df).columns == [
        "Date", "DayNum", "DayOfWeek", "DayOfWeekNum", "Month", "MonthNum", "Quarter", "QuarterNum", "Year",
    ]


def test_date_dimension_includes_both_ends(spark):
    df = cal.dim_date(spark, date(2020, 1, 1), date(2020, 12, 31))
    assert df.count() == 366
    last = df.orderBy(F.desc("FullDateAlternateKey")).head().asDict()
    assert last["Week of Year"] == 53 and last["Week of Month"] == 5
    assert last["Day of Week"] == 3 and last["Day Name"] == "Thursday" and last["Day of Year"] == 366


def test_culture_calendar_leaves_out_its_end(spark):
    df = cal.calendar_culture(spark, date(2024, 5, 1), date(2024, 5, 3), "it-IT")
    assert rows(df)[0] == (
        date(2024, 5, 1), 2024, 2, 5, 1, 20240501, "maggio", "mag 2024", "Q2 2024", 2, "mercoledì", date(2024, 5, 5),
    )
    assert df.count() == 2
    assert cal.calendar_culture(spark, date(2024, 5, 3), date(2024, 5, 3)).count() == 0
    assert cal.calendar_culture(spark, date(2024, 5, 1), date(2024, 5, 2)).head()["MonthName"] == "May"


def test_calendar_entity(spark):
    df = cal.calendar_entity(cal.build_calendar(spark, 2024, 2024))
    assert df.schema.simpleString() == (
        "struct<Date:date,Year:bigint,Quarter:string,Month:string,MonthSort:date,Month in Year:string,"
        "MonthInYearSort:bigint,Day of Week:string,DayOfWeekSort:bigint>"
    )
    assert df.select("MonthSort", "Month").distinct().count() == 12


def test_sales_order_takes_the_later_edit(spark):
    orders = spark.createDataFrame(
        [(1, 7, 3, date(2013, 1, 1), datetime(2013, 1, 5)), (2, 8, 3, date(2013, 1, 2), datetime(2013, 1, 2))],
        "OrderID int, CustomerID int, SalespersonPersonID int, OrderDate date, LastEditedWhen timestamp_ntz",
    )
    lines = spark.createDataFrame(
        [(1, 10, 5, 2, Decimal("1.50"), datetime(2013, 1, 4)), (2, 20, 6, 3, Decimal("2.00"), datetime(2013, 1, 3)),
         (9, 30, 6, 3, Decimal("2.00"), datetime(2013, 1, 3))],
        "OrderID int, OrderLineID int, StockItemID int, Quantity int, UnitPrice decimal(18,2), LastEditedWhen timestamp_ntz",
    )
    got = silver.v_sales_orders(orders, lines).select("OrderID", "ExtendedPrice", "LastUpdated")
    assert rows(got) == [
        (1, Decimal("3.00"), datetime(2013, 1, 5)),
        (2, Decimal("6.00"), datetime(2013, 1, 3)),
    ]


def text(spark, names, *values):
    return spark.createDataFrame(list(values), ", ".join(f"{n} string" for n in names.split()))


def test_star_from_text_tables(spark):
    """Keys follow the order of the stored ids, which are text, so 10 comes before 9."""
    suppliers = text(spark, "SupplierID SupplierName SupplierCategoryID", ("9", "nine", "1"), ("10", "ten", None))
    supplier_categories = text(spark, "SupplierCategoryID SupplierCategoryName", ("1", "Toys"))
    dim_supplier = gold.dim_supplier(suppliers, supplier_categories)
    assert rows(dim_supplier.select("SupplierKey", "SupplierID", "SupplierCategoryName")) == [
        (1, 10, None), (2, 9, "Toys"),
    ]

    items = text(
        spark,
        "StockItemID StockItemName LeadTimeDays ColorID OuterPackageID SupplierID",
        ("1", "car", "3", "5", "2", "9"),
        ("2", "boat", "4", None, "7", "10"),
        ("3", "kite", "5", "5", "2", "77"),
    )
    dim_item = gold.dim_stock_item(
        items, text(spark, "ColorID ColorName", ("5", "Red")), text(spark, "PackageTypeID PackageTypeName", ("2", "Box"))
    )
    assert [tuple(r) for r in dim_item.orderBy("StockItemKey").collect()][:2] == [
        (1, 1, "car", "3", "Red", "Box", date(2013, 1, 1), 9),
        (2, 2, "boat", "4", None, None, date(2013, 1, 1), 10),
    ]

    customers = text(
        spark,
        "CustomerID CustomerName CustomerCategoryID DeliveryCityID BuyingGroupID DeliveryMethodID",
        ("4", "Ann", "1", "1", None, "1"),
    )
    dim_customer = gold.dim_customer(
        customers,
        text(spark, "CustomerCategoryID CustomerCategoryName", ("1", "Shop")),
        text(spark, "CityID CityName StateProvinceID", ("1", "Bari", "3")),
        text(spark, "StateProvinceID StateProvinceName SalesTerritory CountryID", ("4", "x", "y", "1")),
        text(spark, "CountryID CountryName Continent Region Subregion", ("1", "Italy", "Europe", "r", "s")),
        text(spark, "BuyingGroupID BuyingGroupName", ("1", "g")),
        text(spark, "DeliveryMethodID DeliveryMethodName", ("1", "Van")),
    )
    # The state is unknown, so everything behind it is blank.
    assert rows(dim_customer) == [
        (1, 4, "Ann", "Shop", None, "Van", "Bari", None, None, None, None, None, None, date(2013, 1, 1))
    ]

    fact = gold.fact_sales(
        text(spark, "OrderID OrderLineID StockItemID Quantity UnitPrice",
             ("1", "1", "1", "5", "2.345"), ("1", "2", "3", "5", "1"), ("2", "3", "2", "1", "9")),
        text(spark, "OrderID CustomerID OrderDate", ("1", "4", "2013-01-31"), ("2", "5", "2013-02-01")),
        dim_customer,
        dim_item,
        dim_supplier,
    )
    # Item 3 has an unknown supplier and order 2 an unknown customer.
    assert rows(fact) == [(1, 20130131, 1, 2, 1, 1, 5, Decimal("2.35"))]


def test_date_dimension_from_text(spark):
    df = text(
        spark,
        "DateKey Date Day WeekDay WeekDayName Month MonthName Quarter Year",
        ("20130101", "2013-01-01", "1", "3", "Tuesday", "1", "January", "1", "2013"),
    )
    got = gold.dim_date(df)
    assert got.schema["Day"].dataType.simpleString() == "tinyint"
    assert rows(got) == [(20130101, date(2013, 1, 1), 1, 3, "Tuesday", 1, "January", 1, 2013)]


def test_salesperson_and_products(spark):
    people = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", None)], "PersonID int, FullName string, IsSalesperson boolean")
    assert rows(silver.v_salesperson(people)) == [(1, "a")]
    items = spark.createDataFrame(
        [(1, "car", None, 3, 5, 9), (2, "boat", "B", 4, None, 9)],
        "StockItemID int, StockItemName string, Brand string, LeadTimeDays int, ColorID int, SupplierID int",
    )
    got = silver.v_products(
        items,
        spark.createDataFrame([(9, "nine")], "SupplierID int, SupplierName string"),
        spark.createDataFrame([(5, "Red")], "ColorID int, ColorName string"),
    )
    assert rows(got) == [("No Brand", "Red", 3, 1, "car", 9, "nine")]
