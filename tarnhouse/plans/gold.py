"""The gold star: dimensions with surrogate keys and the sales fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.functions.dates import date_key
from tarnhouse.functions.numbers import MONEY
from tarnhouse.operators.joins import join_lookups
from tarnhouse.operators.ranking import surrogate_key
from tarnhouse.operators.shaping import cast_columns

# Every dimension row is valid from this date.
VALID_FROM = date(2013, 1, 1)


def dim_customer(
    customers: DataFrame,
    categories: DataFrame,
    cities: DataFrame,
    states: DataFrame,
    countries: DataFrame,
    buying_groups: DataFrame,
    delivery_methods: DataFrame,
) -> DataFrame:
    """Customers with their lookups, numbered in the order of their stored id."""
    numbered = surrogate_key(
        customers.select(
            "CustomerID",
            "CustomerName",
            "CustomerCategoryID",
            "DeliveryCityID",
            "BuyingGroupID",
            "DeliveryMethodID",
        ),
        ["CustomerID"],
        "CustomerKey",
    )
    joined = join_lookups(
        numbered,
        [
            (
                categories.select("CustomerCategoryID", "CustomerCategoryName"),
                "CustomerCategoryID",
                "left",
            ),
            (
                cities.select("CityID", "CityName", "StateProvinceID"),
                ("DeliveryCityID", "CityID"),
                "left",
            ),
            (
                states.select("StateProvinceID", "StateProvinceName", "SalesTerritory", "CountryID"),
                "StateProvinceID",
                "left",
            ),
            (
                countries.select("CountryID", "CountryName", "Continent", "Region", "Subregion"),
                "CountryID",
                "left",
            ),
            (buying_groups.select("BuyingGroupID", "BuyingGroupName"), "BuyingGroupID", "left"),
            (
                delivery_methods.select("DeliveryMethodID", "DeliveryMethodName"),
                "DeliveryMethodID",
                "left",
            ),
        ],
    )
    return joined.select(
        "CustomerKey",
        F.col("CustomerID").cast("int").alias("CustomerID"),
        "CustomerName",
        "CustomerCategoryName",
        "BuyingGroupName",
        "DeliveryMethodName",
        F.col("CityName").alias("DeliveryCityName"),
        F.col("StateProvinceName").alias("DeliveryStateProvinceName"),
        F.col("SalesTerritory").alias("DeliverySalesTerritory"),
        F.col("CountryName").alias("DeliveryCountry"),
        F.col("Continent").alias("DeliveryContinent"),
        F.col("Region").alias("DeliveryRegion"),
        F.col("Subregion").alias("DeliverySubregion"),
        F.lit(VALID_FROM).alias("ValidFromDate"),
    )


def dim_stock_item(stock_items: DataFrame, colors: DataFrame, package_types: DataFrame) -> DataFrame:
    """Stock items with colour and outer package, numbered in the order of their stored id."""
    numbered = surrogate_key(
        stock_items.select(
            "StockItemID", "StockItemName", "LeadTimeDays", "ColorID", "OuterPackageID", "SupplierID"
        ),
        ["StockItemID"],
        "StockItemKey",
    )
    joined = join_lookups(
        numbered,
        [
            (colors.select("ColorID", "ColorName"), "ColorID", "left"),
            (
                package_types.select("PackageTypeID", "PackageTypeName"),
                ("OuterPackageID", "PackageTypeID"),
                "left",
            ),
        ],
    )
    return joined.select(
        "StockItemKey",
        F.col("StockItemID").cast("int").alias("StockItemID"),
        "StockItemName",
        "LeadTimeDays",
        "ColorName",
        F.col("PackageTypeName").alias("OuterPackageTypeName"),
        F.lit(VALID_FROM).alias("ValidFromDate"),
        F.col("SupplierID").cast("int").alias("SupplierID"),
    )


def dim_supplier(suppliers: DataFrame, categories: DataFrame) -> DataFrame:
    """Suppliers with their category, numbered in the order of their stored id."""
    numbered = surrogate_key(
        suppliers.select("SupplierID", "SupplierName", "SupplierCategoryID"),
        ["SupplierID"],
        "SupplierKey",
    )
    joined = join_lookups(
        numbered,
        [
            (
                categories.select("SupplierCategoryID", "SupplierCategoryName"),
                "SupplierCategoryID",
                "left",
            )
        ],
    )
    return joined.select(
        "SupplierKey",
        F.col("SupplierID").cast("int").alias("SupplierID"),
        "SupplierName",
        "SupplierCategoryName",
        F.lit(VALID_FROM).alias("ValidFromDate"),
    )


DIM_DATE_TYPES = {
    "DateKey": "int",
    "Date": "date",
    "Day": "tinyint",
    "WeekDay": "tinyint",
    "WeekDayName": "string",
    "Month": "tinyint",
    "MonthName": "string",
    "Quarter": "tinyint",
    "Year": "smallint",
}


def dim_date(dates: DataFrame) -> DataFrame:
    """The date file with typed columns."""
    return cast_columns(dates.select(*DIM_DATE_TYPES), DIM_DATE_TYPES)


def fact_sales(
    lines: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    stock_items: DataFrame,
    suppliers: DataFrame,
) -> DataFrame:
    """Order lines with the surrogate keys of customer, item and supplier, and a date key.

    The silver columns may be text, so their keys are cast to the type of the dimension
    keys. Lines and orders meet last: the dimensions are usually small enough to join
    where the rows lie, and only the line-order join is a shuffle.
    """
    items = join_lookups(
        stock_items.select("StockItemKey", "StockItemID", "SupplierID"),
        [(suppliers.select("SupplierKey", "SupplierID"), "SupplierID", "inner")],
    )
    sold = join_lookups(
        lines.select(
            F.col("OrderID").cast("int").alias("OrderID"),
            F.col("OrderLineID").cast("int").alias("OrderLineID"),
            F.col("StockItemID").cast("int").alias("StockItemID"),
            F.col("Quantity").cast("int").alias("SalesOrderQuantity"),
            F.col("UnitPrice").cast(MONEY).alias("SalesOrderUnitPrice"),
        ),
        [(items, "StockItemID", "inner")],
    )
    ordered = join_lookups(
        orders.select(
            F.col("OrderID").cast("int").alias("OrderID"),
            F.col("CustomerID").cast("int").alias("CustomerID"),
            date_key(F.col("OrderDate").cast("date")).alias("OrderDateKey"),
        ),
        [(customers.select("CustomerKey", "CustomerID"), "CustomerID", "inner")],
    )
    return sold.join(ordered, "OrderID").select(
        "CustomerKey",
        "OrderDateKey",
        "StockItemKey",
        "SupplierKey",
        "OrderID",
        "OrderLineID",
        "SalesOrderQuantity",
        "SalesOrderUnitPrice",
    )
