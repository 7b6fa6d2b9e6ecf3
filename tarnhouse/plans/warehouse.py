"""Schemas of the warehouse tables, which exist before anything is loaded into them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tarnhouse.session import local_rows
from tarnhouse.sources.lake import LakeTable
from tarnhouse.sources.monthly import MonthlyTable

# Table and columns.
TABLES = {
    "Calendar": "Date date, DayNum smallint, DayOfWeek string, DayOfWeekNum smallint, "
    "Month string, MonthNum smallint, QuarterNum smallint, Quarter string, Year smallint",
    "Customer": "YearsCustomer int, BuyingGroupID int, BuyingGroupName string, "
    "CreditLimit decimal(10,2), CustomerCategoryID int, CustomerID int, CustomerName string, "
    "DeliveryCityID int, DeliveryCity string, DeliveryStateProvince string, "
    "DeliveryCountry string, Region string, Subregion string, Continent string, "
    "SalesTerritory string, DeliveryPostalCode string, IsOnCreditHold boolean, "
    "PaymentDays int, AreaCode string",
    "InvoicedSales": "InvoiceID int, InvoiceLineID int, CustomerID int, StockItemID int, "
    "SalespersonPersonID int, InvoiceDate date, LastUpdated timestamp_ntz, Quantity int, "
    "ExtendedPrice decimal(18,2), GrossProfit decimal(18,2), TaxAmount decimal(18,2)",
    "Products": "StockItemID int, StockItemName string, SupplierID int, SupplierName string, "
    "Brand string, ColorName string, LeadTimeDays int",
    "SalesOrders": "OrderID int, OrderLineID int, CustomerID int, StockItemID int, "
    "SalespersonPersonID int, OrderDate date, Quantity int, ExtendedPrice decimal(18,2), "
    "LastUpdated timestamp_ntz",
    "Salesperson": "PersonID int, FullName string",
}

# Upsert keys and mark of the tables loaded incrementally.
INCREMENTAL_KEYS = {
    "InvoicedSales": ("InvoiceID", "InvoiceLineID"),
    "SalesOrders": ("OrderID", "OrderLineID"),
}

# The dates by which these facts lie in months.
DATES = {"InvoicedSales": "InvoiceDate", "SalesOrders": "OrderDate"}

WarehouseTable = LakeTable | MonthlyTable


def warehouse_fact(spark: SparkSession, path: str, name: str) -> MonthlyTable | None:
    """A fact of the warehouse at its path, in months, which increments replace one by one; None for others."""
    if name not in DATES:
        return None
    return MonthlyTable(spark, path, TABLES[name], DATES[name], INCREMENTAL_KEYS[name], "LastUpdated")


def warehouse_table(spark: SparkSession, root: str, name: str) -> WarehouseTable:
    path = f"{root}/{name}"
    return warehouse_fact(spark, path, name) or LakeTable(spark, path)


def create_tables(spark: SparkSession, root: str) -> None:
    """Create every warehouse table empty, dropping what it held."""
    for name, schema in TABLES.items():
        warehouse_table(spark, root, name).overwrite(local_rows(spark, [], schema))
