"""Control tables: which tables are loaded, how, from which mark, and how it went."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tarnhouse.operators.sets import union_distinct
from tarnhouse.session import local_rows

RUN_COLUMNS = (
    "batchloaddatetime timestamp_ntz, loadstatus string, rowsread long, rowscopied long, "
    "rowsinserted long, rowsupdated long, maxdatetime timestamp_ntz, "
    "pipelinestarttime timestamp_ntz, pipelineendtime timestamp_ntz"
)

CONTROL = (
    "pipelinename string, sourceschema string, sourcetable string, datecolumn string, "
    "startdate timestamp_ntz, enddate timestamp_ntz, sinkschema string, sinktable string, "
    f"loadtype string, tablekey string, tablekey2 string, skipload boolean, {RUN_COLUMNS}"
)

# The columns that identify a control row.
CONTROL_KEYS = ("sourceschema", "sourcetable", "sinkschema", "sinktable")

FULL, INCREMENTAL = "full", "incremental"
START = "2013-01-01 00:00:00"
WEEK_END = "2013-01-08 00:00:00"

# Source schema, source table, date column, end of the first window,
# target table, load type, key, second key.
BRONZE = [
    ("Application", "CitiesNoGeography", "ValidFrom", None, "Cities", FULL, None, None),
    ("Application", "CountriesNoGeography", "ValidFrom", None, "Countries", FULL, None, None),
    ("Application", "DeliveryMethods", "ValidFrom", None, "DeliveryMethods", FULL, None, None),
    ("Application", "People", "ValidFrom", None, "People", FULL, None, None),
    ("Application", "StateProvincesNoGeography", "ValidFrom", None, "StateProvinces", FULL, None, None),
    ("Purchasing", "SupplierCategories", "ValidFrom", None, "SupplierCategories", FULL, None, None),
    ("Purchasing", "SuppliersNoGeography", "ValidFrom", None, "Suppliers", FULL, None, None),
    ("Sales", "BuyingGroups", "ValidFrom", None, "BuyingGroups", FULL, None, None),
    ("Sales", "CustomerCategories", "ValidFrom", None, "CustomerCategories", FULL, None, None),
    ("Sales", "CustomersNoGeography", "ValidFrom", None, "Customers", FULL, None, None),
    ("Sales", "InvoiceLines", "LastEditedWhen", WEEK_END, "InvoiceLines", INCREMENTAL, "InvoiceLineID", None),
    ("Sales", "Invoices", "LastEditedWhen", WEEK_END, "Invoices", INCREMENTAL, "InvoiceID", None),
    ("Sales", "OrderLines", "LastEditedWhen", WEEK_END, "OrderLines", INCREMENTAL, "OrderLineID", None),
    ("Sales", "Orders", "LastEditedWhen", WEEK_END, "Orders", INCREMENTAL, "OrderID", None),
    ("Warehouse", "Colors", "ValidFrom", None, "Colors", FULL, None, None),
    ("Warehouse", "PackageTypes", "ValidFrom", None, "PackageTypes", FULL, None, None),
    ("Warehouse", "StockGroups", "ValidFrom", None, "StockGroups", FULL, None, None),
    ("Warehouse", "StockItems", "ValidFrom", None, "StockItems", FULL, None, None),
    ("Warehouse", "StockItemStockGroups", "LastEditedWhen", None, "StockItemStockGroups", FULL, None, None),
]

GOLD = [
    ("Silver", "vCustomerDeliveredTo", None, None, "Customer", FULL, None, None),
    ("Silver", "vInvoicedSales", "LastUpdated", None, "InvoicedSales", INCREMENTAL, "InvoiceID", "InvoiceLineID"),
    ("Silver", "vProducts", None, None, "Product", FULL, None, None),
    ("Silver", "vSalesperson", None, None, "Salesperson", FULL, None, None),
    ("Silver", "vCalendar", None, None, "Calendar", FULL, None, None),
    ("Silver", "vSalesOrders", "LastUpdated", None, "SalesOrders", INCREMENTAL, "OrderID", "OrderLineID"),
]

# The warehouse takes the same views; its product table has another name.
WAREHOUSE = [(*row[:4], "Products" if row[4] == "Product" else row[4], *row[5:]) for row in GOLD]


def control_rows(spark: SparkSession, pipeline: str, rows: list[tuple], sink_schema: str | None = None) -> DataFrame:
    """Control rows from a list such as ``BRONZE``: nothing skipped and nothing run yet.

    Rows with a date column start at the first mark.
    """
    run = (None,) * len(RUN_COLUMNS.split(","))
    values = [
        (
            pipeline, schema, table, column,
            datetime.fromisoformat(START) if column else None,
            datetime.fromisoformat(end) if end else None,
            sink_schema, sink, kind, key, key2, False, *run,
        )
        for schema, table, column, end, sink, kind, key, key2 in rows
    ]
    return local_rows(spark, values, CONTROL)


def control_table(*parts: DataFrame) -> DataFrame:
    """Control rows from several lists, each different row once."""
    return union_distinct(*parts)
