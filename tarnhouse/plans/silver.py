"""Silver views over the bronze tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.functions.dates import years_customer
from tarnhouse.functions.numbers import extended_price, latest_of_two
from tarnhouse.functions.text import area_code, null_default
from tarnhouse.operators.filters import filter_flag
from tarnhouse.operators.joins import join_header_line, join_lookups
from tarnhouse.sources.files import scan_csv_text
from tarnhouse.sources.lake import LakeTable

# Silver table and the bronze file or glob it is loaded from.
SILVER_FILES = {
    "silver_BuyingGroups": "BuyingGroups.csv",
    "silver_Cities": "Cities.csv",
    "silver_Colors": "Colors.csv",
    "silver_Countries": "Countries.csv",
    "silver_CustomerCategories": "CustomerCategories.csv",
    "silver_Customers": "Customers.csv",
    "silver_Date": "Date.csv",
    "silver_DeliveryMethods": "DeliveryMethods.csv",
    "silver_PackageTypes": "PackageTypes.csv",
    "silver_People": "People.csv",
    "silver_SalesOrder": "SalesOrder/*/*.csv",
    "silver_SalesOrderLine": "SalesOrderLine/*/*.csv",
    "silver_StateProvinces": "StateProvinces.csv",
    "silver_StockItems": "StockItems.csv",
    "silver_SupplierCategories": "SupplierCategories.csv",
    "silver_Suppliers": "Suppliers.csv",
}


def load_silver(spark: SparkSession, folder: str, root: str, tables: list[str] | None = None) -> dict[str, int]:
    """Overwrite silver tables from pipe-delimited bronze files; returns rows per table."""
    return {
        name: LakeTable(spark, f"{root}/{name}").overwrite(
            scan_csv_text(spark, f"{folder}/{SILVER_FILES[name]}")
        )
        for name in tables or SILVER_FILES
    }


def v_customer_delivered_to(
    customers: DataFrame,
    buying_groups: DataFrame,
    cities: DataFrame,
    states: DataFrame,
    countries: DataFrame,
    as_of: date | None = None,
) -> DataFrame:
    """Customers with where they are delivered to, their buying group and tenure.

    A customer whose city, state or country is unknown is left out.
    """
    joined = join_lookups(
        customers,
        [
            (buying_groups.select("BuyingGroupID", "BuyingGroupName"), "BuyingGroupID", "left"),
            (
                cities.select("CityID", "CityName", "StateProvinceID"),
                ("DeliveryCityID", "CityID"),
                "inner",
            ),
            (
                states.select("StateProvinceID", "StateProvinceName", "CountryID", "SalesTerritory"),
                "StateProvinceID",
                "inner",
            ),
            (
                countries.select("CountryID", "CountryName", "Region", "Subregion", "Continent"),
                "CountryID",
                "inner",
            ),
        ],
    )
    return joined.select(
        years_customer("AccountOpenedDate", as_of).alias("YearsCustomer"),
        "BuyingGroupID",
        null_default("BuyingGroupName", "Undefined").alias("BuyingGroupName"),
        "CreditLimit",
        "CustomerCategoryID",
        "CustomerID",
        "CustomerName",
        "DeliveryCityID",
        F.col("CityName").alias("DeliveryCity"),
        F.col("StateProvinceName").alias("DeliveryStateProvince"),
        F.col("CountryName").alias("DeliveryCountry"),
        "Region",
        "Subregion",
        "Continent",
        "SalesTerritory",
        "DeliveryPostalCode",
        "IsOnCreditHold",
        "PaymentDays",
        area_code("PhoneNumber").alias("AreaCode"),
    )


def v_products(stock_items: DataFrame, suppliers: DataFrame, colors: DataFrame) -> DataFrame:
    """Stock items with supplier and colour; items without either are left out."""
    joined = join_lookups(
        stock_items,
        [
            (suppliers.select("SupplierID", "SupplierName"), "SupplierID", "inner"),
            (colors.select("ColorID", "ColorName"), "ColorID", "inner"),
        ],
    )
    return joined.select(
        null_default("Brand", "No Brand").alias("Brand"),
        "ColorName",
        "LeadTimeDays",
        "StockItemID",
        "StockItemName",
        "SupplierID",
        "SupplierName",
    )


def v_salesperson(people: DataFrame) -> DataFrame:
    return filter_flag(people, "IsSalesperson").select("PersonID", "FullName")


def v_invoiced_sales(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Invoice lines with their invoice, and the later of the two edit times."""
    header = invoices.select(
        "InvoiceID",
        "CustomerID",
        "SalespersonPersonID",
        "InvoiceDate",
        F.col("LastEditedWhen").alias("_edited"),
    )
    return join_header_line(header, lines, "InvoiceID").select(
        "InvoiceID",
        "InvoiceLineID",
        "CustomerID",
        "StockItemID",
        "SalespersonPersonID",
        "InvoiceDate",
        latest_of_two("_edited", "LastEditedWhen").alias("LastUpdated"),
        "Quantity",
        "ExtendedPrice",
        F.col("LineProfit").alias("GrossProfit"),
        "TaxAmount",
    )


def v_sales_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order lines with their order, their value and the later of the two edit times."""
    header = orders.select(
        "OrderID",
        "CustomerID",
        "SalespersonPersonID",
        "OrderDate",
        F.col("LastEditedWhen").alias("_edited"),
    )
    return join_header_line(header, lines, "OrderID").select(
        "OrderID",
        "OrderLineID",
        "CustomerID",
        "StockItemID",
        "SalespersonPersonID",
        "OrderDate",
        "Quantity",
        extended_price("Quantity", "UnitPrice").alias("ExtendedPrice"),
        latest_of_two("_edited", "LastEditedWhen").alias("LastUpdated"),
    )
