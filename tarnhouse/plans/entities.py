"""The Customer, Product and Sales entities, shaped from their CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.functions.dates import date_from_us_text
from tarnhouse.functions.numbers import currency_to_int, text_to_int, to_currency
from tarnhouse.operators.shaping import (
    cast_columns,
    combine_columns,
    remove_columns,
    rename_columns,
    replace_text,
    select_columns,
    split_column,
)


def entity_customer(raw: DataFrame) -> DataFrame:
    """Customers with one name column, a spelled-out gender and a typed birth date."""
    df = cast_columns(raw, {"CustomerId": "long", "Zipcode": "long"})
    df = select_columns(
        df,
        "CustomerId",
        "FirstName",
        "LastName",
        "Address",
        "City",
        "State",
        "Zipcode",
        "Gender",
        "BirthDate",
        "FirstPurchaseDate",
        "LastPurchaseDate",
    )
    df = combine_columns(df, ["FirstName", "LastName"], "Customer", " ")
    df = replace_text(df, "Gender", ("M", "Male"), ("F", "Female"))
    df = split_column(df, "BirthDate", " ", ["BirthDate.1", "BirthDate.2"])
    df = remove_columns(df, "BirthDate.2")
    df = df.withColumn("BirthDate.1", date_from_us_text("`BirthDate.1`"))
    return rename_columns(df, {"BirthDate.1": "BirthDate"})


def entity_product(raw: DataFrame) -> DataFrame:
    """Products with category and subcategory, and amounts rounded to whole numbers."""
    df = raw.withColumns({c: to_currency(c) for c in ("UnitCost", "ListPrice")})
    df = df.withColumns({c: currency_to_int(c) for c in ("UnitCost", "ListPrice")})
    df = cast_columns(df, {"ProductId": "long", "MinimumAge": "long", "MaximumAge": "long"})
    df = rename_columns(df, {"Title": "Product"})
    df = split_column(
        df, "ProductCategory", " > ", ["ProductCategory.1", "ProductCategory.2"]
    )
    return rename_columns(
        df, {"ProductCategory.1": "Category", "ProductCategory.2": "SubCategory"}
    )


def entity_sales(raw: DataFrame, date_pattern: str = "dd/MM/yyyy") -> DataFrame:
    """Invoice lines; the date is read in en-US form and kept as text in the model's form."""
    df = raw.withColumn("InvoiceDate", date_from_us_text("InvoiceDate"))
    whole = ("Id", "Quantity", "SalesAmount", "InvoiceId", "ProductId")
    df = df.withColumns({c: text_to_int(c) for c in whole})
    df = df.withColumn("InvoiceDate", F.date_format("InvoiceDate", date_pattern))
    return rename_columns(df, {"Id": "CustomerId"})
