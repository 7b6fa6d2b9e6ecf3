"""Header discounts allocated to lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.functions.numbers import extended_price, safe_divide
from tarnhouse.operators.joins import related_lookup, related_rows


def discount_pct(
    header: DataFrame,
    detail: DataFrame,
    key: str = "OrderId",
    total: str = "TotalDiscount",
    price: str = "UnitPrice",
    quantity: str = "Quantity",
) -> DataFrame:
    """Headers with ``DiscountPct``: the total discount over the value of the lines.

    Null when a header has no lines or their value is zero.
    """
    valued = related_rows(header, detail, key, _value=F.sum(extended_price(quantity, price)))
    return valued.withColumn("DiscountPct", safe_divide(total, "_value")).drop("_value")


def line_discount(
    header: DataFrame,
    detail: DataFrame,
    key: str = "OrderId",
    price: str = "UnitPrice",
    quantity: str = "Quantity",
) -> DataFrame:
    """Lines with ``LineDiscount``, their share of the header's discount."""
    priced = related_lookup(detail, header, key, "DiscountPct")
    return priced.withColumn(
        "LineDiscount", extended_price(quantity, price) * F.col("DiscountPct")
    ).drop("DiscountPct")


def discount_value_correct(
    header: DataFrame,
    detail: DataFrame,
    key: str = "OrderId",
    price: str = "UnitPrice",
    quantity: str = "Quantity",
) -> DataFrame:
    """The discount summed over lines, each weighted by its header's percentage.

    The percentage is constant within a header, so the lines are summed per header
    before they meet it.
    """
    per_header = detail.groupBy(key).agg(F.sum(extended_price(quantity, price)).alias("_value"))
    weighted = related_lookup(per_header, header, key, "DiscountPct")
    return weighted.agg(F.sum(F.col("_value") * F.col("DiscountPct")).alias("DiscountValueCorrect"))


def discount_value(lines: DataFrame) -> DataFrame:
    """The sum of the stored line discounts."""
    return lines.agg(F.sum("LineDiscount").alias("DiscountValue"))
