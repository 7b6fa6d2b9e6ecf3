"""The gold star as stored tables: dimensions with their keys once, the fact by month."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.plans.gold import fact_sales
from tarnhouse.session import child_names
from tarnhouse.sources.files import export_parquet, write_partitioned

CUSTOMER, ITEM, SUPPLIER, DATE = "DimCustomer", "DimStockItem", "DimSupplier", "DimDate"
FACT = "FactSales"
MONTH = "OrderMonth"


@dataclass(frozen=True)
class Star:
    """The tables of a star below ``root``, as plain Parquet.

    Surrogate keys are given when a dimension is stored and read from there on, so that facts
    stored at different times agree. The fact lies in one folder per month of its date key.
    """

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def stored(self, name: str) -> bool:
        """Whether a table has files, which a write that fails does not leave."""
        return any(n.startswith(("part-", f"{MONTH}=")) for n in child_names(self.spark, self.path(name)))

    def store_dimensions(self, dimensions: Mapping[str, DataFrame], again: bool = False) -> list[str]:
        """Store the dimensions that are not there yet, or all of them anew; returns which."""
        stored = [name for name in dimensions if again or not self.stored(name)]
        for name in stored:
            export_parquet(dimensions[name], self.path(name), "overwrite")
        return stored

    def store_fact(self, lines: DataFrame, orders: DataFrame) -> None:
        """Store order lines with the keys of the stored dimensions; of these only key and id are read."""
        rows = fact_sales(lines, orders, *(self.read(name) for name in (CUSTOMER, ITEM, SUPPLIER)))
        write_partitioned(rows.withColumn(MONTH, F.expr("OrderDateKey div 100").cast("int")), self.path(FACT), MONTH)

    def sales(self) -> DataFrame:
        """The fact without its month."""
        return self.read(FACT).drop(MONTH)

    def sales_on(self, days: Column | None = None) -> DataFrame:
        """The fact with the columns of its dates, of which ``days`` picks some.

        The month is part of the join, so what is picked of the dates prunes folders of the
        fact, whatever column of the dates it speaks of.
        """
        dates = self.read(DATE)
        if days is not None:
            dates = dates.filter(days)
        dates = dates.withColumn(MONTH, F.expr("DateKey div 100").cast("int")).withColumnRenamed("DateKey", "OrderDateKey")
        return self.read(FACT).join(dates, [MONTH, "OrderDateKey"]).drop(MONTH)


def sales_by(sales: DataFrame, *by: str) -> DataFrame:
    """Quantity and value by columns of the fact's dimensions."""
    value = F.col("SalesOrderQuantity") * F.col("SalesOrderUnitPrice")
    return sales.groupBy(*by).agg(
        F.sum("SalesOrderQuantity").alias("SalesOrderQuantity"), F.sum(value).cast("decimal(38,2)").alias("SalesValue")
    )
