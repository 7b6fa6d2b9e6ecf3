"""The stages of a whole run: bronze tables, calendar, silver views, gold, warehouse."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tarnhouse.operators.shaping import drop_unsupported
from tarnhouse.plans import silver
from tarnhouse.plans.calendars import build_calendar, v_calendar
from tarnhouse.plans.loads import LoadResult, TableFunction, run_loads
from tarnhouse.sources import database
from tarnhouse.sources.lake import LakeTable

Source = database.Source | TableFunction

# Columns left out of a source table because they hold geography.
GEOGRAPHY = {
    "Cities": ["Location"],
    "Countries": ["Border"],
    "StateProvinces": ["Border"],
    "Suppliers": ["DeliveryLocation"],
    "Customers": ["DeliveryLocation"],
}
NO_GEOGRAPHY = "NoGeography"


@dataclass(frozen=True)
class WithoutGeography:
    """A database source that also answers for its tables without their geography columns."""

    source: database.Source

    def read(self, spark: SparkSession, schema: str, table: str, *window) -> DataFrame:
        return narrowed(table, lambda base: self.source.read(spark, schema, base, *window))


def narrowed(table: str, read: Callable[[str], DataFrame]) -> DataFrame:
    base = table.removesuffix(NO_GEOGRAPHY)
    return drop_unsupported(read(base), *GEOGRAPHY[base]) if base != table else read(table)


def without_geography(source: Source) -> Source:
    """The source, or function of schema and table, with its tables without geography too."""
    if hasattr(source, "read"):
        return WithoutGeography(source)
    return lambda schema, table: narrowed(table, lambda base: source(schema, base))


def silver_source(spark: SparkSession, root: str, as_of: date | None = None) -> Source:
    """The silver views over the bronze tables below ``root``, by view name."""

    def bronze(name: str) -> DataFrame:
        return LakeTable(spark, f"{root}/Tables/{name}").read()

    views: dict[str, Callable[[], DataFrame]] = {
        "vCalendar": lambda: v_calendar(bronze("Calendar")),
        "vCustomerDeliveredTo": lambda: silver.v_customer_delivered_to(
            bronze("Customers"),
            bronze("BuyingGroups"),
            bronze("Cities"),
            bronze("StateProvinces"),
            bronze("Countries"),
            as_of,
        ),
        "vProducts": lambda: silver.v_products(
            bronze("StockItems"), bronze("Suppliers"), bronze("Colors")
        ),
        "vSalesperson": lambda: silver.v_salesperson(bronze("People")),
        "vInvoicedSales": lambda: silver.v_invoiced_sales(bronze("Invoices"), bronze("InvoiceLines")),
        "vSalesOrders": lambda: silver.v_sales_orders(bronze("Orders"), bronze("OrderLines")),
    }
    return lambda schema, view: views[view]()


@dataclass(frozen=True)
class Controls:
    """The control tables of the three stages."""

    bronze: LakeTable
    gold: LakeTable
    warehouse: LakeTable | None = None


def run_stages(
    spark: SparkSession,
    controls: Controls,
    source: Source,
    root: str,
    start_year: int = 2013,
    end_year: int = 2025,
    load_bronze: int = 1,
    load_gold: int = 1,
    load_warehouse: int = 0,
    batch: datetime | None = None,
    as_of: date | None = None,
    layouts: Mapping[str, str] | None = None,
) -> dict[str, dict[str, LoadResult]]:
    """Load bronze and the calendar, then gold and the warehouse from the silver views.

    Tables go to ``<root>/bronze``, ``<root>/gold`` and ``<root>/warehouse``. A flag of 0
    leaves its stage out; the calendar is always built.
    """
    bronze_root = f"{root}/bronze"
    views = silver_source(spark, bronze_root, as_of)
    done = {
        "bronze": run_loads(
            spark,
            controls.bronze,
            without_geography(source),
            bronze_root,
            load_bronze,
            batch=batch,
            layouts=layouts,
        )
    }
    LakeTable(spark, f"{bronze_root}/Tables/Calendar").overwrite(
        build_calendar(spark, start_year, end_year)
    )
    done["gold"] = run_loads(
        spark, controls.gold, views, f"{root}/gold", load_gold, batch=batch, layouts=layouts
    )
    if controls.warehouse:
        done["warehouse"] = run_loads(
            spark,
            controls.warehouse,
            views,
            f"{root}/warehouse",
            load_warehouse,
            warehouse=True,
            batch=batch,
            layouts=layouts,
        )
    return done
