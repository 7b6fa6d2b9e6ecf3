"""Queries for column shaping and filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.catalogue import model as m
from tarnhouse.catalogue.registry import query
from tarnhouse.functions import dates as D
from tarnhouse.functions import numbers as N
from tarnhouse.functions import text as T
from tarnhouse.operators import filters as fl
from tarnhouse.operators import shaping as sh
from tarnhouse.plans.stages import GEOGRAPHY


@query(
    "drop_unsupported",
    m.sql("SELECT * EXCLUDE (DeliveryLocation) FROM m_customers"),
)
def drop_unsupported(spark: SparkSession, sf: str) -> DataFrame:
    return sh.drop_unsupported(m.customers(spark, sf), *GEOGRAPHY["Customers"])


@query(
    "rename_columns",
    "SELECT l_orderkey AS OrderID, l_linenumber AS OrderLineID, l_quantity AS Quantity FROM lineitem",
)
def rename_columns(spark: SparkSession, sf: str) -> DataFrame:
    lines = m.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return sh.rename_columns(
        lines, {"l_orderkey": "OrderID", "l_linenumber": "OrderLineID", "l_quantity": "Quantity"}
    )


@query("select_columns", "SELECT o_orderkey, o_orderdate FROM orders")
def select_columns(spark: SparkSession, sf: str) -> DataFrame:
    return sh.select_columns(m.table(spark, sf, "orders"), "o_orderkey", "o_orderdate")


@query(
    "remove_columns",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders",
)
def remove_columns(spark: SparkSession, sf: str) -> DataFrame:
    return sh.remove_columns(m.table(spark, sf, "orders"), "o_totalprice", "o_orderpriority")


@query(
    "combine_columns",
    """SELECT p_partkey, concat_ws(' ', p_name, nullif(p_brand, 'Brand#1'), p_type) AS Product,
    p_size, p_retailprice FROM part""",
)
def combine_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A missing brand is left out together with its delimiter."""
    part = m.table(spark, sf, "part").withColumn("p_brand", F.nullif(F.col("p_brand"), F.lit("Brand#1")))
    return sh.combine_columns(part, ["p_name", "p_brand", "p_type"], "Product")


@query(
    "replace_text",
    """SELECT c_custkey, replace(replace(c_mktsegment, 'M', 'Male'), 'F', 'Female') AS c_mktsegment
    FROM customer""",
)
def replace_text(spark: SparkSession, sf: str) -> DataFrame:
    customers = m.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return sh.replace_text(customers, "c_mktsegment", ("M", "Male"), ("F", "Female"))


@query(
    "split_column",
    """SELECT p_partkey, string_split(p_name, ' ')[1] AS "Name.1", string_split(p_name, ' ')[2] AS "Name.2",
    string_split(p_name, ' ')[3] AS "Name.3", p_brand FROM part""",
)
def split_column(spark: SparkSession, sf: str) -> DataFrame:
    part = m.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return sh.split_column(part, "p_name", " ", ["Name.1", "Name.2", "Name.3"])


@query(
    "cast_columns",
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate,
    TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag FROM lineitem""",
)
def cast_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Strict casts for clean columns, a tolerant one for text that holds no numbers."""
    lines = m.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"
    )
    strict = sh.cast_columns(
        lines,
        {
            "l_orderkey": "string",
            "l_quantity": "int",
            "l_extendedprice": "decimal(18,2)",
            "l_shipdate": "date",
        },
    )
    return sh.cast_columns(strict, {"l_returnflag": "int"}, tolerant=True)


@query(
    "cast_locale",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS OrderDate,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(19,4)) AS TotalPrice FROM orders""",
)
def cast_locale(spark: SparkSession, sf: str) -> DataFrame:
    """Dates such as 1/31/1997 and amounts such as 1,234.50 read back in en-US form."""
    text = m.table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "M/d/yyyy").alias("OrderDate"),
        F.format_number(F.col("o_totalprice").cast(m.MONEY), 2).alias("TotalPrice"),
    )
    return text.select(
        "o_orderkey",
        D.date_from_us_text("OrderDate").alias("OrderDate"),
        N.to_currency("TotalPrice").alias("TotalPrice"),
    )


@query(
    "currency_to_int",
    """SELECT l_orderkey, l_linenumber, CAST(CASE
        WHEN (2 * h) % 2 = 1 AND floor(h) % 2 = 0 THEN floor(h) ELSE floor(h + 0.5) END AS BIGINT) AS half
    FROM (SELECT l_orderkey, l_linenumber,
        CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,3)) AS h
        FROM lineitem)""",
)
def currency_to_int(spark: SparkSession, sf: str) -> DataFrame:
    """Half the quantity ends in .5 every other time; halves go to the even neighbour."""
    half = (F.col("l_quantity").cast("int") * F.lit("0.5").cast("decimal(2,1)")).cast(N.CURRENCY)
    return m.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", N.currency_to_int(half).alias("half")
    )


@query(
    "extended_price",
    m.sql("SELECT OrderID, OrderLineID, Quantity * UnitPrice AS ExtendedPrice FROM m_lines"),
)
def extended_price(spark: SparkSession, sf: str) -> DataFrame:
    return m.lines(spark, sf).select(
        "OrderID", "OrderLineID", N.extended_price("Quantity", "UnitPrice").alias("ExtendedPrice")
    )


@query(
    "latest_of_two",
    m.sql(
        """SELECT l.OrderID, l.OrderLineID,
        CASE WHEN o.e > l.LastEditedWhen THEN o.e ELSE l.LastEditedWhen END AS LastUpdated
        FROM m_lines l JOIN (SELECT OrderID,
            CASE WHEN SalespersonPersonID > 5 THEN LastEditedWhen END AS e FROM m_orders) o
        ON o.OrderID = l.OrderID"""
    ),
)
def latest_of_two(spark: SparkSession, sf: str) -> DataFrame:
    """Some orders have no edit time; their lines keep their own."""
    edited = F.when(F.col("SalespersonPersonID") > 5, F.col("LastEditedWhen"))
    orders = m.orders(spark, sf).select("OrderID", edited.alias("edited"))
    return (
        m.lines(spark, sf)
        .join(orders, "OrderID")
        .select("OrderID", "OrderLineID", N.latest_of_two("edited", "LastEditedWhen").alias("LastUpdated"))
    )


@query(
    "null_default",
    m.sql("SELECT StockItemID, coalesce(Brand, 'No Brand') AS Brand FROM m_items"),
)
def null_default(spark: SparkSession, sf: str) -> DataFrame:
    return m.stock_items(spark, sf).select("StockItemID", T.null_default("Brand", "No Brand").alias("Brand"))


@query(
    "area_code",
    m.sql("SELECT CustomerID, substring(PhoneNumber, 2, 3) AS AreaCode FROM m_customers"),
)
def area_code(spark: SparkSession, sf: str) -> DataFrame:
    return m.customers(spark, sf).select("CustomerID", T.area_code("PhoneNumber").alias("AreaCode"))


AS_OF = date(2024, 3, 1)


@query(
    "years_customer",
    m.sql(
        "SELECT CustomerID, CAST(2024 - year(AccountOpenedDate) AS INTEGER) AS YearsCustomer FROM m_customers"
    ),
)
def years_customer(spark: SparkSession, sf: str) -> DataFrame:
    return m.customers(spark, sf).select(
        "CustomerID", D.years_customer("AccountOpenedDate", AS_OF).alias("YearsCustomer")
    )


@query(
    "date_key",
    m.sql(
        """SELECT OrderID, CAST(year(OrderDate) * 10000 + month(OrderDate) * 100 + day(OrderDate) AS INTEGER)
        AS OrderDateKey FROM m_orders"""
    ),
)
def date_key(spark: SparkSession, sf: str) -> DataFrame:
    return m.orders(spark, sf).select("OrderID", D.date_key("OrderDate").alias("OrderDateKey"))


# -- filters ---------------------------------------------------------------


@query("filter_flag", m.sql("SELECT * FROM m_people WHERE IsSalesperson"))
def filter_flag(spark: SparkSession, sf: str) -> DataFrame:
    return fl.filter_flag(m.people(spark, sf), "IsSalesperson")


@query(
    "filter_date_range",
    "SELECT * FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1996-01-10'",
)
def filter_date_range(spark: SparkSession, sf: str) -> DataFrame:
    return fl.filter_date_range(m.table(spark, sf, "lineitem"), "l_shipdate", "1996-01-01", "1996-01-10")


@query(
    "filter_between",
    "SELECT * FROM lineitem WHERE l_shipdate BETWEEN DATE '1996-01-01' AND DATE '1996-01-10'",
)
def filter_between(spark: SparkSession, sf: str) -> DataFrame:
    return fl.filter_between(m.table(spark, sf, "lineitem"), "l_shipdate", "1996-01-01", "1996-01-10")


@query(
    "window_predicate",
    """SELECT event_id, ts, 'closed' AS part FROM events
    WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-20'
    UNION ALL SELECT event_id, ts, 'open' AS part FROM events WHERE ts >= TIMESTAMP '2024-01-20'""",
)
def window_predicate(spark: SparkSession, sf: str) -> DataFrame:
    """A window with an end and one without; together they hold each later event once."""
    events = m.table(spark, sf, "events").select("event_id", "ts")
    closed = events.filter(fl.window_predicate(events, "ts", "2024-01-05 06:00:00", "2024-01-20"))
    rest = events.filter(fl.window_predicate(events, "ts", "2024-01-20"))
    return closed.withColumn("part", F.lit("closed")).unionByName(rest.withColumn("part", F.lit("open")))


@query(
    "filter_enabled",
    "SELECT p_name AS sinktable, p_partkey AS id, p_size > 25 AS skipload FROM part WHERE NOT p_size > 25",
)
def filter_enabled(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as control rows, the large ones skipped; a stage that is off adds nothing."""
    control = m.table(spark, sf, "part").select(
        F.col("p_name").alias("sinktable"),
        F.col("p_partkey").alias("id"),
        (F.col("p_size") > 25).alias("skipload"),
    )
    return fl.filter_enabled(control, 1).unionByName(fl.filter_enabled(control, 0))


@query("filter_year", "SELECT * FROM orders WHERE year(o_orderdate) = 1997")
def filter_year(spark: SparkSession, sf: str) -> DataFrame:
    return fl.filter_year(m.table(spark, sf, "orders"), "o_orderdate", 1997)
