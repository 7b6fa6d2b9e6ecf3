"""The given tables in the shapes the operators expect, in Spark and in SQL.

Each function is a projection or a small lookup over a given table; ``CTE`` holds the
same in SQL and ``sql`` puts the needed parts in front of a query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.plans.calendars import build_calendar

MONEY = "decimal(18,2)"

# Declared columns of the given tables, which spare Spark a look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def year_range(spark: SparkSession, sf: str) -> tuple[int, int]:
    """The first and the last year with orders, for the calendars."""
    days = table(spark, sf, "orders").agg(F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
    low, high = days.first()
    return (low.year, high.year) if low else (1995, 1995)


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return build_calendar(spark, *year_range(spark, sf))


def report_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar without the first day of each month: reports meet a blank group."""
    return calendar(spark, sf).filter("daynum > 1")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, the way silver tables loaded from CSV hold them."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.length("o_orderpriority").alias("SalespersonPersonID"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
        F.col("o_orderdate").alias("LastEditedWhen"),
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_linenumber").alias("OrderLineID"),
        F.col("l_partkey").alias("StockItemID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("UnitPrice"),
        F.col("l_discount").cast(MONEY).alias("LineProfit"),
        F.col("l_tax").cast(MONEY).alias("TaxAmount"),
        F.col("l_shipdate").alias("LastEditedWhen"),
    )


def invoices(spark: SparkSession, sf: str) -> DataFrame:
    return orders(spark, sf).withColumnsRenamed({"OrderID": "InvoiceID", "OrderDate": "InvoiceDate"})


def invoice_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).withColumnsRenamed(
        {"OrderID": "InvoiceID", "OrderLineID": "InvoiceLineID", "UnitPrice": "ExtendedPrice"}
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("CustomerName"),
        F.col("c_mktsegment").alias("CustomerCategoryID"),
        F.col("c_mktsegment").alias("BuyingGroupID"),
        F.col("c_nationkey").alias("DeliveryMethodID"),
        F.col("c_nationkey").alias("DeliveryCityID"),
        F.col("c_acctbal").cast(MONEY).alias("CreditLimit"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("c_nationkey") * 100).alias(
            "AccountOpenedDate"
        ),
        (F.col("c_acctbal") < 0).alias("IsOnCreditHold"),
        (F.col("c_nationkey") + 7).alias("PaymentDays"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("DeliveryPostalCode"),
        F.concat(
            F.lit("("), F.lpad(F.col("c_nationkey").cast("string"), 3, "3"), F.lit(") 555-0100")
        ).alias("PhoneNumber"),
        F.concat(F.lit("POINT ("), F.col("c_nationkey").cast("string"), F.lit(" 0)")).alias(
            "DeliveryLocation"
        ),
    )


def cities(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("CityID"),
        F.col("n_name").alias("CityName"),
        F.col("n_regionkey").alias("StateProvinceID"),
    )


def states(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(
        F.col("r_regionkey").alias("StateProvinceID"),
        F.col("r_name").alias("StateProvinceName"),
        F.concat(F.lit("Territory "), "r_name").alias("SalesTerritory"),
        F.col("r_regionkey").alias("CountryID"),
    )


def countries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(
        F.col("r_regionkey").alias("CountryID"),
        F.concat(F.lit("Country "), "r_name").alias("CountryName"),
        F.col("r_name").alias("Continent"),
        F.lower("r_name").alias("Region"),
        F.substring("r_name", 1, 2).alias("Subregion"),
    )


def customer_categories(spark: SparkSession, sf: str) -> DataFrame:
    segment = table(spark, sf, "customer").select("c_mktsegment").distinct()
    return segment.select(
        F.col("c_mktsegment").alias("CustomerCategoryID"),
        F.initcap("c_mktsegment").alias("CustomerCategoryName"),
    )


def buying_groups(spark: SparkSession, sf: str) -> DataFrame:
    """One segment has no buying group, so left joins meet a gap."""
    segment = table(spark, sf, "customer").select("c_mktsegment").distinct()
    return segment.filter(F.col("c_mktsegment") != "HOUSEHOLD").select(
        F.col("c_mktsegment").alias("BuyingGroupID"),
        F.concat(F.lit("Group "), "c_mktsegment").alias("BuyingGroupName"),
    )


def delivery_methods(spark: SparkSession, sf: str) -> DataFrame:
    """Nations of the first region have no delivery method."""
    return (
        table(spark, sf, "nation")
        .filter(F.col("n_regionkey") != 0)
        .select(
            F.col("n_nationkey").alias("DeliveryMethodID"),
            F.concat(F.lit("Via "), "n_name").alias("DeliveryMethodName"),
        )
    )


def stock_items(spark: SparkSession, sf: str) -> DataFrame:
    """Parts; the supplier is the lowest one that ever delivered the part."""
    supplied = (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(F.min("l_suppkey").alias("SupplierID"))
    )
    part = table(spark, sf, "part").join(supplied, F.col("p_partkey") == F.col("l_partkey"), "left")
    return part.select(
        F.col("p_partkey").alias("StockItemID"),
        F.col("p_name").alias("StockItemName"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).alias("Brand"),
        F.substring_index("p_name", " ", 1).alias("ColorID"),
        F.col("p_size").alias("LeadTimeDays"),
        F.col("p_type").alias("OuterPackageID"),
        "SupplierID",
        F.col("p_retailprice").cast(MONEY).alias("UnitPrice"),
    )


def colors(spark: SparkSession, sf: str) -> DataFrame:
    """The colour red is not listed, so red items have no colour name."""
    first = table(spark, sf, "part").select(F.substring_index("p_name", " ", 1).alias("ColorID"))
    return (
        first.distinct()
        .filter(F.col("ColorID") != "red")
        .select("ColorID", F.upper("ColorID").alias("ColorName"))
    )


def package_types(spark: SparkSession, sf: str) -> DataFrame:
    kinds = table(spark, sf, "part").select("p_type").distinct()
    return kinds.filter(F.col("p_type") != "SMALL").select(
        F.col("p_type").alias("PackageTypeID"), F.lower("p_type").alias("PackageTypeName")
    )


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("SupplierID"),
        F.col("s_name").alias("SupplierName"),
        F.col("s_nationkey").alias("SupplierCategoryID"),
    )


def supplier_categories(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("SupplierCategoryID"),
        F.concat(F.lit("Category "), "n_name").alias("SupplierCategoryName"),
    )


def people(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("PersonID"),
        F.col("c_name").alias("FullName"),
        (F.col("c_mktsegment") == "MACHINERY").alias("IsSalesperson"),
    )


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """The sales fact at line grain."""
    line = lines(spark, sf).select(
        "OrderID", F.col("StockItemID").alias("ProductKey"), "Quantity", F.col("UnitPrice").alias("Amount")
    )
    order = orders(spark, sf).select(
        "OrderID", F.col("CustomerID").alias("CustomerKey"), F.col("OrderDate").alias("DateKey")
    )
    return line.join(order, "OrderID").select(
        "DateKey", "ProductKey", "CustomerKey", "Quantity", "Amount"
    )


def sales_by_order(spark: SparkSession, sf: str) -> DataFrame:
    """The sales fact summed to orders, for reports that need nothing of the lines.

    The lines are summed before the join, so an order with very many of them is reduced
    on the map side.
    """
    line = lines(spark, sf).groupBy("OrderID").agg(
        F.sum("Quantity").alias("Quantity"), F.sum("UnitPrice").alias("Amount")
    )
    order = orders(spark, sf).select(
        "OrderID", F.col("CustomerID").alias("CustomerKey"), F.col("OrderDate").alias("DateKey")
    )
    return line.join(order, "OrderID").select("DateKey", "CustomerKey", "Quantity", "Amount")


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """Events as trips, all eighteen columns."""
    none = F.lit(0).cast("decimal(10,2)")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("int").alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.expr("ts + INTERVAL 15 MINUTES").alias("tpep_dropoff_datetime"),
        F.length("event_type").alias("passenger_count"),
        none.alias("trip_distance"),
        F.lit(1).alias("RateCodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.lit(1).alias("PULocationID"),
        F.lit(1).alias("DOLocationID"),
        F.lit(1).alias("payment_type"),
        none.alias("fare_amount"),
        none.alias("extra"),
        none.alias("mta_tax"),
        none.alias("tip_amount"),
        none.alias("tolls_amount"),
        none.alias("improvement_surcharge"),
        F.col("value").cast("decimal(10,2)").alias("total_amount"),
        none.alias("congestion_surcharge"),
    )


CTE = {
    "m_orders": """SELECT o_orderkey AS OrderID, o_custkey AS CustomerID,
        CAST(length(o_orderpriority) AS INTEGER) AS SalespersonPersonID,
        CAST(o_orderdate AS DATE) AS OrderDate, o_orderdate AS LastEditedWhen FROM orders""",
    "m_lines": """SELECT l_orderkey AS OrderID, l_linenumber AS OrderLineID,
        l_partkey AS StockItemID, CAST(l_quantity AS INTEGER) AS Quantity,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS UnitPrice,
        CAST(l_discount AS DECIMAL(18,2)) AS LineProfit,
        CAST(l_tax AS DECIMAL(18,2)) AS TaxAmount, l_shipdate AS LastEditedWhen FROM lineitem""",
    "m_customers": """SELECT c_custkey AS CustomerID, c_name AS CustomerName,
        c_mktsegment AS CustomerCategoryID, c_mktsegment AS BuyingGroupID,
        c_nationkey AS DeliveryMethodID, c_nationkey AS DeliveryCityID,
        CAST(c_acctbal AS DECIMAL(18,2)) AS CreditLimit,
        CAST(DATE '1995-01-01' + c_nationkey * 100 AS DATE) AS AccountOpenedDate,
        c_acctbal < 0 AS IsOnCreditHold, c_nationkey + 7 AS PaymentDays,
        lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS DeliveryPostalCode,
        '(' || lpad(CAST(c_nationkey AS VARCHAR), 3, '3') || ') 555-0100' AS PhoneNumber,
        'POINT (' || CAST(c_nationkey AS VARCHAR) || ' 0)' AS DeliveryLocation FROM customer""",
    "m_cities": """SELECT n_nationkey AS CityID, n_name AS CityName,
        n_regionkey AS StateProvinceID FROM nation""",
    "m_states": """SELECT r_regionkey AS StateProvinceID, r_name AS StateProvinceName,
        'Territory ' || r_name AS SalesTerritory, r_regionkey AS CountryID FROM region""",
    "m_countries": """SELECT r_regionkey AS CountryID, 'Country ' || r_name AS CountryName,
        r_name AS Continent, lower(r_name) AS Region, substring(r_name, 1, 2) AS Subregion
        FROM region""",
    "m_categories": """SELECT DISTINCT c_mktsegment AS CustomerCategoryID,
        upper(substring(c_mktsegment, 1, 1)) || lower(substring(c_mktsegment, 2))
        AS CustomerCategoryName FROM customer""",
    "m_groups": """SELECT DISTINCT c_mktsegment AS BuyingGroupID,
        'Group ' || c_mktsegment AS BuyingGroupName FROM customer
        WHERE c_mktsegment <> 'HOUSEHOLD'""",
    "m_methods": """SELECT n_nationkey AS DeliveryMethodID, 'Via ' || n_name AS DeliveryMethodName
        FROM nation WHERE n_regionkey <> 0""",
    "m_items": """SELECT p_partkey AS StockItemID, p_name AS StockItemName,
        nullif(p_brand, 'Brand#1') AS Brand, split_part(p_name, ' ', 1) AS ColorID,
        p_size AS LeadTimeDays, p_type AS OuterPackageID, s.SupplierID,
        CAST(p_retailprice AS DECIMAL(18,2)) AS UnitPrice FROM part LEFT JOIN
        (SELECT l_partkey, min(l_suppkey) AS SupplierID FROM lineitem GROUP BY l_partkey) s
        ON p_partkey = l_partkey""",
    "m_colors": """SELECT DISTINCT split_part(p_name, ' ', 1) AS ColorID,
        upper(split_part(p_name, ' ', 1)) AS ColorName FROM part
        WHERE split_part(p_name, ' ', 1) <> 'red'""",
    "m_packages": """SELECT DISTINCT p_type AS PackageTypeID, lower(p_type) AS PackageTypeName
        FROM part WHERE p_type <> 'SMALL'""",
    "m_suppliers": """SELECT s_suppkey AS SupplierID, s_name AS SupplierName,
        s_nationkey AS SupplierCategoryID FROM supplier""",
    "m_supcats": """SELECT n_nationkey AS SupplierCategoryID,
        'Category ' || n_name AS SupplierCategoryName FROM nation""",
    "m_people": """SELECT c_custkey AS PersonID, c_name AS FullName,
        c_mktsegment = 'MACHINERY' AS IsSalesperson FROM customer""",
    "m_sales": """SELECT o.OrderDate AS DateKey, l.StockItemID AS ProductKey,
        o.CustomerID AS CustomerKey, l.Quantity, l.UnitPrice AS Amount
        FROM m_lines l JOIN m_orders o ON o.OrderID = l.OrderID""",
    "m_days": """SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
        date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate))
        + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)""",
    "m_calendar": """SELECT date, CAST(day(date) AS INTEGER) AS daynum,
        CAST(dayofweek(date) + 1 AS INTEGER) AS dayofweeknum, dayname(date) AS dayofweekname,
        CAST(month(date) AS INTEGER) AS monthnum, monthname(date) AS monthname,
        CAST(quarter(date) AS INTEGER) AS quarternum,
        'Q' || CAST(quarter(date) AS VARCHAR) AS quartername,
        CAST(year(date) AS INTEGER) AS year FROM m_days""",
    "m_report_days": "SELECT * FROM m_calendar WHERE daynum > 1",
    "m_trips": """SELECT CAST(user_id AS INTEGER) AS VendorID,
        CAST(ts AS DATE) AS tpep_pickup_datetime,
        CAST(ts + INTERVAL 15 MINUTE AS DATE) AS tpep_dropoff_datetime,
        CAST(length(event_type) AS INTEGER) AS passenger_count,
        CAST(value AS DECIMAL(10,2)) AS total_amount FROM events""",
}


def sql(body: str, **extra: str) -> str:
    """``body`` behind the CTEs it names; ``extra`` adds CTEs of its own."""
    parts = {**CTE, **extra}
    needed: list[str] = []

    def add(text: str) -> None:
        for name in parts:
            if re.search(rf"\b{name}\b", text) and name not in needed and parts[name] is not text:
                add(parts[name])
                if name not in needed:
                    needed.append(name)

    add(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({parts[n]})" for n in needed) + "\n" + body
