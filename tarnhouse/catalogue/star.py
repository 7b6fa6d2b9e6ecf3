"""Queries for calendars, silver views, the gold star and the entities."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.catalogue import model as m
from tarnhouse.catalogue.functions import ITALIAN_DAYS
from tarnhouse.catalogue.registry import query
from tarnhouse.plans import calendars as cal
from tarnhouse.plans import entities as en
from tarnhouse.plans import gold, silver
from tarnhouse.plans.star import CUSTOMER, DATE, FACT, ITEM, SUPPLIER, Star, sales_by
from tarnhouse.session import scratch_path
from tarnhouse.sources import files as fs

# -- calendars: each joined to the orders of its days -------------------------


def orders_per_day(spark: SparkSession, sf: str) -> DataFrame:
    return m.orders(spark, sf).groupBy("OrderDate").agg(F.count("*").alias("orders"))


def with_orders(calendar: DataFrame, day: str, spark: SparkSession, sf: str) -> DataFrame:
    """Calendar days with the number of orders placed on them, zero included."""
    counted = calendar.join(orders_per_day(spark, sf), F.col(day) == F.col("OrderDate"), "left")
    return counted.drop("OrderDate").withColumn("orders", F.coalesce("orders", F.lit(0).cast("long")))


PER_DAY = "SELECT OrderDate, count(*) AS orders FROM m_orders GROUP BY OrderDate"


def calendar_sql(columns: str, source: str = "m_calendar", **extra: str) -> str:
    return m.sql(
        f"""SELECT {columns}, coalesce(p.orders, 0) AS orders FROM {source} c
        LEFT JOIN m_per_day p ON p.OrderDate = c.date""",
        m_per_day=PER_DAY,
        **extra,
    )


@query("build_calendar", calendar_sql("c.*"))
def build_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return with_orders(m.calendar(spark, sf), "date", spark, sf)


@query(
    "dim_date_m",
    calendar_sql(
        """date AS FullDateAlternateKey, year AS Year, monthnum AS Month, monthname AS "Month Name",
        quarternum AS Quarter,
        CAST(floor((dayofyear(date) - 1 + isodow(date_trunc('year', date)) - 1) / 7) + 1 AS INTEGER)
            AS "Week of Year",
        CAST(floor((day(date) - 1 + isodow(date_trunc('month', date)) - 1) / 7) + 1 AS INTEGER)
            AS "Week of Month",
        daynum AS Day, CAST(isodow(date) - 1 AS INTEGER) AS "Day of Week",
        CAST(dayofyear(date) AS INTEGER) AS "Day of Year", dayofweekname AS "Day Name" """
    ),
)
def dim_date_m(spark: SparkSession, sf: str) -> DataFrame:
    first, last = m.year_range(spark, sf)
    days = cal.dim_date(spark, date(first, 1, 1), date(last, 12, 31))
    return with_orders(days, "FullDateAlternateKey", spark, sf)


ITALIAN_MONTHS = [
    "gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno",
    "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre",
]


def _names(value: str, names: list[str]) -> str:
    return f"CASE {value} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, 1)) + " END"


@query(
    "calendar_culture",
    calendar_sql(
        f"""date AS "Date", year AS Year, quarternum AS QuarterOfYear, monthnum AS MonthOfYear,
        daynum AS DayOfMonth, year * 10000 + monthnum * 100 + daynum AS DateInt,
        {_names("monthnum", ITALIAN_MONTHS)} AS MonthName,
        substring({_names("monthnum", ITALIAN_MONTHS)}, 1, 3) || ' ' || CAST(year AS VARCHAR) AS MonthInCalendar,
        quartername || ' ' || CAST(year AS VARCHAR) AS QuarterInCalendar,
        CAST(isodow(date) - 1 AS INTEGER) AS DayInWeek,
        {_names("isodow(date)", ITALIAN_DAYS)} AS DayOfWeekName,
        CAST(date + CAST(7 - isodow(date) AS INTEGER) AS DATE) AS WeekEnding""",
    ),
)
def calendar_culture(spark: SparkSession, sf: str) -> DataFrame:
    """Italian names; the end date, the next 1 January, is not part of the calendar."""
    first, last = m.year_range(spark, sf)
    days = cal.calendar_culture(spark, date(first, 1, 1), date(last + 1, 1, 1), "it-IT")
    return with_orders(days, "Date", spark, sf)


@query(
    "calendar_entity",
    calendar_sql(
        """date AS "Date", CAST(year AS BIGINT) AS Year,
        quartername || ' ' || CAST(year AS VARCHAR) AS Quarter,
        substring(monthname, 1, 3) || ' ' || CAST(year AS VARCHAR) AS Month,
        CAST(date_trunc('month', date) AS DATE) AS MonthSort, monthname AS "Month in Year",
        CAST(monthnum AS BIGINT) AS MonthInYearSort, dayofweekname AS "Day of Week",
        CAST(isodow(date) - 1 AS BIGINT) AS DayOfWeekSort"""
    ),
)
def calendar_entity(spark: SparkSession, sf: str) -> DataFrame:
    days = cal.calendar_entity(m.calendar(spark, sf))
    return with_orders(days, "Date", spark, sf)


@query(
    "v_calendar",
    calendar_sql(
        """date AS "Date", daynum AS DayNum, dayofweekname AS DayOfWeek, dayofweeknum AS DayOfWeekNum,
        monthname AS Month, monthnum AS MonthNum, quartername AS Quarter, quarternum AS QuarterNum,
        year AS Year"""
    ),
)
def v_calendar(spark: SparkSession, sf: str) -> DataFrame:
    days = cal.v_calendar(m.calendar(spark, sf))
    return with_orders(days, "Date", spark, sf)


# -- silver views --------------------------------------------------------------


@query(
    "v_customer_delivered_to",
    m.sql(
        """SELECT CAST(2024 - year(AccountOpenedDate) AS INTEGER) AS YearsCustomer, BuyingGroupID,
        coalesce(BuyingGroupName, 'Undefined') AS BuyingGroupName, CreditLimit, CustomerCategoryID,
        CustomerID, CustomerName, DeliveryCityID, CityName AS DeliveryCity,
        StateProvinceName AS DeliveryStateProvince, CountryName AS DeliveryCountry, Region, Subregion,
        Continent, SalesTerritory, DeliveryPostalCode, IsOnCreditHold, PaymentDays,
        substring(PhoneNumber, 2, 3) AS AreaCode
        FROM m_customers LEFT JOIN m_groups USING (BuyingGroupID)
        JOIN (m_cities JOIN m_states USING (StateProvinceID) JOIN m_countries USING (CountryID))
        ON CityID = DeliveryCityID"""
    ),
)
def v_customer_delivered_to(spark: SparkSession, sf: str) -> DataFrame:
    return silver.v_customer_delivered_to(
        m.customers(spark, sf),
        m.buying_groups(spark, sf),
        m.cities(spark, sf),
        m.states(spark, sf),
        m.countries(spark, sf),
        date(2024, 3, 1),
    )


@query(
    "v_products",
    m.sql(
        """SELECT coalesce(Brand, 'No Brand') AS Brand, ColorName, LeadTimeDays, StockItemID, StockItemName,
        SupplierID, SupplierName
        FROM m_items JOIN m_suppliers USING (SupplierID) JOIN m_colors USING (ColorID)"""
    ),
)
def v_products(spark: SparkSession, sf: str) -> DataFrame:
    return silver.v_products(m.stock_items(spark, sf), m.suppliers(spark, sf), m.colors(spark, sf))


@query("v_salesperson", m.sql("SELECT PersonID, FullName FROM m_people WHERE IsSalesperson"))
def v_salesperson(spark: SparkSession, sf: str) -> DataFrame:
    return silver.v_salesperson(m.people(spark, sf))


@query(
    "v_invoiced_sales",
    m.sql(
        """SELECT o.OrderID AS InvoiceID, l.OrderLineID AS InvoiceLineID, o.CustomerID, l.StockItemID,
        o.SalespersonPersonID, o.OrderDate AS InvoiceDate,
        CASE WHEN o.LastEditedWhen > l.LastEditedWhen THEN o.LastEditedWhen ELSE l.LastEditedWhen END
            AS LastUpdated,
        l.Quantity, l.UnitPrice AS ExtendedPrice, l.LineProfit AS GrossProfit, l.TaxAmount
        FROM m_orders o JOIN m_lines l ON o.OrderID = l.OrderID"""
    ),
)
def v_invoiced_sales(spark: SparkSession, sf: str) -> DataFrame:
    return silver.v_invoiced_sales(m.invoices(spark, sf), m.invoice_lines(spark, sf))


SALES_ORDERS_SQL = """SELECT o.OrderID, l.OrderLineID, o.CustomerID, l.StockItemID, o.SalespersonPersonID,
    o.OrderDate, l.Quantity, l.Quantity * l.UnitPrice AS ExtendedPrice,
    CASE WHEN o.LastEditedWhen >= l.LastEditedWhen THEN o.LastEditedWhen ELSE l.LastEditedWhen END
        AS LastUpdated
    FROM m_orders o JOIN m_lines l ON o.OrderID = l.OrderID"""


@query("v_sales_orders", m.sql(SALES_ORDERS_SQL))
def v_sales_orders(spark: SparkSession, sf: str) -> DataFrame:
    return silver.v_sales_orders(m.orders(spark, sf), m.lines(spark, sf))


# -- gold star: silver columns are text, as loaded from CSV ---------------------


DIM_CUSTOMER = """SELECT CAST(row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) AS INTEGER) AS CustomerKey,
    CAST(c_custkey AS INTEGER) AS CustomerID, c_name AS CustomerName,
    upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS CustomerCategoryName,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'Group ' || c_mktsegment END AS BuyingGroupName,
    CASE WHEN n_regionkey <> 0 THEN 'Via ' || n_name END AS DeliveryMethodName,
    n_name AS DeliveryCityName, r_name AS DeliveryStateProvinceName,
    'Territory ' || r_name AS DeliverySalesTerritory, 'Country ' || r_name AS DeliveryCountry,
    r_name AS DeliveryContinent, lower(r_name) AS DeliveryRegion,
    substring(r_name, 1, 2) AS DeliverySubregion, DATE '2013-01-01' AS ValidFromDate
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey"""

DIM_STOCK_ITEM = """SELECT CAST(row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS INTEGER) AS StockItemKey,
    CAST(p_partkey AS INTEGER) AS StockItemID, p_name AS StockItemName,
    CAST(p_size AS VARCHAR) AS LeadTimeDays,
    nullif(upper(split_part(p_name, ' ', 1)), 'RED') AS ColorName,
    CASE WHEN p_type <> 'SMALL' THEN lower(p_type) END AS OuterPackageTypeName,
    DATE '2013-01-01' AS ValidFromDate,
    CAST((SELECT min(l_suppkey) FROM lineitem WHERE l_partkey = p_partkey) AS INTEGER) AS SupplierID
    FROM part"""

DIM_SUPPLIER_TEXT = """SELECT CAST(row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS INTEGER) AS SupplierKey,
    CAST(s_suppkey AS INTEGER) AS SupplierID, s_name AS SupplierName,
    'Category ' || n_name AS SupplierCategoryName, DATE '2013-01-01' AS ValidFromDate
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey"""

STAR = {"g_customer": DIM_CUSTOMER, "g_item": DIM_STOCK_ITEM, "g_supplier": DIM_SUPPLIER_TEXT}


@query("dim_customer", m.sql(DIM_CUSTOMER))
def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_customer(
        *[
            m.as_text(part(spark, sf))
            for part in (
                m.customers,
                m.customer_categories,
                m.cities,
                m.states,
                m.countries,
                m.buying_groups,
                m.delivery_methods,
            )
        ]
    )


@query("dim_stock_item", m.sql(DIM_STOCK_ITEM))
def dim_stock_item(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_stock_item(
        *[m.as_text(part(spark, sf)) for part in (m.stock_items, m.colors, m.package_types)]
    )


@query("dim_supplier", m.sql(DIM_SUPPLIER_TEXT))
def dim_supplier(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_supplier(*[m.as_text(part(spark, sf)) for part in (m.suppliers, m.supplier_categories)])


@query(
    "dim_date",
    m.sql(
        """SELECT CAST(year * 10000 + monthnum * 100 + daynum AS INTEGER) AS DateKey, date AS "Date",
        CAST(daynum AS TINYINT) AS Day, CAST(dayofweeknum AS TINYINT) AS WeekDay,
        dayofweekname AS WeekDayName, CAST(monthnum AS TINYINT) AS Month, monthname AS MonthName,
        CAST(quarternum AS TINYINT) AS Quarter, CAST(year AS SMALLINT) AS Year
        FROM m_calendar WHERE date IN (SELECT OrderDate FROM m_orders)"""
    ),
)
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """The days that have orders, as a pipe-delimited date file and back with types."""
    days = m.calendar(spark, sf)
    ordered = m.orders(spark, sf).select("OrderDate").distinct()
    path = scratch_path(spark, "dates")
    fs.export_csv(
        days.join(ordered, F.col("date") == F.col("OrderDate"), "left_semi").select(
            (F.col("year") * 10000 + F.col("monthnum") * 100 + F.col("daynum")).alias("DateKey"),
            F.col("date").alias("Date"),
            F.col("daynum").alias("Day"),
            F.col("dayofweeknum").alias("WeekDay"),
            F.col("dayofweekname").alias("WeekDayName"),
            F.col("monthnum").alias("Month"),
            F.col("monthname").alias("MonthName"),
            F.col("quarternum").alias("Quarter"),
            F.col("year").alias("Year"),
        ),
        path,
        sep="|",
    )
    return gold.dim_date(fs.scan_csv_text(spark, path))


@query(
    "fact_sales",
    m.sql(
        """SELECT CustomerKey, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100
            + day(o_orderdate) AS INTEGER) AS OrderDateKey,
        StockItemKey, SupplierKey, CAST(l_orderkey AS INTEGER) AS OrderID,
        CAST(l_linenumber AS INTEGER) AS OrderLineID, CAST(l_quantity AS INTEGER) AS SalesOrderQuantity,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS SalesOrderUnitPrice
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN g_customer ON g_customer.CustomerID = o_custkey
        JOIN g_item ON g_item.StockItemID = l_partkey
        JOIN g_supplier ON g_supplier.SupplierID = g_item.SupplierID""",
        **STAR,
    ),
)
def fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    """The fact with the keys of stored dimensions, of which only key and id are read."""
    star = stored_dimensions(spark, sf)
    return gold.fact_sales(*silver_sales(spark, sf), *(star.read(name) for name in (CUSTOMER, ITEM, SUPPLIER)))


def silver_sales(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Order lines and orders as the silver tables hold them, in text."""
    return m.as_text(m.lines(spark, sf)), m.as_text(m.orders(spark, sf))


# Where the star of some tables is stored, by application and tables: its keys are given once.
_stars: dict[tuple[str, str], Star] = {}


def stored_dimensions(spark: SparkSession, sf: str) -> Star:
    """The star over the given tables, whose dimensions are stored by whoever asks first."""
    named = (spark.sparkContext.applicationId, sf)
    if named not in _stars:
        _stars[named] = Star(spark, scratch_path(spark, "star"))
    star = _stars[named]
    makers = {CUSTOMER: dim_customer, ITEM: dim_stock_item, SUPPLIER: dim_supplier, DATE: dim_date}
    missing = {name: make(spark, sf) for name, make in makers.items() if not star.stored(name)}
    star.store_dimensions(missing)
    return star


def stored_star(spark: SparkSession, sf: str) -> Star:
    """The star with its fact, by month."""
    star = stored_dimensions(spark, sf)
    if not star.stored(FACT):
        star.store_fact(*silver_sales(spark, sf))
    return star


@query(
    "star_sales",
    m.sql(
        """SELECT CAST(month(o_orderdate) AS TINYINT) AS Month, SupplierCategoryName,
        CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS SalesOrderQuantity,
        CAST(sum(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS SalesValue
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN part ON p_partkey = l_partkey
        JOIN g_item ON g_item.StockItemID = l_partkey JOIN g_supplier ON g_supplier.SupplierID = g_item.SupplierID
        JOIN customer ON c_custkey = o_custkey WHERE year(o_orderdate) = 1997 GROUP BY 1, 2""",
        **STAR,
    ),
)
def star_sales(spark: SparkSession, sf: str) -> DataFrame:
    """A year's sales by month and supplier category from the stored star, reading that year's months alone."""
    star = stored_star(spark, sf)
    categories = star.read(SUPPLIER).select("SupplierKey", "SupplierCategoryName")
    sales = star.sales_on(F.col("Year") == 1997).join(categories, "SupplierKey")
    return sales_by(sales, "Month", "SupplierCategoryName")


# -- entities: CSV shaped from the given tables, then the whole chain of steps ----


@query(
    "entity_customer",
    """SELECT c_custkey AS CustomerId,
    concat_ws(' ', split_part(c_name, '#', 1), nullif(c_mktsegment, 'BUILDING')) AS Customer,
    c_nationkey || ' Main St' AS Address, 'City ' || c_nationkey AS City, 'ST' AS State,
    CAST(10000 + c_nationkey AS BIGINT) AS Zipcode,
    CASE WHEN c_acctbal < 0 THEN 'Female' ELSE 'Male' END AS Gender,
    CAST(DATE '1970-01-01' + c_nationkey * 37 AS DATE) AS BirthDate,
    '1/2/2010' AS FirstPurchaseDate, '3/4/2012' AS LastPurchaseDate FROM customer""",
)
def entity_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as a fifteen-column CSV; one segment has no last name."""
    born = F.date_add(F.lit("1970-01-01").cast("date"), F.col("c_nationkey") * 37)
    nation = F.col("c_nationkey").cast("string")
    raw = m.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CustomerId"),
        F.substring_index("c_name", "#", 1).alias("FirstName"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("LastName"),
        F.lit("Company").alias("Company"),
        F.lit("a@example.com").alias("EmailAddress"),
        F.lit("555-0100").alias("WorkPhone"),
        F.lit("555-0101").alias("HomePhone"),
        F.concat(nation, F.lit(" Main St")).alias("Address"),
        F.concat(F.lit("City "), nation).alias("City"),
        F.lit("ST").alias("State"),
        (F.col("c_nationkey") + 10000).alias("Zipcode"),
        F.when(F.col("c_acctbal") < 0, "F").otherwise("M").alias("Gender"),
        F.concat(F.date_format(born, "M/d/yyyy"), F.lit(" 12:00:00 AM")).alias("BirthDate"),
        F.lit("1/2/2010").alias("FirstPurchaseDate"),
        F.lit("3/4/2012").alias("LastPurchaseDate"),
    )
    path = scratch_path(spark, "customers-csv")
    fs.export_csv(raw, path)
    return en.entity_customer(fs.scan_csv_entity(spark, path))


@query(
    "entity_product",
    """SELECT p_partkey AS ProductId, p_brand AS ProductCode, p_name AS Product, 'A part.' AS Description,
    p_type AS Category, CASE WHEN p_size > 25 THEN 'Large' END AS SubCategory,
    CAST(CASE WHEN p_size % 2 = 0 THEN p_size / 2 WHEN ((p_size - 1) / 2) % 2 = 0 THEN (p_size - 1) / 2
        ELSE (p_size + 1) / 2 END AS BIGINT) AS UnitCost,
    CAST(CASE WHEN (2 * price) % 2 = 1 AND floor(price) % 2 = 0 THEN floor(price)
        ELSE floor(price + 0.5) END AS BIGINT) AS ListPrice, 'Red,Blue' AS Color,
    CASE WHEN p_size > 10 THEN CAST(p_size AS BIGINT) END AS MinimumAge,
    CAST(p_size + 50 AS BIGINT) AS MaximumAge, 'http://example.com/p.jpg' AS ProductImageUrl
    FROM (SELECT *, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part)""",
)
def entity_product(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as an eleven-column CSV with quoted commas, blank ages and half amounts."""
    size = F.col("p_size")
    kind = F.when(size > 25, F.concat("p_type", F.lit(" > Large"))).otherwise(F.col("p_type"))
    raw = m.table(spark, sf, "part").select(
        F.col("p_partkey").alias("ProductId"),
        F.col("p_brand").alias("ProductCode"),
        F.col("p_name").alias("Title"),
        F.lit("A part.").alias("Description"),
        kind.alias("ProductCategory"),
        (size * F.lit("0.5").cast("decimal(2,1)")).alias("UnitCost"),
        F.format_number(F.col("p_retailprice").cast(m.MONEY), 2).alias("ListPrice"),
        F.lit("Red,Blue").alias("Color"),
        F.when(size > 10, size).alias("MinimumAge"),
        (size + 50).alias("MaximumAge"),
        F.lit("http://example.com/p.jpg").alias("ProductImageUrl"),
    )
    path = scratch_path(spark, "products-csv")
    fs.export_csv(raw, path)
    return en.entity_product(fs.scan_csv_entity(spark, path))


@query(
    "entity_sales",
    m.sql(
        """SELECT o.CustomerID AS CustomerId, CAST(l.Quantity AS BIGINT) AS Quantity,
        CAST(CAST(l.UnitPrice AS DECIMAL(18,0)) AS BIGINT) AS SalesAmount, o.OrderID AS InvoiceId,
        l.StockItemID AS ProductId, strftime(o.OrderDate, '%d/%m/%Y') AS InvoiceDate
        FROM m_lines l JOIN m_orders o ON o.OrderID = l.OrderID"""
    ),
)
def entity_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as a semicolon CSV with dates month first; they come out day first."""
    order = m.orders(spark, sf).select("OrderID", "CustomerID", "OrderDate")
    raw = (
        m.lines(spark, sf)
        .join(order, "OrderID")
        .select(
            F.col("CustomerID").alias("Id"),
            "Quantity",
            F.col("UnitPrice").cast("decimal(18,0)").alias("SalesAmount"),
            F.col("OrderID").alias("InvoiceId"),
            F.col("StockItemID").alias("ProductId"),
            F.date_format("OrderDate", "M/d/yyyy").alias("InvoiceDate"),
        )
    )
    path = scratch_path(spark, "invoice-details-csv")
    fs.export_csv(raw, path, sep=";")
    return en.entity_sales(fs.scan_csv_entity(spark, path, sep=";"))
