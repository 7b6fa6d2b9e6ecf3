"""Queries for upserts, loads, the run log and runs over a control table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.catalogue import model as m
from tarnhouse.catalogue.registry import query
from tarnhouse.catalogue.star import SALES_ORDERS_SQL, v_sales_orders
from tarnhouse.functions.dates import load_time, run_time
from tarnhouse.operators.filters import filter_date_range
from tarnhouse.operators.upsert import create_or_upsert, latest_per_key, update_then_insert
from tarnhouse.operators.upsert import upsert as upsert_rows
from tarnhouse.plans import loads, silver
from tarnhouse.plans.control import GOLD, WAREHOUSE, control_rows, control_table
from tarnhouse.plans.silver import SILVER_FILES
from tarnhouse.plans.stages import Controls, Source, run_stages
from tarnhouse.plans.warehouse import create_tables, warehouse_table
from tarnhouse.session import scratch_path
from tarnhouse.sources.database import JdbcSource, scan_source_query
from tarnhouse.sources.files import QUOTES, export_csv
from tarnhouse.sources.lake import LakeTable, hash_layout, range_layout
from tarnhouse.sources.monthly import MonthlyTable

BATCH = datetime(2024, 3, 1, 6)

# Orders up to 1999 are stored first, those from 1998 on come again changed.
OLD, NEW = date(1999, 1, 1), date(1998, 1, 1)


def orders_table(spark: SparkSession, layout: str | None = None) -> LakeTable:
    return LakeTable(spark, scratch_path(spark, "Orders"), ("o_orderkey",), "o_orderdate", layout)


def old_and_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = m.table(spark, sf, "orders")
    old = rows.filter(F.col("o_orderdate") < F.lit(str(OLD)).cast("timestamp_ntz"))
    new = rows.filter(F.col("o_orderdate") >= F.lit(str(NEW)).cast("timestamp_ntz"))
    return old, new.withColumn("o_orderstatus", F.lit("new"))


UPSERTED = """SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'new' ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderdate, o_orderpriority FROM orders"""


@query("upsert", UPSERTED)
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A table in hash buckets; running the upsert twice changes nothing more."""
    table = orders_table(spark, hash_layout(8))
    old, new = old_and_new(spark, sf)
    table.create(old)
    upsert_rows(table, new)
    upsert_rows(table, new)
    return table.read()


@query("create_or_upsert", UPSERTED)
def create_or_upsert_query(spark: SparkSession, sf: str) -> DataFrame:
    table = orders_table(spark)
    for rows in old_and_new(spark, sf):
        create_or_upsert(table, rows)
    return table.read()


# Two-key rows must be unique to be upserted; the last edit of a key wins.
LATEST_SALES_ORDERS = f"""SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (
    PARTITION BY OrderID, OrderLineID ORDER BY LastUpdated DESC, CustomerID DESC, StockItemID DESC,
    SalespersonPersonID DESC, OrderDate DESC, Quantity DESC, ExtendedPrice DESC) AS r
    FROM ({SALES_ORDERS_SQL})) WHERE r = 1"""


def latest_sales_orders(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(v_sales_orders(spark, sf), ["OrderID", "OrderLineID"], "LastUpdated")


@query("latest_per_key", m.sql(LATEST_SALES_ORDERS))
def latest_per_key_query(spark: SparkSession, sf: str) -> DataFrame:
    return latest_sales_orders(spark, sf)


def stored_view(spark: SparkSession, sf: str) -> DataFrame:
    """The view as stored rows, so loads that read it several times compute it once."""
    path = scratch_path(spark, "sales-orders-view")
    latest_sales_orders(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


MARK = datetime(1998, 6, 1)

# Before the load the table holds what was last edited up to the mark, with no quantity
# yet; rows edited on the mark itself are updated, later ones are inserted.
LOADED = f"""SELECT OrderID, OrderLineID, CustomerID, StockItemID, SalespersonPersonID, OrderDate,
    CASE WHEN LastUpdated < TIMESTAMP '{MARK}' THEN 0 ELSE Quantity END AS Quantity,
    ExtendedPrice, LastUpdated FROM ({LATEST_SALES_ORDERS})"""


def up_to_mark(view: DataFrame) -> DataFrame:
    old = view.filter(F.col("LastUpdated") <= F.lit(str(MARK)).cast("timestamp_ntz"))
    return old.withColumn("Quantity", F.lit(0))


@query("update_then_insert", m.sql(LOADED))
def update_then_insert_query(spark: SparkSession, sf: str) -> DataFrame:
    """Without dates the closed window starts at the newest mark stored. The table lies in months."""
    view = stored_view(spark, sf)
    table = warehouse_table(spark, scratch_path(spark, "warehouse"), "SalesOrders")
    table.create(up_to_mark(view))
    update_then_insert(table, view)
    return table.read()


@query(
    "load_full",
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'",
)
def load_full(spark: SparkSession, sf: str) -> DataFrame:
    table = orders_table(spark)
    loads.load_full(m.table(spark, sf, "orders"), table, date(1996, 1, 1), date(2001, 1, 1))
    return table.read()


@query(
    "load_incremental",
    "SELECT * FROM events",
)
def load_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Events in weekly windows, each starting at the mark the one before left."""
    table = LakeTable(spark, scratch_path(spark, "Events"), ("event_id",), "ts")
    events = m.table(spark, sf, "events")
    staging = scratch_path(spark, "files")
    start = datetime(2024, 1, 1)
    for end in (datetime(2024, 1, 11), datetime(2024, 1, 21), None):
        start = loads.load_incremental(events, table, staging, start, end).max_mark
    return table.read()


@query(
    "load_gold_full",
    m.sql("SELECT PersonID, FullName FROM m_people WHERE IsSalesperson"),
)
def load_gold_full(spark: SparkSession, sf: str) -> DataFrame:
    table = LakeTable(spark, scratch_path(spark, "Salesperson"))
    view = m.people(spark, sf).filter("IsSalesperson").select("PersonID", "FullName")
    loads.load_gold_full(view, table)
    return table.read()


@query("load_gold_incremental", m.sql(LOADED))
def load_gold_incremental(spark: SparkSession, sf: str) -> DataFrame:
    view = stored_view(spark, sf)
    keys = ("OrderID", "OrderLineID")
    table = MonthlyTable(spark, scratch_path(spark, "SalesOrders"), view.schema, "OrderDate", keys, "LastUpdated")
    table.create(up_to_mark(view))
    loads.load_gold_incremental(view, table, scratch_path(spark, "files"), MARK)
    return table.read()


@query("load_warehouse", m.sql(LOADED))
def load_warehouse(spark: SparkSession, sf: str) -> DataFrame:
    """A full load of the rows up to the mark, then an incremental one from it on."""
    view = stored_view(spark, sf)
    table = warehouse_table(spark, scratch_path(spark, "warehouse"), "SalesOrders")
    table.create(view.limit(0))
    loads.load_warehouse(up_to_mark(view), table, "full")
    loads.load_warehouse(view, table, "incremental", MARK)
    return table.read()


# The given tables as source tables of a metadata-driven load.
CONTROL = [
    ("Sales", "orders", "o_orderdate", "2000-01-01 00:00:00", "Orders", "incremental", "o_orderkey", None),
    ("Web", "events", "ts", "2024-01-15 00:00:00", "Events", "incremental", "event_id", None),
    ("Sales", "customer", None, None, "Customers", "full", None, None),
    ("Sales", "lineitem", "l_shipdate", None, "OrderLines", "full", None, None),
    ("Warehouse", "part", None, None, "StockItems", "full", None, None),
]


# New orders and events have high keys, so an increment touches the last buckets only.
KEYS_PER_BUCKET = 1 << 24


def control(spark: SparkSession, root: str) -> LakeTable:
    """The control rows; listing some of them twice makes no difference."""
    rows = control_table(
        control_rows(spark, "bronze", CONTROL), control_rows(spark, "bronze", CONTROL[:2])
    )
    start = F.when(F.col("datecolumn").isNotNull(), F.lit("1995-01-01").cast("timestamp_ntz"))
    return loads.control_lake_table(spark, f"{root}/control", rows.withColumn("startdate", start))


class GivenTables(JdbcSource):
    """The given tables as a database: each predicate reads the files once, as a connection would."""

    def __init__(self, sf: str, partitions: int = 4):
        super().__init__(sf, partitions=partitions)

    def load(self, spark: SparkSession, schema: str, table: str, predicates: Sequence[str]) -> DataFrame:
        rows = m.table(spark, self.url, table)
        return reduce(DataFrame.unionByName, [rows.filter(p) for p in predicates])

    def bounds(self, spark: SparkSession, schema: str, table: str, column: str, where: str = "") -> tuple:
        rows = m.table(spark, self.url, table).filter(where or "1 = 1")
        return tuple(rows.agg(F.min(column), F.max(column)).first())


def run(spark: SparkSession, sf: str, root: str, table: LakeTable) -> dict[str, loads.LoadResult]:
    return loads.run_loads(
        spark,
        table,
        GivenTables(sf),
        root,
        batch=BATCH,
        layouts={"Orders": range_layout(KEYS_PER_BUCKET), "Events": range_layout(KEYS_PER_BUCKET)},
    )


@query(
    "split_source_query",
    """SELECT 'closed' AS window, * FROM orders
        WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT 'from', * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
    UNION ALL SELECT 'until', * FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'
    UNION ALL SELECT 'all', * FROM orders""",
)
def split_source_query(spark: SparkSession, sf: str) -> DataFrame:
    """Closed, open and full windows, each read in parts by predicates that do not overlap."""
    source = GivenTables(sf, 7)
    windows = {
        "closed": ("1996-01-01", "1998-01-01"), "from": ("2000-01-01", None), "until": (None, "1996-01-01"),
        "all": (None, None),
    }
    parts = [
        scan_source_query(spark, source, "Sales", "orders", "o_orderdate", *window, key="o_orderkey").select(
            F.lit(name).alias("window"), "*"
        )
        for name, window in windows.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "run_log",
    """SELECT 'Orders' AS sinktable, 'Succeeded' AS loadstatus, count(*) AS rowsread,
        count(*) AS rowsinserted, CAST(0 AS BIGINT) AS rowsupdated, max(o_orderdate) AS maxdatetime,
        max(o_orderdate) AS startdate FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
    UNION ALL SELECT 'Events', 'Succeeded', count(*), count(*), 0, max(ts), max(ts) FROM events
        WHERE ts < TIMESTAMP '2024-01-15'
    UNION ALL SELECT 'Customers', 'Succeeded', count(*), count(*), 0, NULL, NULL FROM customer
    UNION ALL SELECT 'OrderLines', 'Succeeded', count(*), count(*), 0, max(l_shipdate),
        TIMESTAMP '1995-01-01' FROM lineitem
    UNION ALL SELECT 'StockItems', 'Succeeded', count(*), count(*), 0, NULL, NULL FROM part""",
)
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """The control rows after one run over all of them."""
    root = scratch_path(spark, "bronze")
    table = control(spark, root)
    run(spark, sf, root, table)
    return table.read().select(
        "sinktable", "loadstatus", "rowsread", "rowsinserted", "rowsupdated", "maxdatetime", "startdate"
    )


@query(
    "run_loads",
    """SELECT 'Orders' AS sinktable, count(*) AS "rows" FROM orders
    UNION ALL SELECT 'Events', count(*) FROM events
    UNION ALL SELECT 'Customers', count(*) FROM customer
    UNION ALL SELECT 'OrderLines', count(*) FROM lineitem
    UNION ALL SELECT 'StockItems', count(*) FROM part""",
)
def run_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs; between them the ends of the windows are opened. Counts of the tables."""
    root = scratch_path(spark, "bronze")
    table = control(spark, root)
    run(spark, sf, root, table)
    table.overwrite(table.read().withColumn("enddate", F.lit(None).cast("timestamp_ntz")))
    run(spark, sf, root, table)
    counts = [
        LakeTable(spark, f"{root}/Tables/{sink}").read().agg(F.count("*").alias("rows")).select(
            F.lit(sink).alias("sinktable"), "rows"
        )
        for *_, sink, _, _, _ in CONTROL
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "staged_window",
    "SELECT * FROM lineitem WHERE l_shipdate >= DATE '1998-01-01' AND l_shipdate < DATE '1999-01-01'",
)
def staged_window(spark: SparkSession, sf: str) -> DataFrame:
    """A full load whose window reaches the Parquet scan."""
    table = LakeTable(spark, scratch_path(spark, "OrderLines"), mark="l_shipdate")
    window = filter_date_range(m.table(spark, sf, "lineitem"), "l_shipdate", "1998-01-01", "1999-01-01")
    loads.load_full(window, table)
    return table.read()


# -- all stages ------------------------------------------------------------------

# Source tables that the given tables can stand for; the facts are loaded incrementally.
STAGED_FULL = [
    ("CitiesNoGeography", "Cities"),
    ("CountriesNoGeography", "Countries"),
    ("StateProvincesNoGeography", "StateProvinces"),
    ("SuppliersNoGeography", "Suppliers"),
    ("CustomersNoGeography", "Customers"),
    ("BuyingGroups", "BuyingGroups"),
    ("People", "People"),
    ("Colors", "Colors"),
    ("StockItems", "StockItems"),
]
STAGED_FACTS = [
    ("Orders", "OrderID", None),
    ("OrderLines", "OrderID", "OrderLineID"),
    ("Invoices", "InvoiceID", None),
    ("InvoiceLines", "InvoiceID", "InvoiceLineID"),
]
STAGED = [
    *[("s", table, None, None, sink, "full", None, None) for table, sink in STAGED_FULL],
    *[
        ("s", table, "LastEditedWhen", None, table, "incremental", key, key2)
        for table, key, key2 in STAGED_FACTS
    ],
]


def numbered_groups(rows: DataFrame) -> DataFrame:
    """Groups and categories are segments, each with a first letter of its own; the warehouse holds numbers."""
    for column in {"BuyingGroupID", "CustomerCategoryID"} & set(rows.columns):
        rows = rows.withColumn(column, F.ascii(column))
    return rows


def staged_source(spark: SparkSession, sf: str) -> Source:
    """The source tables; the lines are stored rows, as two tables and every run read them."""
    path = scratch_path(spark, "source-lines")
    latest_per_key(m.lines(spark, sf), ["OrderID", "OrderLineID"], "LastEditedWhen").write.parquet(path)

    def lines() -> DataFrame:
        return spark.read.parquet(path)

    def invoice_lines() -> DataFrame:
        names = {"OrderID": "InvoiceID", "OrderLineID": "InvoiceLineID", "UnitPrice": "ExtendedPrice"}
        return lines().withColumnsRenamed(names)

    nowhere = F.lit("POINT EMPTY")
    tables = {
        "Cities": lambda: m.cities(spark, sf).withColumn("Location", nowhere),
        "Countries": lambda: m.countries(spark, sf).withColumn("Border", nowhere),
        "StateProvinces": lambda: m.states(spark, sf).withColumn("Border", nowhere),
        "Suppliers": lambda: m.suppliers(spark, sf).withColumn("DeliveryLocation", nowhere),
        "Customers": lambda: numbered_groups(m.customers(spark, sf)),
        "BuyingGroups": lambda: numbered_groups(m.buying_groups(spark, sf)),
        "People": lambda: m.people(spark, sf),
        "Colors": lambda: m.colors(spark, sf),
        "StockItems": lambda: m.stock_items(spark, sf),
        "Orders": lambda: m.orders(spark, sf),
        "OrderLines": lines,
        "Invoices": lambda: m.invoices(spark, sf),
        "InvoiceLines": invoice_lines,
    }
    return lambda schema, table: tables[table]()


UNIQUE_LINES = """SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY OrderID, OrderLineID
    ORDER BY LastEditedWhen DESC, StockItemID DESC, Quantity DESC, UnitPrice DESC, LineProfit DESC,
    TaxAmount DESC) AS r FROM m_lines) WHERE r = 1"""


def staged(spark: SparkSession, sf: str, times: int = 1, warehouse: bool = False) -> str:
    """Runs the stages and returns their root; the warehouse tables exist empty before."""
    root = scratch_path(spark, "stages")
    early = F.lit("1995-01-01").cast("timestamp_ntz")
    lists = {"bronze": (STAGED, None), "gold": (GOLD, None)}
    if warehouse:
        lists["warehouse"] = (WAREHOUSE, "Gold")
        create_tables(spark, f"{root}/warehouse/Tables/Gold")
    tables = {
        name: loads.control_lake_table(
            spark,
            f"{root}/control/{name}",
            control_rows(spark, "stages", rows, schema).withColumn(
                "startdate", F.when(F.col("datecolumn").isNotNull(), early)
            ),
        )
        for name, (rows, schema) in lists.items()
    }
    source = staged_source(spark, sf)
    for _ in range(times):
        done = run_stages(
            spark,
            Controls(**tables),
            source,
            root,
            *m.year_range(spark, sf),
            load_warehouse=int(warehouse),
            batch=BATCH,
            as_of=date(2024, 3, 1),
        )
        failed = [r.error for stage in done.values() for r in stage.values() if r.error]
        if failed:
            raise RuntimeError(failed[0])
    return root


@query(
    "run_stages",
    m.sql(
        SALES_ORDERS_SQL.replace("m_lines", "u_lines"),
        u_lines=UNIQUE_LINES,
    ),
)
def run_stages_query(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze, calendar and gold, run twice; the second run changes nothing more.

    The result is the sales-order fact of the gold stage.
    """
    root = staged(spark, sf, times=2)
    return LakeTable(spark, f"{root}/gold/Tables/SalesOrders").read()


@query(
    "run_stages_warehouse",
    m.sql(
        """SELECT CAST(OrderID AS INTEGER) AS OrderID, CAST(OrderLineID AS INTEGER) AS OrderLineID,
        CAST(CustomerID AS INTEGER) AS CustomerID, CAST(StockItemID AS INTEGER) AS StockItemID,
        CAST(SalespersonPersonID AS INTEGER) AS SalespersonPersonID, OrderDate,
        CAST(Quantity AS INTEGER) AS Quantity, CAST(ExtendedPrice AS DECIMAL(18,2)) AS ExtendedPrice,
        LastUpdated FROM u_sales""",
        u_sales=SALES_ORDERS_SQL.replace("m_lines", "u_lines"),
        u_lines=UNIQUE_LINES,
    ),
)
def run_stages_warehouse(spark: SparkSession, sf: str) -> DataFrame:
    """All three stages once; the result is the sales-order fact of the warehouse."""
    root = staged(spark, sf, warehouse=True)
    return warehouse_table(spark, f"{root}/warehouse/Tables/Gold", "SalesOrders").read()


@query(
    "warehouse_customer",
    m.sql(
        """SELECT CAST(2024 - year(AccountOpenedDate) AS INTEGER) AS YearsCustomer,
        CAST(ascii(BuyingGroupID) AS INTEGER) AS BuyingGroupID, coalesce(BuyingGroupName, 'Undefined') AS BuyingGroupName,
        CAST(CreditLimit AS DECIMAL(10,2)) AS CreditLimit, CAST(ascii(CustomerCategoryID) AS INTEGER) AS CustomerCategoryID,
        CAST(CustomerID AS INTEGER) AS CustomerID, CustomerName, CAST(DeliveryCityID AS INTEGER) AS DeliveryCityID,
        CityName AS DeliveryCity, StateProvinceName AS DeliveryStateProvince, CountryName AS DeliveryCountry, Region,
        Subregion, Continent, SalesTerritory, DeliveryPostalCode, IsOnCreditHold,
        CAST(PaymentDays AS INTEGER) AS PaymentDays, substring(PhoneNumber, 2, 3) AS AreaCode
        FROM m_customers LEFT JOIN m_groups USING (BuyingGroupID)
        JOIN (m_cities JOIN m_states USING (StateProvinceID) JOIN m_countries USING (CountryID))
        ON CityID = DeliveryCityID"""
    ),
)
def warehouse_customer(spark: SparkSession, sf: str) -> DataFrame:
    """The customers of the warehouse after a run over all stages."""
    root = staged(spark, sf, warehouse=True)
    return warehouse_table(spark, f"{root}/warehouse/Tables/Gold", "Customer").read()


# -- silver tables from bronze files ---------------------------------------------

BRONZE = {
    "silver_BuyingGroups": m.buying_groups,
    "silver_Cities": m.cities,
    "silver_Colors": m.colors,
    "silver_Countries": m.countries,
    "silver_CustomerCategories": m.customer_categories,
    "silver_Customers": m.customers,
    "silver_Date": m.calendar,
    "silver_DeliveryMethods": m.delivery_methods,
    "silver_PackageTypes": m.package_types,
    "silver_People": m.people,
    "silver_SalesOrder": m.orders,
    "silver_SalesOrderLine": m.lines,
    "silver_StateProvinces": m.states,
    "silver_StockItems": m.stock_items,
    "silver_SupplierCategories": m.supplier_categories,
    "silver_Suppliers": m.suppliers,
}
# The same tables in SQL, and a column of each that identifies its rows.
BRONZE_SQL = {
    "silver_BuyingGroups": ("m_groups", "BuyingGroupID"),
    "silver_Cities": ("m_cities", "CityID"),
    "silver_Colors": ("m_colors", "ColorID"),
    "silver_Countries": ("m_countries", "CountryID"),
    "silver_CustomerCategories": ("m_categories", "CustomerCategoryID"),
    "silver_Customers": ("m_customers", "CustomerID"),
    "silver_Date": ("m_calendar", "date"),
    "silver_DeliveryMethods": ("m_methods", "DeliveryMethodID"),
    "silver_PackageTypes": ("m_packages", "PackageTypeID"),
    "silver_People": ("m_people", "PersonID"),
    "silver_SalesOrder": ("m_orders", "OrderID"),
    "silver_SalesOrderLine": ("m_lines", "OrderID"),
    "silver_StateProvinces": ("m_states", "StateProvinceID"),
    "silver_StockItems": ("m_items", "StockItemID"),
    "silver_SupplierCategories": ("m_supcats", "SupplierCategoryID"),
    "silver_Suppliers": ("m_suppliers", "SupplierID"),
}


def bronze_files(spark: SparkSession, sf: str) -> str:
    """The sixteen tables as pipe-delimited files; orders and their lines in one folder per year."""
    folder = scratch_path(spark, "bronze-files")
    for name, make in BRONZE.items():
        rows, file = make(spark, sf), SILVER_FILES[name]
        if "*" not in file:
            export_csv(rows, f"{folder}/{file}", sep="|")
            continue
        by_year = rows.withColumn("_year", F.year("LastEditedWhen")).hint("rebalance", "_year")
        by_year.write.partitionBy("_year").options(header=True, sep="|", **QUOTES).csv(f"{folder}/{file.split('/')[0]}")
    return folder


@query(
    "load_silver",
    m.sql(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS name, CAST({key} AS VARCHAR) AS id, count(*) AS n FROM {table} GROUP BY ALL"
            for name, (table, key) in BRONZE_SQL.items()
        )
    ),
)
def load_silver(spark: SparkSession, sf: str) -> DataFrame:
    """All sixteen silver tables from their bronze files: every id, as the text it is stored as."""
    root = scratch_path(spark, "silver")
    silver.load_silver(spark, bronze_files(spark, sf), root)
    parts = [
        LakeTable(spark, f"{root}/{name}").read().groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("name"), "id", "n")
        for name, (_, key) in BRONZE_SQL.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "load_stamps",
    """SELECT o_orderstatus, current_date AS loaded, CAST(count(*) AS BIGINT) AS "rows", CAST(1 AS BIGINT) AS stamps
    FROM orders GROUP BY 1""",
)
def load_stamps(spark: SparkSession, sf: str) -> DataFrame:
    """Tables loaded one after the other in one run bear the one time at which it began."""
    root, stamp = scratch_path(spark, "stamped"), load_time(run_time(spark))
    orders = m.table(spark, sf, "orders")
    for status in ("F", "O", "P"):
        rows = orders.filter(F.col("o_orderstatus") == status).withColumn("loaded", stamp)
        rows.select("o_orderstatus", "loaded").write.mode("append").parquet(root)
    stamped = spark.read.parquet(root)
    return stamped.groupBy("o_orderstatus", F.col("loaded").cast("date").alias("loaded")).agg(
        F.count("*").alias("rows"), F.lit(stamped.select("loaded").distinct().count()).cast("long").alias("stamps")
    )
