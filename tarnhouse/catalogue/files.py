"""Queries for scans, sinks and table changes.

Text and lake tables to read are first written from the given tables into a fresh
scratch folder, so the work of each query grows with them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.catalogue import model as m
from tarnhouse.catalogue.registry import query
from tarnhouse.functions.dates import load_time
from tarnhouse.operators.aggregates import summarize_columns
from tarnhouse.plans import trips as tr
from tarnhouse.plans.gold import dim_supplier
from tarnhouse.session import local_rows, scratch_path
from tarnhouse.sources import files as fs
from tarnhouse.sources.budget import scan_budget, unpivot_budget
from tarnhouse.sources.checked import scan_csv_checked
from tarnhouse.sources.database import ParquetSource, scan_source_query
from tarnhouse.sources.entity import scan_entity
from tarnhouse.sources.lake import LakeTable, range_layout

# -- scans -----------------------------------------------------------------


@query("scan_csv_typed", m.sql("SELECT * FROM m_trips"))
def scan_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "trips-csv")
    fs.export_csv(m.trips(spark, sf), path)
    return tr.trips_csv(spark, path)


@query(
    "scan_parquet",
    """SELECT CAST(l_suppkey AS INTEGER) AS VendorID, CAST(l_shipdate AS DATE) AS ship_date,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS total_amount FROM lineitem""",
)
def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """A file read with its own schema and cast on the way; three of its columns are read."""
    return fs.scan_parquet(spark, f"{sf}/lineitem.parquet").select(
        F.col("l_suppkey").cast("int").alias("VendorID"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("total_amount"),
    )


@query(
    "scan_csv_pipe",
    m.sql(
        """SELECT CAST(OrderID AS VARCHAR) AS OrderID, CAST(CustomerID AS VARCHAR) AS CustomerID,
        CAST(OrderDate AS VARCHAR) AS OrderDate FROM m_orders"""
    ),
)
def scan_csv_pipe(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "orders-pipe")
    fs.export_csv(m.orders(spark, sf).select("OrderID", "CustomerID", "OrderDate"), path, sep="|")
    return fs.scan_csv_text(spark, path)


@query(
    "scan_csv_glob",
    m.sql(
        """SELECT CAST(OrderID AS VARCHAR) AS OrderID, CAST(OrderLineID AS VARCHAR) AS OrderLineID,
        CAST(Quantity AS VARCHAR) AS Quantity, CAST(UnitPrice AS VARCHAR) AS UnitPrice
        FROM m_lines"""
    ),
)
def scan_csv_glob(spark: SparkSession, sf: str) -> DataFrame:
    """One folder per year below the table's folder, read back with ``*/*.csv``."""
    path = scratch_path(spark, "lines-glob")
    (
        m.lines(spark, sf)
        .select("OrderID", "OrderLineID", "Quantity", "UnitPrice", F.year("LastEditedWhen").alias("y"))
        .hint("rebalance", "y")
        .write.partitionBy("y")
        .option("header", True)
        .option("sep", "|")
        .csv(path)
    )
    return fs.scan_csv_text(spark, f"{path}/*/*.csv")


@query(
    "scan_csv_entity",
    m.sql(
        """SELECT CAST(p_partkey AS VARCHAR) AS ProductId, p_name || ', "' || p_type || '"' AS Title,
        p_brand AS ProductCode FROM part"""
    ),
)
def scan_csv_entity(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "products-csv")
    title = F.concat("p_name", F.lit(', "'), "p_type", F.lit('"'))
    fs.export_csv(
        m.table(spark, sf, "part").select(
            F.col("p_partkey").alias("ProductId"), title.alias("Title"), F.col("p_brand").alias("ProductCode")
        ),
        path,
        sep=";",
    )
    return fs.scan_csv_entity(spark, path, sep=";")


# The budget sheet has one value column per scenario, year and month.
BUDGET_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
BUDGET_CELLS = [
    ("Forecast" if year > 1999 else "Budget", year, month)
    for year in range(2001, 1994, -1)
    for month in BUDGET_MONTHS
]
BUDGET_WIDTH = 2 + len(BUDGET_CELLS)


def budget_sheet(spark: SparkSession, sf: str, folder: str, file: str) -> None:
    """Order values as a budget sheet: market segments by priorities down, months across.

    The sheet has at most one line per segment and priority, so one file holds it.
    """
    customer = m.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    order = (
        m.table(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("cell", F.date_format("o_orderdate", "yyyy-MMM"))
    )
    cells = [f"{year}-{month}" for _, year, month in BUDGET_CELLS]
    sheet = (
        order.groupBy("c_mktsegment", "o_orderpriority")
        .pivot("cell", cells)
        .agg(F.sum(F.col("o_totalprice").cast(m.MONEY)))
        .select(
            F.lit(6).alias("at"),
            F.concat_ws(
                ",",
                "c_mktsegment",
                "o_orderpriority",
                *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cells],
            ).alias("value"),
        )
    )
    blank = "," * (BUDGET_WIDTH - 1)
    head = [
        "Budget sheet" + blank,
        blank,
        blank,
        ",," + ",".join(scenario for scenario, _, _ in BUDGET_CELLS),
        ",," + ",".join(str(year) for _, year, _ in BUDGET_CELLS),
        "Category,Segment," + ",".join(month for _, _, month in BUDGET_CELLS),
    ]
    top = local_rows(spark, list(enumerate(head)), "at int, value string")
    lines = top.unionByName(sheet).coalesce(1).sortWithinPartitions("at", "value")
    lines.select("value").write.text(f"{folder}/{file}")


BUDGET_LONG = """SELECT c_mktsegment AS Category, o_orderpriority AS Segment,
    CASE WHEN year(o_orderdate) > 1999 THEN 'Forecast' ELSE 'Budget' END AS Scenario,
    CAST(year(o_orderdate) AS INTEGER) AS Year, substring(monthname(o_orderdate), 1, 3) AS Month,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS Total
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY 1, 2, 3, 4, 5"""


def _budget_rows_sql() -> str:
    """The sheet as rows of text: three title rows, three header rows, then the body."""

    def head(first: str | None, second: str | None, cells: list[str | None]) -> str:
        values = [first, second, *cells]
        return "SELECT " + ", ".join(
            f"{'NULL' if v is None else repr(v)} AS Column{i}" for i, v in enumerate(values, 1)
        )

    blank = [None] * len(BUDGET_CELLS)
    rows = [
        head("Budget sheet", None, blank),
        head(None, None, blank),
        head(None, None, blank),
        head(None, None, [s for s, _, _ in BUDGET_CELLS]),
        head(None, None, [str(y) for _, y, _ in BUDGET_CELLS]),
        head("Category", "Segment", [mo for _, _, mo in BUDGET_CELLS]),
    ]
    body = ", ".join(
        f"CAST(sum(Total) FILTER (WHERE Year = {y} AND Month = '{mo}') AS VARCHAR) AS Column{i}"
        for i, (_, y, mo) in enumerate(BUDGET_CELLS, 3)
    )
    rows.append(f"SELECT Category AS Column1, Segment AS Column2, {body} FROM b_long GROUP BY 1, 2")
    return "\nUNION ALL ".join(rows)


@query("scan_budget", m.sql(_budget_rows_sql(), b_long=BUDGET_LONG))
def scan_budget_query(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "budget")
    budget_sheet(spark, sf, folder, "budget.csv")
    return scan_budget(spark, folder, "budget.csv")


@query(
    "unpivot_budget",
    m.sql(
        """SELECT Category, Segment, Scenario, Year, Month, CAST(Total AS DOUBLE) AS Amount
        FROM b_long""",
        b_long=BUDGET_LONG,
    ),
)
def unpivot_budget_query(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "budget")
    budget_sheet(spark, sf, folder, "budget.csv")
    return unpivot_budget(spark, folder, "budget.csv")


@query(
    "scan_jdbc_query",
    """SELECT * FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
)
def scan_jdbc_query(spark: SparkSession, sf: str) -> DataFrame:
    """The windowed source query, with Parquet files standing in for the database."""
    source = ParquetSource(lambda schema, table: f"{sf}/{table}.parquet")
    return scan_source_query(spark, source, "Sales", "orders", "o_orderdate", "1996-01-01", "1998-01-01")


@query("scan_table", "SELECT * FROM orders")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    """The newest version of a table that was written twice."""
    table = LakeTable(spark, scratch_path(spark, "orders-lake"), ("o_orderkey",), "o_orderdate")
    rows = m.table(spark, sf, "orders")
    table.overwrite(rows.withColumn("o_orderstatus", F.lit("old")))
    table.overwrite(rows)
    return table.read()


@query(
    "scan_entity",
    """SELECT c_custkey AS CustomerId, c_name AS Customer,
    CAST(DATE '1970-01-01' + c_nationkey AS DATE) AS BirthDate FROM customer""",
)
def scan_entity_query(spark: SparkSession, sf: str) -> DataFrame:
    """An entity whose rows lie in two partitions."""
    folder = scratch_path(spark, "entity")
    rows = m.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CustomerId"),
        F.col("c_name").alias("Customer"),
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("c_nationkey")).alias("BirthDate"),
    )
    halves = {"a": F.col("BirthDate") < "1970-01-13", "b": F.col("BirthDate") >= "1970-01-13"}
    for name, half in halves.items():
        rows.filter(half).write.csv(f"{folder}/{name}")
    entity = {
        "name": "Customer",
        "attributes": [
            {"name": "CustomerId", "dataType": "int64"},
            {"name": "Customer", "dataType": "string"},
            {"name": "BirthDate", "dataType": "date"},
        ],
        "partitions": [{"name": n, "location": f"{folder}/{n}"} for n in halves],
    }
    text = json.dumps({"name": "Model", "entities": [entity]})
    local_rows(spark, [(text,)], "value string").coalesce(1).write.text(f"{folder}/model")
    return scan_entity(spark, f"{folder}/model", "Customer")


@query(
    "seed_dates",
    m.sql(
        """SELECT OrderDate, count(*) AS orders FROM m_orders WHERE OrderDate IN
        (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')
        GROUP BY OrderDate"""
    ),
)
def seed_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Days with an urgent order as a seed list, then the orders placed on those days."""
    path = scratch_path(spark, "seed")
    urgent = m.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    days = urgent.select(F.col("o_orderdate").cast("date").alias("full_moon_date")).distinct()
    fs.export_csv(days, path)
    seed = fs.seed_dates(spark, path)
    daily = m.orders(spark, sf).groupBy("OrderDate").agg(F.count("*").alias("orders"))
    return daily.join(seed, F.col("OrderDate") == F.col("full_moon_date"), "left_semi")


@query(
    "scan_rejects",
    """SELECT 'row' AS kind, o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, NULL AS reason FROM orders
        WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P'
    UNION ALL SELECT 'reject', o_orderkey, NULL, 'day: urgent is no date' FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'
    UNION ALL SELECT 'reject', o_orderkey, NULL, 'header: day,id' FROM orders WHERE o_orderstatus = 'P'""",
)
def scan_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Order days as CSV, some of them no dates, and one file with its columns swapped; the rejects beside the rows."""
    folder = scratch_path(spark, "days")
    day = F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    days = m.table(spark, sf, "orders").select("o_orderstatus", F.col("o_orderkey").alias("id"), day.alias("day"))
    swapped = F.col("o_orderstatus") == "P"
    fs.export_csv(days.filter(~swapped).select("id", "day"), f"{folder}/good")
    fs.export_csv(days.filter(swapped).select("day", "id"), f"{folder}/swapped")
    found = scan_csv_checked(spark, [f"{folder}/good", f"{folder}/swapped"], "id long, day date")
    values = F.split("text", ",")
    number = F.coalesce(F.try_element_at(values, F.lit(1)).try_cast("long"), F.try_element_at(values, F.lit(2)).try_cast("long"))
    return found.rows.select(F.lit("row").alias("kind"), "id", "day", F.lit(None).cast("string").alias("reason")).unionByName(
        found.rejects.select(F.lit("reject").alias("kind"), number.alias("id"), F.lit(None).cast("date").alias("day"), "reason")
    )


# -- sinks and table changes -----------------------------------------------


@query("write_overwrite", "SELECT * FROM customer")
def write_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """The table is replaced by a plan that reads the table itself."""
    table = LakeTable(spark, scratch_path(spark, "overwrite"))
    rows = m.table(spark, sf, "customer")
    table.overwrite(rows.withColumn("c_name", F.concat(F.lit("old "), "c_name")))
    table.overwrite(table.read().withColumn("c_name", F.expr("substring(c_name, 5)")))
    return table.read()


@query("write_create", "SELECT * FROM supplier")
def write_create(spark: SparkSession, sf: str) -> DataFrame:
    table = LakeTable(spark, scratch_path(spark, "create"))
    table.create(m.table(spark, sf, "supplier"))
    return table.read()


@query("write_staging", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'")
def write_staging(spark: SparkSession, sf: str) -> DataFrame:
    source = ParquetSource(lambda schema, table: f"{sf}/{table}.parquet")
    window = scan_source_query(spark, source, "Sales", "orders", "o_orderdate", "2001-01-01")
    return spark.read.parquet(fs.write_staging(window, scratch_path(spark, "files"), "Orders"))


TRIP_DAYS = (("2024-01-01", "2024-01-10"), ("2024-01-16", "2024-01-25"))
TRIP_DAYS_SQL = " UNION ALL ".join(
    f"SELECT * FROM m_trips WHERE tpep_pickup_datetime >= DATE '{a}' AND tpep_pickup_datetime < DATE '{b}'"
    for a, b in TRIP_DAYS
)


def two_trip_files(spark: SparkSession, sf: str, kind: str) -> list[DataFrame]:
    """The trips in two files, split after the fifteenth, each behind its trip view."""
    rows = m.trips(spark, sf)
    early = F.col(tr.PICKUP) < F.lit("2024-01-16").cast("timestamp_ntz")
    views = []
    for part in (rows.filter(early), rows.filter(~early)):
        path = scratch_path(spark, f"trips-{kind}")
        if kind == "csv":
            fs.export_csv(part, path)
            views.append(tr.trips_csv(spark, path))
        else:
            fs.export_parquet(part, path)
            views.append(tr.trips_parquet(spark, path))
    return views


def trips_of_days(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    views = two_trip_files(spark, sf, kind)
    return tr.trips_union([(v, *days) for v, days in zip(views, TRIP_DAYS, strict=True)])


@query("export_csv", m.sql(TRIP_DAYS_SQL))
def export_csv(spark: SparkSession, sf: str) -> DataFrame:
    trips = trips_of_days(spark, sf, "csv")
    path = scratch_path(spark, "trips-ext-csv")
    fs.export_csv(trips, path)
    return fs.scan_csv_typed(spark, path, trips.schema)


@query("export_parquet", m.sql(TRIP_DAYS_SQL))
def export_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "trips-ext-parquet")
    fs.export_parquet(trips_of_days(spark, sf, "parquet"), path)
    return fs.scan_parquet(spark, path)


@query(
    "ctas_aggregate",
    m.sql(
        """SELECT c.year AS CalendarYear, CAST(sum(s.Quantity) AS BIGINT) AS SumOfQuantity
        FROM m_sales s LEFT JOIN m_report_days c ON s.DateKey = c.date GROUP BY c.year"""
    ),
)
def ctas_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    calendar = m.report_calendar(spark, sf).select("date", F.col("year").alias("CalendarYear"))
    yearly = summarize_columns(
        m.sales_by_order(spark, sf), calendar, ("DateKey", "date"), ["CalendarYear"], {"SumOfQuantity": "Quantity"}
    )
    return fs.ctas(yearly, "sales_by_year", scratch_path(spark, "sales-by-year"))


DIM_SUPPLIER_SQL = """SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS INTEGER) AS SupplierKey,
    CAST(s_suppkey AS INTEGER) AS SupplierID, s_name AS SupplierName,
    'Category ' || n_name AS SupplierCategoryName, DATE '2013-01-01' AS ValidFromDate
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey"""


@query("create_or_replace_as", m.sql(DIM_SUPPLIER_SQL))
def create_or_replace_as(spark: SparkSession, sf: str) -> DataFrame:
    table = LakeTable(spark, scratch_path(spark, "dim-supplier"))
    rows = dim_supplier(m.suppliers(spark, sf), m.supplier_categories(spark, sf))
    table.overwrite(rows.limit(0))
    table.overwrite(rows)
    return table.read()


@query(
    "write_partitioned",
    m.sql(
        """SELECT CAST(year(DateKey) * 100 + month(DateKey) AS INTEGER) AS YearMonth,
        count(*) AS sales, CAST(sum(Quantity) AS BIGINT) AS Quantity, sum(Amount) AS Amount
        FROM m_sales WHERE year(DateKey) >= 1998 GROUP BY 1"""
    ),
)
def write_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """The sales fact stored by month, then the months from 1998 on; older folders are skipped."""
    path = scratch_path(spark, "sales-by-month")
    month = (F.year("DateKey") * 100 + F.month("DateKey")).alias("YearMonth")
    fs.write_partitioned(m.sales(spark, sf).select("*", month), path, "YearMonth")
    stored = spark.read.parquet(path).filter(F.col("YearMonth") >= 199801)
    return stored.groupBy("YearMonth").agg(
        F.count("*").alias("sales"),
        F.sum("Quantity").alias("Quantity"),
        F.sum("Amount").cast("decimal(38,2)").alias("Amount"),
    )


@query(
    "truncate_load",
    m.sql("SELECT PersonID, FullName FROM m_people WHERE IsSalesperson"),
)
def truncate_load(spark: SparkSession, sf: str) -> DataFrame:
    """All rows are replaced; the stored column order and types stay."""
    table = LakeTable(spark, scratch_path(spark, "salesperson"))
    people = m.people(spark, sf)
    table.create(people.select("PersonID", "FullName"))
    table.truncate_load(
        people.filter("IsSalesperson").select("FullName", F.col("PersonID").cast("string").alias("PersonID"))
    )
    return table.read()


@query(
    "append_rows",
    """SELECT user_id AS listing_id, ts AS date, event_type AS reviewer_name, props AS comments,
    'neutral' AS sentiment FROM events
    UNION ALL SELECT c_custkey, TIMESTAMP '2024-02-01 12:00:00', c_name, 'quiet rooms', 'positive'
    FROM customer""",
)
def append_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews from events, then a batch from customers stamped with the time of loading."""
    table = LakeTable(spark, scratch_path(spark, "reviews"), mark="date")
    table.create(
        m.table(spark, sf, "events").select(
            F.col("user_id").alias("listing_id"),
            F.col("ts").alias("date"),
            F.col("event_type").alias("reviewer_name"),
            F.col("props").alias("comments"),
            F.lit("neutral").alias("sentiment"),
        )
    )
    table.append(
        m.table(spark, sf, "customer").select(
            F.col("c_custkey").alias("listing_id"),
            load_time("2024-02-01 12:00:00").alias("date"),
            F.col("c_name").alias("reviewer_name"),
            F.lit("quiet rooms").alias("comments"),
            F.lit("positive").alias("sentiment"),
        )
    )
    return table.read()


@query(
    "reload_partition",
    m.sql(
        """SELECT CAST(year(DateKey) AS INTEGER) AS Year, count(*) AS sales,
        CAST(sum(Quantity + CASE WHEN year(DateKey) = 1997 THEN 1 ELSE 0 END) AS BIGINT) AS Quantity
        FROM m_sales GROUP BY 1"""
    ),
)
def reload_partition(spark: SparkSession, sf: str) -> DataFrame:
    """The sales fact by year; 1997 is loaded again with one more of everything."""
    path = scratch_path(spark, "sales-by-year")
    fact = m.sales(spark, sf).withColumn("Year", F.year("DateKey"))
    fs.write_partitioned(fact, path, "Year")
    again = spark.read.parquet(path).filter("Year = 1997").withColumn("Quantity", F.col("Quantity") + 1)
    fs.reload_partition(again, path, "Year")
    stored = spark.read.parquet(path)
    return stored.groupBy("Year").agg(F.count("*").alias("sales"), F.sum("Quantity").alias("Quantity"))


@query(
    "drop_tables",
    """SELECT n_name AS name, count(*) AS customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def drop_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables are saved and dropped, a third keeps its rows; unknown names are no error."""
    customer, nation = m.table(spark, sf, "customer"), m.table(spark, sf, "nation")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    for name, key in (("by_segment", "c_mktsegment"), ("by_region", "n_regionkey"), ("by_nation", "n_name")):
        counts = named.groupBy(F.col(key).alias("name")).agg(F.count("*").alias("customers"))
        fs.ctas(counts, f"customers_{name}", scratch_path(spark, name))
    fs.drop_tables(spark, ["customers_by_segment", "customers_by_region", "customers_by_size"])
    left = [t.name for t in spark.catalog.listTables(pattern="customers_by_*")]
    return spark.table(left[0])


@query("define_view", m.sql(TRIP_DAYS_SQL))
def define_view(spark: SparkSession, sf: str) -> DataFrame:
    fs.define_view(m.table(spark, sf, "nation"), "trips_of_days")
    return fs.define_view(trips_of_days(spark, sf, "parquet"), "trips_of_days")


@query("bucketed_table", "SELECT * FROM orders")
def bucketed_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table split into buckets by ranges of its key."""
    table = LakeTable(
        spark, scratch_path(spark, "orders-buckets"), ("o_orderkey",), "o_orderdate", range_layout(1 << 22)
    )
    table.overwrite(m.table(spark, sf, "orders"))
    return table.read()
