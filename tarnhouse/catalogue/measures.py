"""Queries for aggregates, ordering, unions, discounts and aggregate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.catalogue import model as m
from tarnhouse.catalogue.files import TRIP_DAYS_SQL, trips_of_days
from tarnhouse.catalogue.registry import query
from tarnhouse.operators import aggregates as ag
from tarnhouse.operators import discounts as dc
from tarnhouse.operators import ranking as rk
from tarnhouse.operators.bitmaps import distinct_bitmaps, united_bitmaps
from tarnhouse.operators.routing import Aggregate, Measure, aggregate_routing
from tarnhouse.operators.sets import union_distinct as union_distinct_rows
from tarnhouse.plans.trips import daily_amount as daily_amount_of
from tarnhouse.session import scratch_path
from tarnhouse.sources.lake import LakeTable


def years(spark: SparkSession, sf: str) -> DataFrame:
    """The report calendar as a year dimension."""
    return m.report_calendar(spark, sf).select("date", F.col("year").alias("CalendarYear"))


YEAR_KEY = ("DateKey", "date")


@query("count_all", 'SELECT count(*) AS "rows" FROM lineitem')
def count_all(spark: SparkSession, sf: str) -> DataFrame:
    return ag.count_all(m.table(spark, sf, "lineitem"))


SALES_BY_YEAR_SQL = m.sql(
    """SELECT c.year AS CalendarYear, CAST(sum(s.Quantity) AS BIGINT) AS SumOfQuantity
    FROM m_sales s LEFT JOIN m_report_days c ON s.DateKey = c.date GROUP BY c.year"""
)


@query("sales_by_year", SALES_BY_YEAR_SQL)
def sales_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return ag.summarize_columns(
        m.sales_by_order(spark, sf), years(spark, sf), YEAR_KEY, ["CalendarYear"], {"SumOfQuantity": "Quantity"}
    )


@query(
    "sales_by_customer_year",
    m.sql(
        """SELECT c.year AS CalendarYear, s.CustomerKey, CAST(sum(s.Quantity) AS BIGINT) AS SumOfQuantity
        FROM m_sales s LEFT JOIN m_report_days c ON s.DateKey = c.date GROUP BY 1, 2"""
    ),
)
def sales_by_customer_year(spark: SparkSession, sf: str) -> DataFrame:
    return ag.summarize_columns(
        m.sales_by_order(spark, sf),
        years(spark, sf),
        YEAR_KEY,
        ["CalendarYear"],
        {"SumOfQuantity": "Quantity"},
        keep=["CustomerKey"],
    )


@query(
    "daily_amount",
    m.sql(
        f"""SELECT tpep_pickup_datetime, CAST(sum(total_amount) AS DECIMAL(20,2)) AS total_amount
        FROM ({TRIP_DAYS_SQL}) GROUP BY 1"""
    ),
)
def daily_amount(spark: SparkSession, sf: str) -> DataFrame:
    return daily_amount_of(trips_of_days(spark, sf, "parquet"))


@query(
    "daily_amount_csv",
    m.sql(
        f"""SELECT tpep_pickup_datetime, CAST(sum(total_amount) AS DECIMAL(20,2)) AS total_amount
        FROM ({TRIP_DAYS_SQL}) GROUP BY 1"""
    ),
)
def daily_amount_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The same aggregate over the typed CSV files of the trips."""
    return daily_amount_of(trips_of_days(spark, sf, "csv"))


@query(
    "count_check",
    m.sql(f"""SELECT 'csv' AS kind, count(*) AS "rows" FROM ({TRIP_DAYS_SQL})
    UNION ALL SELECT 'parquet', count(*) FROM ({TRIP_DAYS_SQL})"""),
)
def count_check(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the trips by kind of file, which must agree."""
    counts = [ag.count_all(trips_of_days(spark, sf, k)).select(F.lit(k).alias("kind"), "rows") for k in ("csv", "parquet")]
    return counts[0].unionByName(counts[1])


@query(
    "orders_per_year",
    m.sql(
        """SELECT CAST(year(OrderDate) AS INTEGER) AS OrderDateYear, count(OrderDate) AS TotalOrderCount
        FROM m_orders GROUP BY 1"""
    ),
)
def orders_per_year(spark: SparkSession, sf: str) -> DataFrame:
    return ag.count_by(
        m.orders(spark, sf), F.year("OrderDate").alias("OrderDateYear"), "OrderDate", "TotalOrderCount"
    )


@query(
    "distinct_values",
    m.sql("SELECT DISTINCT Brand FROM m_items"),
)
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    """Brands, the missing one included."""
    return ag.distinct_values(m.stock_items(spark, sf), "Brand")


@query(
    "summarize_columns",
    m.sql(
        """SELECT g.BuyingGroupName, CAST(sum(s.Quantity) AS BIGINT) AS qty
        FROM m_sales s LEFT JOIN m_customers c ON c.CustomerID = s.CustomerKey
        LEFT JOIN m_groups g ON g.BuyingGroupID = c.BuyingGroupID GROUP BY 1
        HAVING sum(s.Quantity) IS NOT NULL"""
    ),
)
def summarize_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity by buying group; customers without one make up the blank group."""
    dim = m.customers(spark, sf).join(m.buying_groups(spark, sf), "BuyingGroupID", "left")
    return ag.summarize_columns(
        m.sales_by_order(spark, sf),
        dim.select("CustomerID", "BuyingGroupName"),
        ("CustomerKey", "CustomerID"),
        ["BuyingGroupName"],
        {"qty": "Quantity"},
    )


@query(
    "distinct_count",
    m.sql(
        """SELECT c.year AS CalendarYear,
        count(DISTINCT s.CustomerKey) + CAST(max(CASE WHEN s.CustomerKey IS NULL THEN 1 ELSE 0 END) AS BIGINT)
        AS qty FROM (SELECT DateKey, CASE WHEN CustomerKey > 10 THEN CustomerKey END AS CustomerKey
        FROM m_sales) s LEFT JOIN m_report_days c ON s.DateKey = c.date GROUP BY 1"""
    ),
)
def distinct_count(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers by year, where the first customers count as unknown."""
    fact = m.sales_by_order(spark, sf).withColumn("CustomerKey", F.expr("CASE WHEN CustomerKey > 10 THEN CustomerKey END"))
    return ag.distinct_count(fact, years(spark, sf), YEAR_KEY, ["CalendarYear"], "CustomerKey", "qty")


ROLLUP_SQL = """SELECT c.year AS CalendarYear, grouping(c.year) = 1 AS IsGrandTotalRowTotal,
    CAST(sum(s.Quantity) AS BIGINT) AS SumQuantity
    FROM m_sales s LEFT JOIN m_report_days c ON s.DateKey = c.date GROUP BY ROLLUP (c.year)"""


def yearly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    yearly = ag.summarize_columns(
        m.sales_by_order(spark, sf), years(spark, sf), YEAR_KEY, ["CalendarYear"], {"Quantity": "Quantity"}
    )
    return ag.rollup_subtotal(yearly, "CalendarYear", "Quantity", "SumQuantity")


@query("rollup_subtotal", m.sql(ROLLUP_SQL))
def rollup_subtotal(spark: SparkSession, sf: str) -> DataFrame:
    return yearly_rollup(spark, sf)


@query("calculate_sum", m.sql("SELECT CAST(sum(Quantity) AS BIGINT) AS SumQuantity FROM m_lines"))
def calculate_sum(spark: SparkSession, sf: str) -> DataFrame:
    return ag.calculate_sum(m.lines(spark, sf), "Quantity", "SumQuantity")


@query(
    "max_mark",
    """SELECT max(ts) AS max_mark FROM events
    UNION ALL SELECT TIMESTAMP '2013-01-01' AS max_mark""",
)
def max_mark(spark: SparkSession, sf: str) -> DataFrame:
    """The newest event, and the default for a month without events."""
    events = m.table(spark, sf, "events")
    return ag.max_mark(events, "ts").unionByName(ag.max_mark(events.filter("ts < '2020-01-01'"), "ts"))


# -- ordering ----------------------------------------------------------------


@query("order_result", m.sql(ROLLUP_SQL))
def order_result(spark: SparkSession, sf: str) -> DataFrame:
    return rk.order_result(yearly_rollup(spark, sf), ("IsGrandTotalRowTotal", False), ("CalendarYear", True))


@query(
    "top_n_ties",
    m.sql(
        """SELECT IsGrandTotalRowTotal, DateKey, Quantity FROM (
            SELECT *, rank() OVER (ORDER BY Quantity DESC NULLS LAST) AS r FROM (
                SELECT grouping(DateKey) = 1 AS IsGrandTotalRowTotal, DateKey,
                CAST(sum(Quantity) AS BIGINT) AS Quantity FROM m_sales GROUP BY ROLLUP (DateKey)))
        WHERE r <= 502"""
    ),
)
def top_n_ties(spark: SparkSession, sf: str) -> DataFrame:
    """The 502 best days, the grand total included, with every day that ties with the last.

    The daily totals are stored first, since the search for the last row and the final
    filter both read them.
    """
    daily = LakeTable(spark, scratch_path(spark, "daily"))
    daily.create(ag.rollup_subtotal(m.sales_by_order(spark, sf), "DateKey", "Quantity", "Quantity"))
    best = rk.top_n_ties(daily.read(), 502, ("Quantity", False))
    return best.select("IsGrandTotalRowTotal", "DateKey", "Quantity")


@query(
    "top_n_report",
    m.sql(
        f"""SELECT * FROM (SELECT *, rank() OVER (ORDER BY IsGrandTotalRowTotal ASC,
        CalendarYear ASC NULLS FIRST) AS r FROM ({ROLLUP_SQL})) WHERE r <= 4"""
    ).replace("SELECT * FROM (SELECT *, rank()", "SELECT * EXCLUDE (r) FROM (SELECT *, rank()"),
)
def top_n_report(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows by total flag and year; the blank year sorts before the others."""
    yearly = LakeTable(spark, scratch_path(spark, "yearly"))
    yearly.create(yearly_rollup(spark, sf))
    return rk.top_n_ties(yearly.read(), 4, ("IsGrandTotalRowTotal", True), ("CalendarYear", True))


@query(
    "surrogate_key",
    """SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS OrderKey,
    o_orderkey, o_orderdate FROM orders""",
)
def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    orders = m.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return rk.surrogate_key(orders, ["o_orderdate", "o_orderkey"], "OrderKey")


# -- unions --------------------------------------------------------------------


@query("union_months", m.sql(TRIP_DAYS_SQL))
def union_months(spark: SparkSession, sf: str) -> DataFrame:
    return trips_of_days(spark, sf, "parquet")


@query(
    "union_distinct",
    """SELECT p_brand AS name, p_type AS kind FROM part
    UNION SELECT c_mktsegment, 'segment' FROM customer
    UNION SELECT o_orderpriority, 'priority' FROM orders""",
)
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return union_distinct_rows(
        m.table(spark, sf, "part").select(F.col("p_brand").alias("name"), F.col("p_type").alias("kind")),
        m.table(spark, sf, "customer").select("c_mktsegment", F.lit("segment")),
        m.table(spark, sf, "orders").select("o_orderpriority", F.lit("priority")),
    )


# -- discounts -------------------------------------------------------------------

# Amounts are doubles here, as in the measures; results are rounded for comparison.
DISCOUNT_CTE = {
    "d_header": """SELECT o_orderkey AS OrderId, o_totalprice AS TotalDiscount FROM orders""",
    "d_detail": """SELECT l_orderkey AS OrderId, l_linenumber AS LineId,
        CASE WHEN l_orderkey < 20 THEN 0 ELSE l_extendedprice END AS UnitPrice,
        l_quantity AS Quantity FROM lineitem""",
    "d_pct": """SELECT h.OrderId, h.TotalDiscount, CASE WHEN v.value = 0 THEN NULL
        ELSE h.TotalDiscount / v.value END AS DiscountPct FROM d_header h LEFT JOIN (
        SELECT OrderId, sum(UnitPrice * Quantity) AS value FROM d_detail GROUP BY OrderId) v
        ON v.OrderId = h.OrderId""",
    "d_lines": """SELECT d.OrderId, d.LineId, d.UnitPrice, d.Quantity,
        d.Quantity * d.UnitPrice * p.DiscountPct AS LineDiscount
        FROM d_detail d LEFT JOIN d_pct p ON p.OrderId = d.OrderId""",
}


def header(spark: SparkSession, sf: str) -> DataFrame:
    return m.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("OrderId"), F.col("o_totalprice").alias("TotalDiscount")
    )


def detail(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines; those of the first orders are free, so their headers divide by zero."""
    return m.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("OrderId"),
        F.col("l_linenumber").alias("LineId"),
        F.when(F.col("l_orderkey") < 20, 0.0).otherwise(F.col("l_extendedprice")).alias("UnitPrice"),
        F.col("l_quantity").alias("Quantity"),
    )


def with_pct(spark: SparkSession, sf: str) -> DataFrame:
    return dc.discount_pct(header(spark, sf), detail(spark, sf))


@query(
    "discount_pct",
    m.sql(
        "SELECT OrderId, TotalDiscount, round(DiscountPct, 9) AS DiscountPct FROM d_pct", **DISCOUNT_CTE
    ),
)
def discount_pct(spark: SparkSession, sf: str) -> DataFrame:
    return with_pct(spark, sf).withColumn("DiscountPct", F.round("DiscountPct", 9))


@query(
    "line_discount",
    m.sql(
        "SELECT OrderId, LineId, UnitPrice, Quantity, round(LineDiscount, 4) AS LineDiscount FROM d_lines",
        **DISCOUNT_CTE,
    ),
)
def line_discount(spark: SparkSession, sf: str) -> DataFrame:
    lines = dc.line_discount(with_pct(spark, sf), detail(spark, sf))
    return lines.withColumn("LineDiscount", F.round("LineDiscount", 4))


@query(
    "discount_value_correct",
    m.sql(
        """SELECT round(sum(p.DiscountPct * d.UnitPrice * d.Quantity), 2) AS DiscountValueCorrect
        FROM d_detail d LEFT JOIN d_pct p ON p.OrderId = d.OrderId""",
        **DISCOUNT_CTE,
    ),
)
def discount_value_correct(spark: SparkSession, sf: str) -> DataFrame:
    value = dc.discount_value_correct(with_pct(spark, sf), detail(spark, sf))
    return value.select(F.round("DiscountValueCorrect", 2).alias("DiscountValueCorrect"))


@query(
    "discount_value",
    m.sql("SELECT round(sum(LineDiscount), 2) AS DiscountValue FROM d_lines", **DISCOUNT_CTE),
)
def discount_value(spark: SparkSession, sf: str) -> DataFrame:
    value = dc.discount_value(dc.line_discount(with_pct(spark, sf), detail(spark, sf)))
    return value.select(F.round("DiscountValue", 2).alias("DiscountValue"))


# -- aggregate tables ------------------------------------------------------------


@query(
    "aggregate_routing",
    m.sql(
        """SELECT c.year AS CalendarYear, CAST(sum(s.Quantity) AS BIGINT) AS qty,
        count(DISTINCT s.CustomerKey) AS customers
        FROM m_sales s LEFT JOIN m_report_days c ON s.DateKey = c.date GROUP BY 1"""
    ),
)
def aggregate_routing_query(spark: SparkSession, sf: str) -> DataFrame:
    """Two stored aggregates; only the one by customer and year can count customers.

    The fact is read once, for the finer aggregate; the coarser one is summed from it.
    """
    fact = m.sales_by_order(spark, sf)
    base = fact.join(years(spark, sf), F.col("DateKey") == F.col("date"), "left")
    finer = LakeTable(spark, scratch_path(spark, "by-customer-year"))
    sums = {"SumOfQuantity": "Quantity"}
    finer.create(
        # All groups are stored, also those without a quantity, so customers can be counted.
        ag.sum_by(base, ["CalendarYear", "CustomerKey"], sums)
    )
    coarser = LakeTable(spark, scratch_path(spark, "by-year"))
    coarser.create(ag.sum_by(finer.read(), ["CalendarYear"], {"SumOfQuantity": "SumOfQuantity"}))
    held = {"Quantity": "SumOfQuantity"}
    aggregates = [
        Aggregate("by_year", coarser.read, frozenset({"CalendarYear"}), held),
        Aggregate("by_customer_year", finer.read, frozenset({"CalendarYear", "CustomerKey"}), held, True),
    ]
    measures = [Measure("qty", "sum", "Quantity"), Measure("customers", "distinct_count", "CustomerKey")]
    return aggregate_routing(base, aggregates, ["CalendarYear"], measures)


@query(
    "aggregate_bitmaps",
    m.sql(
        """SELECT c.year AS CalendarYear, CAST(sum(s.Quantity) AS BIGINT) AS qty,
        count(DISTINCT s.CustomerKey) + CAST(max(CASE WHEN s.CustomerKey IS NULL THEN 1 ELSE 0 END) AS BIGINT)
        AS customers FROM (SELECT DateKey, Quantity, CASE WHEN CustomerKey > 10 THEN CustomerKey END AS CustomerKey
        FROM m_sales) s LEFT JOIN m_report_days c ON s.DateKey = c.date GROUP BY 1"""
    ),
)
def aggregate_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct customers by year from an aggregate by day, which holds no customers but bitmaps of them.

    The fact is read for the daily aggregate alone; the yearly bitmaps are united from the daily ones.
    """
    fact = m.sales_by_order(spark, sf).withColumn("CustomerKey", F.expr("CASE WHEN CustomerKey > 10 THEN CustomerKey END"))
    base = fact.join(years(spark, sf), F.col("DateKey") == F.col("date"), "left")
    path = scratch_path(spark, "fact-rows")
    base.select("CalendarYear", "DateKey", "CustomerKey", "Quantity").write.parquet(path)
    rows = spark.read.parquet(path)
    grain = ["CalendarYear", "DateKey"]
    sums, customers = (LakeTable(spark, scratch_path(spark, name)) for name in ("by-day", "customers-by-day"))
    sums.create(ag.sum_by(rows, grain, {"SumOfQuantity": "Quantity"}))
    customers.create(distinct_bitmaps(rows, grain, "CustomerKey"))
    yearly, by_year = (LakeTable(spark, scratch_path(spark, name)) for name in ("by-year", "customers-by-year"))
    yearly.create(ag.sum_by(sums.read(), ["CalendarYear"], {"SumOfQuantity": "SumOfQuantity"}))
    by_year.create(united_bitmaps(customers.read(), ["CalendarYear"]))
    held = {"Quantity": "SumOfQuantity"}
    aggregates = [
        Aggregate("by_day", sums.read, frozenset(grain), held, distinct={"CustomerKey": customers.read}),
        Aggregate("by_year", yearly.read, frozenset({"CalendarYear"}), held, distinct={"CustomerKey": by_year.read}),
    ]
    measures = [Measure("qty", "sum", "Quantity"), Measure("customers", "distinct_count", "CustomerKey")]
    return aggregate_routing(rows, aggregates, ["CalendarYear"], measures)
