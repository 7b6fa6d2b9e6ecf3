"""Queries for the scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnhouse.catalogue import model as m
from tarnhouse.catalogue.registry import query
from tarnhouse.functions import dates as D
from tarnhouse.functions import numbers as N
from tarnhouse.functions import text as T


@query(
    "fn_date_parts",
    m.sql(
        """SELECT OrderID, CAST(day(OrderDate) AS INTEGER) AS day, CAST(month(OrderDate) AS INTEGER) AS month,
        CAST(quarter(OrderDate) AS INTEGER) AS quarter, CAST(year(OrderDate) AS INTEGER) AS year,
        CAST(dayofyear(OrderDate) AS INTEGER) AS day_of_year,
        CAST(dayofweek(OrderDate) + 1 AS INTEGER) AS day_of_week_sunday_one,
        CAST(isodow(OrderDate) - 1 AS INTEGER) AS day_of_week,
        CAST(dayofweek(OrderDate) AS INTEGER) AS day_of_week_from_sunday FROM m_orders"""
    ),
)
def fn_date_parts(spark: SparkSession, sf: str) -> DataFrame:
    d = "OrderDate"
    return m.orders(spark, sf).select(
        "OrderID",
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.dayofyear(d).alias("day_of_year"),
        D.day_of_week_sunday_one(d).alias("day_of_week_sunday_one"),
        D.day_of_week(d).alias("day_of_week"),
        D.day_of_week(d, first_day=6).alias("day_of_week_from_sunday"),
    )


@query(
    "fn_names",
    m.sql(
        """SELECT OrderID, dayname(OrderDate) AS day_name, monthname(OrderDate) AS month_name,
        substring(monthname(OrderDate), 1, 3) AS month_short,
        'Q' || CAST(quarter(OrderDate) AS VARCHAR) || ' ' || CAST(year(OrderDate) AS VARCHAR) AS quarter_text,
        strftime(LastEditedWhen, '%Y-%m-%d %H:%M:%S') AS mark_text FROM m_orders"""
    ),
)
def fn_names(spark: SparkSession, sf: str) -> DataFrame:
    d = "OrderDate"
    return m.orders(spark, sf).select(
        "OrderID",
        D.day_name(d).alias("day_name"),
        D.month_name(d).alias("month_name"),
        T.first_three(D.month_name(d)).alias("month_short"),
        F.concat(F.lit("Q"), F.quarter(d), F.lit(" "), F.year(d)).alias("quarter_text"),
        D.mark_text("LastEditedWhen").alias("mark_text"),
    )


ITALIAN_DAYS = ["lunedì", "martedì", "mercoledì", "giovedì", "venerdì", "sabato", "domenica"]


@query(
    "fn_localised",
    m.sql(
        "SELECT OrderID, CASE isodow(OrderDate) "
        + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(ITALIAN_DAYS, 1))
        + " END AS day_name FROM m_orders"
    ),
)
def fn_localised(spark: SparkSession, sf: str) -> DataFrame:
    return m.orders(spark, sf).select("OrderID", D.localised("OrderDate", "EEEE", "it-IT").alias("day_name"))


@query(
    "fn_weeks",
    m.sql(
        """SELECT OrderID,
        CAST(floor((dayofyear(OrderDate) - 1 + isodow(date_trunc('year', OrderDate)) - 1) / 7) + 1 AS INTEGER)
            AS week_of_year,
        CAST(floor((day(OrderDate) - 1 + isodow(date_trunc('month', OrderDate)) - 1) / 7) + 1 AS INTEGER)
            AS week_of_month,
        CAST(OrderDate + CAST(7 - isodow(OrderDate) AS INTEGER) AS DATE) AS end_of_week FROM m_orders"""
    ),
)
def fn_weeks(spark: SparkSession, sf: str) -> DataFrame:
    d = "OrderDate"
    return m.orders(spark, sf).select(
        "OrderID",
        D.week_of_year(d).alias("week_of_year"),
        D.week_of_month(d).alias("week_of_month"),
        D.end_of_week(d).alias("end_of_week"),
    )


@query(
    "fn_number_days",
    m.sql("SELECT OrderID, CAST(dayofyear(OrderDate) AS INTEGER) AS NumberDays FROM m_orders"),
)
def fn_number_days(spark: SparkSession, sf: str) -> DataFrame:
    return m.orders(spark, sf).select("OrderID", D.number_days("OrderDate").alias("NumberDays"))


@query(
    "fn_days_between",
    m.sql(
        """SELECT l.OrderID, l.OrderLineID,
        CAST(CAST(l.LastEditedWhen AS DATE) - o.OrderDate AS INTEGER) AS days
        FROM m_lines l JOIN m_orders o ON o.OrderID = l.OrderID"""
    ),
)
def fn_days_between(spark: SparkSession, sf: str) -> DataFrame:
    order = m.orders(spark, sf).select("OrderID", "OrderDate")
    return (
        m.lines(spark, sf)
        .select("OrderID", "OrderLineID", "LastEditedWhen")
        .join(order, "OrderID")
        .select(
            "OrderID", "OrderLineID", D.days_between(F.col("LastEditedWhen"), F.col("OrderDate")).alias("days")
        )
    )


@query(
    "fn_date_list",
    """SELECT CAST(d AS DATE) AS day, count(*) AS open_orders FROM (
        SELECT unnest(generate_series(o_orderdate, o_orderdate + INTERVAL 6 DAY, INTERVAL 1 DAY)) AS d
        FROM orders) GROUP BY 1""",
)
def fn_date_list(spark: SparkSession, sf: str) -> DataFrame:
    """The seven days from each order date, counted."""
    day = F.col("o_orderdate").cast("date")
    week = F.explode(F.sequence(day, F.date_add(day, 6), F.expr("INTERVAL 1 DAY")))
    days = m.table(spark, sf, "orders").select(week.alias("day"))
    return days.groupBy("day").agg(F.count("*").alias("open_orders"))


@query(
    "fn_safe_divide",
    """SELECT l_orderkey, l_linenumber, CASE WHEN CAST(l_discount AS DECIMAL(18,2)) = 0 THEN NULL
    ELSE round(l_quantity / l_discount, 6) END AS ratio FROM lineitem""",
)
def fn_safe_divide(spark: SparkSession, sf: str) -> DataFrame:
    ratio = N.safe_divide("l_quantity", "l_discount")
    return m.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(ratio, 6).alias("ratio"))


@query(
    "fn_text",
    """SELECT p_partkey, concat_ws('-', p_name, nullif(p_type, 'SMALL'), CAST(p_size AS VARCHAR)) AS combined,
    replace(p_name, 'r', 'R') AS replaced, string_split(p_brand, '#')[2] AS part,
    coalesce(nullif(p_type, 'SMALL'), 'Undefined') AS kind, substring(p_name, 2, 3) AS middle,
    CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size FROM part""",
)
def fn_text(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.nullif(F.col("p_type"), F.lit("SMALL"))
    return m.table(spark, sf, "part").select(
        "p_partkey",
        T.combine_text("-", "p_name", kind, F.col("p_size").cast("string")).alias("combined"),
        F.replace("p_name", F.lit("r"), F.lit("R")).alias("replaced"),
        T.split_part("p_brand", "#", 1).alias("part"),
        T.null_default(kind, "Undefined").alias("kind"),
        F.substring("p_name", 2, 3).alias("middle"),
        F.when(F.col("p_size") > 25, "large").otherwise("small").alias("size"),
    )
