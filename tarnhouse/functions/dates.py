"""Date functions. Weeks start on Monday unless ``first_day`` says otherwise."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# 0 is Monday, 6 is Sunday.
MONDAY = 0


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _day(value: str | date | Column) -> Column:
    """A date constant or a column as a date."""
    if isinstance(value, date):
        value = F.lit(value)
    return _col(value).cast("date")


def day_of_week(day: str | Column, first_day: int = MONDAY) -> Column:
    """Days since the start of the week, 0 to 6."""
    return F.pmod(F.weekday(_col(day)) - first_day, F.lit(7))


def day_of_week_sunday_one(day: str | Column) -> Column:
    """1 for Sunday to 7 for Saturday."""
    return F.dayofweek(_col(day))


def week_of_year(day: str | Column, first_day: int = MONDAY) -> Column:
    """Week number; the week that holds 1 January is week 1."""
    start = F.trunc(_col(day), "YEAR")
    return (
        F.floor((F.dayofyear(_col(day)) - 1 + day_of_week(start, first_day)) / 7) + 1
    ).cast("int")


def week_of_month(day: str | Column, first_day: int = MONDAY) -> Column:
    """Week number; the week that holds the first of the month is week 1."""
    start = F.trunc(_col(day), "MM")
    return (
        F.floor((F.dayofmonth(_col(day)) - 1 + day_of_week(start, first_day)) / 7) + 1
    ).cast("int")


def end_of_week(day: str | Column, first_day: int = MONDAY) -> Column:
    return F.date_add(_col(day), F.lit(6) - day_of_week(day, first_day))


def day_name(day: str | Column) -> Column:
    return F.date_format(_col(day), "EEEE")


def month_name(day: str | Column) -> Column:
    return F.date_format(_col(day), "MMMM")


def localised(day: str | Column, pattern: str, culture: str = "en-US") -> Column:
    """A date as text in the language of ``culture``, for names of days and months."""
    return F.to_csv(F.struct(_col(day).alias("d")), {"locale": culture, "dateFormat": pattern})


def date_key(day: str | Column) -> Column:
    """The date as a whole number such as 20130131."""
    d = _col(day)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def number_days(day: str | Column) -> Column:
    """Days of the year up to and including the date."""
    d = _col(day).cast("date")
    return F.datediff(d, F.trunc(d, "YEAR")) + 1


def days_between(end: str | date | Column, start: str | date | Column) -> Column:
    return F.datediff(_day(end), _day(start))


def years_customer(opened: str | Column, as_of: str | date | Column | None = None) -> Column:
    """Calendar-year boundaries between a date and ``as_of``, today when not given."""
    today = F.current_date() if as_of is None else _day(as_of)
    return F.year(today) - F.year(_col(opened))


def run_time(spark: SparkSession) -> datetime:
    """The time now, to be given to every load of a run: each query has a current time of its own."""
    return spark.range(1).select(F.current_timestamp().cast("timestamp_ntz")).first()[0]


def load_time(as_of: str | datetime | None = None) -> Column:
    """The time of loading: that of the run, a fixed one for a load that is repeated, or else of the query."""
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of))
    return now.cast("timestamp_ntz")


def date_from_us_text(column: str | Column) -> Column:
    """A date written month first, as in ``1/31/2013``; unreadable text is null."""
    return F.try_to_date(_col(column), "M/d/yyyy")


def mark_text(column: str | Column) -> Column:
    """A high-water mark as text, to the second."""
    return F.date_format(_col(column), "yyyy-MM-dd HH:mm:ss")
