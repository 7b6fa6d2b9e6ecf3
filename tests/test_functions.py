from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnhouse.functions import dates as D
from tarnhouse.functions import numbers as N
from tarnhouse.functions import text as T


def one(spark, column, **values):
    df = spark.range(1)
    for name, (value, dtype) in values.items():
        df = df.withColumn(name, F.lit(value).cast(dtype))
    return df.select(column.alias("v")).head()["v"]


@pytest.mark.parametrize("first_day", [0, 6])
def test_week_numbers_count_from_the_week_of_the_first_day(spark, first_day):
    """Years whose 1 January falls on each weekday, checked by counting day by day."""
    days = [date(y, 1, 1) + timedelta(i) for y in range(2018, 2029) for i in range(366)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d",
        D.week_of_year("d", first_day).alias("y"),
        D.week_of_month("d", first_day).alias("m"),
        D.day_of_week("d", first_day).alias("w"),
        D.end_of_week("d", first_day).alias("e"),
    )
    for d, y, m, w, e in df.collect():
        def weeks(start, d=d):
            n, at = 1, start
            while at < d:
                at += timedelta(1)
                n += (at.weekday() - first_day) % 7 == 0
            return n

        assert (y, m) == (weeks(date(d.year, 1, 1)), weeks(d.replace(day=1)))
        assert w == (d.weekday() - first_day) % 7
        assert e == d + timedelta(6 - w)


def test_localised_names(spark):
    day = ("2024-08-03", "date")
    assert one(spark, D.localised("d", "EEEE", "it-IT"), d=day) == "sabato"
    assert one(spark, D.localised("d", "MMMM", "de-DE"), d=day) == "August"
    assert one(spark, D.localised("d", "MMMM"), d=day) == "August"


def test_number_days_and_years(spark):
    assert one(spark, D.number_days("d"), d=("2024-12-31", "date")) == 366
    # One day apart, yet one calendar year.
    assert one(spark, D.years_customer("d", date(2024, 1, 1)), d=("2023-12-31", "date")) == 1
    assert one(spark, D.days_between(date(2024, 3, 1), date(2024, 2, 1))) == 29


def test_us_dates_are_month_first(spark):
    for text in ("1/31/2013", "01/31/2013"):
        assert one(spark, D.date_from_us_text("d"), d=(text, "string")) == date(2013, 1, 31)
    assert one(spark, D.date_from_us_text("d"), d=("31/1/2013", "string")) is None


@pytest.mark.parametrize(
    ("amount", "whole"), [("12.5", 12), ("13.5", 14), ("16.5", 16), ("0.5", 0), ("-2.5", -2), ("2.51", 3)]
)
def test_currency_halves_go_to_even(spark, amount, whole):
    assert one(spark, N.currency_to_int("a"), a=(amount, N.CURRENCY)) == whole


def test_currency_text(spark):
    for text in ("1,234.50", "$1,234.50", "1234.5"):
        assert str(one(spark, N.to_currency("a"), a=(text, "string"))) == "1234.5000"
    assert one(spark, N.to_currency("a"), a=("none", "string")) is None


@pytest.mark.parametrize(
    ("a", "b", "latest"),
    [("2024-01-02", "2024-01-01", 2), ("2024-01-01", "2024-01-02", 2), (None, "2024-01-03", 3), ("2024-01-03", None, None)],
)
def test_latest_of_two_takes_the_second_when_either_is_blank(spark, a, b, latest):
    got = one(spark, N.latest_of_two("a", "b"), a=(a, "date"), b=(b, "date"))
    assert got == (date(2024, 1, latest) if latest else None)


def test_safe_divide(spark):
    assert one(spark, N.safe_divide("a", "b"), a=(6.0, "double"), b=(3.0, "double")) == 2.0
    assert one(spark, N.safe_divide("a", "b"), a=(6.0, "double"), b=(0.0, "double")) is None
    assert one(spark, N.safe_divide("a", "b"), a=(6.0, "double"), b=(None, "double")) is None


def test_text(spark):
    assert one(spark, T.first_three("a"), a=("ab", "string")) == "ab"
    assert one(spark, T.area_code("a"), a=("(308) 555-0100", "string")) == "308"
    assert one(spark, T.combine_text(" ", "a", "b"), a=("x", "string"), b=(None, "string")) == "x"
    assert one(spark, T.null_default("a", "Undefined"), a=(None, "string")) == "Undefined"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab.>| ", max_size=4), min_size=1, max_size=4), st.sampled_from([" > ", ".", "|", " "]))
def test_split_is_literal(spark, parts, sep):
    text = sep.join(parts)
    want = text.split(sep)
    for i in range(len(want) + 1):
        expected = want[i] if i < len(want) else None
        assert one(spark, T.split_part("t", sep, i), t=(text, "string")) == expected


def test_a_run_has_one_time(spark):
    from datetime import datetime

    from tarnhouse.functions.dates import load_time, run_time

    now = run_time(spark)
    assert isinstance(now, datetime)
    first, second = (spark.range(2).select(load_time(now).alias("t")).first()["t"] for _ in range(2))
    assert first == second == now
    later = spark.range(1).select(load_time().alias("t")).first()["t"]
    assert later >= now and dict(spark.range(1).select(load_time().alias("t")).dtypes) == {"t": "timestamp_ntz"}
