"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CURRENCY = "decimal(19,4)"
MONEY = "decimal(18,2)"
WHOLE = "decimal(18,0)"


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def to_currency(column: str | Column) -> Column:
    """Text in en-US form, such as ``$1,234.50``, with four decimals; unreadable text is null.

    An amount in parentheses is negative.
    """
    plain = F.translate(_col(column), "$,", "")
    return F.regexp_replace(plain, r"^\s*\((.*)\)\s*$", "-$1").try_cast(CURRENCY)


def currency_to_int(column: str | Column) -> Column:
    """Currency to a whole number; halves go to the even neighbour."""
    return F.bround(_col(column), 0).cast("long")


def text_to_int(column: str | Column) -> Column:
    """A number in text as a whole number; halves go to the even neighbour."""
    return F.bround(_col(column).cast("decimal(38,10)"), 0).cast("long")


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """The quotient, or null when the denominator is zero or null."""
    return F.try_divide(_col(numerator), _col(denominator))


def extended_price(quantity: str | Column, unit_price: str | Column) -> Column:
    return _col(quantity) * _col(unit_price)


def latest_of_two(first: str | Column, second: str | Column) -> Column:
    """``first`` if it is later, else ``second``, also when either is null."""
    return F.when(_col(first) > _col(second), _col(first)).otherwise(_col(second))
