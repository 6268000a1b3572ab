"""``YYYYMM`` months, as Python strings and as string columns.

The column helpers are integer arithmetic on the digits, which stays inside
generated code; none of them parses dates except ``first_day_of``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH_PATTERN = "^[0-9]{4}(0[1-9]|1[0-2])$"


def check_month(month: str) -> str:
    """The month itself, or ``ValueError`` if it is not a calendar month."""
    if not re.match(MONTH_PATTERN, str(month)):
        raise ValueError(f"not a YYYYMM month: {month!r}")
    return str(month)


def previous_month(month: str) -> str:
    year, number = divmod(int(check_month(month)), 100)
    return f"{year - 1:04d}12" if number == 1 else f"{year:04d}{number - 1:02d}"


def first_day(month: str) -> date:
    year, number = divmod(int(check_month(month)), 100)
    return date(year, number, 1)


def month_list(months: str | Sequence[str] | None) -> list[str] | None:
    """One month or several as a checked list; None stands for all months."""
    if months is None:
        return None
    return [check_month(m) for m in ([months] if isinstance(months, str) else months)]


def in_months(rows: DataFrame, months: Sequence[str] | None, column: str = "set_month") -> DataFrame:
    """Rows of the given months, as a filter that prunes month partitions."""
    return rows if months is None else rows.filter(F.col(column).isin(list(months)))


def month_number(month: Column) -> Column:
    """``'202403'`` as the integer 202403; text order and number order agree."""
    return month.cast("int")


def month_text(number: Column) -> Column:
    """The reverse, for four-digit years."""
    return number.cast("string")


def month_of(day: Column) -> Column:
    """The month a date or timestamp lies in."""
    return month_text(F.year(day) * 100 + F.month(day))


def not_before(day: Column, number: Column) -> Column:
    """Whether a date lies on or after the first day of the month so numbered."""
    return F.year(day) * 100 + F.month(day) >= number


def year_of(text: Column) -> Column:
    """The year part of a ``YYYY…`` text."""
    return F.left(text, F.lit(4))


def following_number(number: Column) -> Column:
    """The number of the month after: 202412 is followed by 202501."""
    return F.when(number % 100 == 12, number + 89).otherwise(number + 1)


def month_index(number: Column) -> Column:
    """Months since year zero, so that a month and the next differ by one."""
    return F.floor(number / 100).cast("int") * 12 + number % 100 - 1


def month_at(index: Column) -> Column:
    """The reverse: the number of the month with that index."""
    return F.floor(index / 12).cast("int") * 100 + index % 12 + 1


def previous_month_of(month: Column) -> Column:
    number = month_number(month)
    return month_text(F.when(number % 100 == 1, number - 89).otherwise(number - 1))


def next_month_of(month: Column) -> Column:
    return month_text(following_number(month_number(month)))


def first_day_of(month: Column) -> Column:
    return F.to_date(month, "yyyyMM")
