"""Rate factors as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed


def rate_by_code(code: Column, rates: Mapping[str, Decimal], other: Decimal) -> Column:
    """The rate of each code; unlisted and NULL codes take ``other``."""
    result = None
    for value, rate in rates.items():
        test = code == value
        result = F.when(test, F.lit(rate)) if result is None else result.when(test, F.lit(rate))
    return F.lit(other) if result is None else result.otherwise(F.lit(other))


def quota_share(flag: Column) -> Column:
    """The ceded share of a policy by its reinsurance flag."""
    return rate_by_code(flag, fixed.FLAG_SHARES, fixed.OTHER_FLAG_SHARE)


def load_factor(code: Column, codes: Iterable[str], load: Decimal, other: Decimal) -> Column:
    """An expense load for the listed codes; NULL counts as not listed."""
    return F.when(code.isin(list(codes)), F.lit(load)).otherwise(F.lit(other))


def issue_load(flag: Column) -> Column:
    return load_factor(flag, fixed.ISSUE_LOAD_FLAGS, fixed.ISSUE_LOAD, fixed.OTHER_ISSUE_LOAD)


def claim_load(code: Column) -> Column:
    return load_factor(code, fixed.CLAIM_LOAD_CODES, fixed.CLAIM_LOAD, fixed.OTHER_CLAIM_LOAD)


def inflation(month: Column, rate: float, base_year: int) -> Column:
    """``(1 + rate) ** (year - base_year)`` for a ``YYYYMM`` month."""
    years = F.left(month, F.lit(4)).cast("int") - base_year
    return F.pow(F.lit(1 + rate), years)


def tranche_of(
    day: Column,
    tranches: Iterable[tuple[int, date | None, date | None]] = fixed.LIFE_TRANCHES,
) -> Column:
    """The tranche whose range holds the day, NULL in a gap or after the last."""
    day = day.cast("date")
    result = None
    for number, first, last in tranches:
        if first is None:
            test = day <= F.lit(last)
        elif last is None:
            test = day >= F.lit(first)
        else:
            test = day.between(F.lit(first), F.lit(last))
        result = F.when(test, number) if result is None else result.when(test, number)
    return result
