from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cedeflow.functions import factors, months
from helpers import rows


def test_month_strings():
    assert months.previous_month("202401") == "202312"
    assert months.previous_month("202412") == "202411"
    assert months.first_day("202402") == date(2024, 2, 1)
    assert months.month_list("202401") == ["202401"]
    assert months.month_list(None) is None


@pytest.mark.parametrize("bad", ["2024", "202413", "202400", "2024-1", "202401x"])
def test_bad_months_are_refused(bad):
    with pytest.raises(ValueError):
        months.previous_month(bad)


def test_month_columns(frame):
    df = frame("m string", ("202401",), ("202412",), ("202406",))
    m = F.col("m")
    got = rows(df.select(m, months.previous_month_of(m), months.next_month_of(m), months.year_of(m)))
    assert got == [
        ("202401", "202312", "202402", "2024"),
        ("202406", "202405", "202407", "2024"),
        ("202412", "202411", "202501", "2024"),
    ]


def test_not_before(frame):
    df = frame(
        "d date, m string",
        (date(2024, 1, 31), "202402"),
        (date(2024, 2, 1), "202402"),
        (date(2024, 3, 9), "202402"),
        (None, "202402"),
    )
    kept = rows(df.filter(months.not_before(F.col("d"), months.month_number(F.col("m")))).select("d"))
    assert kept == [(date(2024, 2, 1),), (date(2024, 3, 9),)]


def test_flag_shares_and_loads_with_null_and_unknown_codes(frame):
    df = frame("c string", ("P",), ("AF",), ("3C",), ("other",), (None,))
    c = F.col("c")
    got = dict(
        (r[0], tuple(r)[1:])
        for r in df.select(
            c, factors.quota_share(c), factors.issue_load(c), factors.claim_load(c)
        ).collect()
    )
    d = Decimal
    assert got["P"] == (d("0.65"), d("1.2"), d("1.13"))
    assert got["AF"] == (d("0.40"), d("1.2"), d("1.13"))
    assert got["3C"] == (d("0.40"), d("1.0"), d("1.04"))
    assert got["other"] == got[None] == (d("0.40"), d("1.0"), d("1.13"))


def test_factor_times_double_is_double(frame):
    df = frame("v double, c string", (10.0, "P"))
    product = df.select((F.col("v") * factors.quota_share(F.col("c"))).alias("x"))
    assert product.schema["x"].dataType.typeName() == "double"
    assert rows(product) == [(6.5,)]


def test_inflation(frame):
    df = frame("m string", ("202301",), ("202512",))
    got = rows(df.select(F.col("m"), factors.inflation(F.col("m"), 0.02, 2023)))
    assert got == [("202301", 1.0), ("202512", pytest.approx(1.0404))]


def test_tranches_with_their_gaps(frame):
    expected = {
        date(2017, 9, 29): 1,
        date(2017, 9, 30): None,
        date(2017, 10, 1): 2,
        date(2018, 9, 30): 2,
        date(2018, 10, 1): 3,
        date(2020, 9, 30): 3,
        date(2020, 10, 1): 4,
        date(2022, 9, 30): 4,
        date(2022, 10, 1): None,
        None: None,
    }
    df = frame("d date", *[(d,) for d in expected])
    assert dict(df.select("d", factors.tranche_of(F.col("d"))).collect()) == expected


def test_tranche_of_a_timestamp_is_that_of_its_day(frame):
    df = frame("d timestamp", (datetime(2018, 9, 30, 23, 59),))
    assert rows(df.select(factors.tranche_of(F.col("d")))) == [(2,)]
