from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed
from cedeflow.functions.factors import claim_load, inflation, issue_load, quota_share, tranche_of
from cedeflow.functions.sql_functions import register
from cedeflow.samples.queries import QUERIES
from cedeflow.samples.views import SampleViews
from helpers import plan_of, rows

SF = "/root/testdata/sf0.001"


def test_sql_functions_equal_the_columns(spark, frame):
    register(spark)
    assert set(register(spark)) == {"quota_share", "issue_load", "claim_load", "inflation", "tranche_of"}
    codes = {*fixed.FLAG_SHARES, *fixed.ISSUE_LOAD_FLAGS, *fixed.CLAIM_LOAD_CODES, "other", "", "o'k", None}
    frame("code string", *[(c,) for c in codes]).createOrReplaceTempView("codes")
    got = spark.sql("SELECT code, quota_share(code) q, issue_load(code) i, claim_load(code) c FROM codes")
    code = F.col("code")
    expected = spark.table("codes").select("code", quota_share(code), issue_load(code), claim_load(code))
    plain = [[float(x) if k else x for k, x in enumerate(r)] for r in rows(expected)]
    assert [[float(x) if k else x for k, x in enumerate(r)] for r in rows(got)] == plain

    ends = {d for _, *range_ in fixed.LIFE_TRANCHES for d in range_ if d}
    days = {d + timedelta(n) for d in ends for n in (-1, 0, 1)} | {None, date(1900, 1, 1), date(2100, 1, 1)}
    frame("day date", *[(d,) for d in days]).createOrReplaceTempView("days")
    assert rows(spark.sql("SELECT day, tranche_of(day) FROM days")) == rows(
        spark.table("days").select("day", tranche_of(F.col("day")))
    )

    frame("month string", ("202401",), ("201912",), (None,)).createOrReplaceTempView("some_months")
    assert rows(spark.sql("SELECT month, inflation(month, 0.025D, 2020) FROM some_months")) == rows(
        spark.table("some_months").select("month", inflation(F.col("month"), 0.025, 2020))
    )


def test_rate_factors_in_sql(spark):
    register(spark)
    SampleViews(spark, SF).snapshot().createOrReplaceTempView("rate_snapshot")
    got = spark.sql(
        """SELECT reins_flag, CAST(quota_share(reins_flag) AS DOUBLE) AS qs,
                  CAST(issue_load(reins_flag) AS DOUBLE) AS issue_load,
                  CAST(claim_load(reins_flag) AS DOUBLE) AS claim_load, ct
           FROM (SELECT reins_flag, count(*) AS ct FROM rate_snapshot GROUP BY reins_flag)"""
    )
    assert rows(got) == rows(QUERIES["rate_factors"](spark, SF), *got.columns)
    plan = plan_of(got)
    assert "CASE WHEN" in plan and "Python" not in plan and "quota_share" not in plan
