from __future__ import annotations

from pyspark.sql import functions as F

from cedeflow.operators.cohorts import (
    active_not_surrendered,
    cohorts_migration,
    cohorts_monthly_policy,
    cohorts_policy,
    cohorts_single,
)
from cedeflow.operators.triangles import cohort_months, triangle_in_force, triangle_new
from helpers import plan_of, rows

SINGLE = "policy_number string, set_month string, reported_date string, gross_account_value double"


def test_single_snapshot(frame):
    snapshot = frame(
        SINGLE,
        ("a", "202312", "202312", 10.0),
        ("a", "202401", "202312", 10.0),
        ("a", "202401", "202312", 10.0),  # repeated rows count once
        ("b", "202401", "202401", 0.0),  # not in force, but seen for the first time
        ("b", "202402", "202401", 5.0),
        ("c", "202402", "202401", None),
        ("d", "202402", "202312", 5.0),
        ("d", "202403", "202401", 5.0),  # new once in each report year
        ("e", "202402", None, 5.0),
        (None, "202402", "202401", 5.0),
    )
    assert rows(cohorts_single(snapshot)) == [
        ("202312", "2023", 1, 1),
        ("202401", "2023", 1, 0),
        # no row for 202401/2024: b is new there but nothing is in force
        ("202402", "2023", 1, 1),
        ("202402", "2024", 1, 1),  # c counts as new, NULL policies count nowhere
        ("202402", None, 1, 0),
        ("202403", "2024", 1, 1),
    ]


def test_null_policies_alone_still_make_a_row(frame):
    snapshot = frame(SINGLE, (None, "202402", "202401", 5.0))
    assert rows(cohorts_single(snapshot)) == [("202402", "2024", 0, 0)]


def test_plan_groups_are_separate(frame):
    snapshot = frame(
        "policy_number string, set_month string, plangroup string, reported_date string,"
        " eom_fund_value double",
        ("a", "202401", "x", "202401", 1.0),
        ("a", "202402", "y", "202401", 1.0),
        ("a", "202403", None, "202401", 1.0),
    )
    got = cohorts_single(snapshot, value="eom_fund_value", by=["plangroup"])
    assert got.columns == [
        "set_month",
        "plangroup",
        "report_year",
        "ct_inforce",
        "new_issued_policies",
    ]
    assert rows(got) == [
        ("202401", "x", "2024", 1, 1),
        ("202402", "y", "2024", 1, 1),
        ("202403", None, "2024", 1, 0),
    ]


def test_single_snapshot_equals_sql(spark, frame):
    data = [
        (f"p{i % 17}", f"20{20 + (i * 7) % 5}{1 + (i * 5) % 12:02d}", f"20{18 + i % 4}01", i % 3 - 1.0)
        for i in range(400)
    ]
    frame(SINGLE, *data).createOrReplaceTempView("single")
    expected = spark.sql(
        """WITH f AS (SELECT policy_number, left(reported_date, 4) y, min(set_month) m
                      FROM single GROUP BY ALL),
                v AS (SELECT set_month, left(reported_date, 4) y, count(DISTINCT policy_number) n
                      FROM single WHERE gross_account_value > 0 GROUP BY ALL)
           SELECT v.set_month, v.y, v.n, count(f.policy_number)
           FROM v LEFT JOIN f ON f.m = v.set_month AND f.y = v.y GROUP BY ALL"""
    )
    assert rows(cohorts_single(spark.table("single"))) == rows(expected)


def test_policy_master_gives_the_year(frame):
    snapshot = frame(
        "policy_number string, set_month string, fund_value double",
        ("a", "202401", 0.0),
        ("a", "202402", 5.0),
        ("b", "202402", 5.0),
        ("orphan", "202402", 5.0),
        ("two", "202402", 5.0),
    )
    policies = frame(
        "policy_number string, reported_date string",
        ("a", "202312"),
        ("b", "202402"),
        ("two", "202312"),
        ("two", "202401"),
        ("two", "202402"),
    )
    assert rows(cohorts_policy(snapshot, policies)) == [
        ("202402", "2023", 2, 1),
        ("202402", "2024", 2, 2),
    ]


def test_monthly_policy_master(frame):
    snapshot = frame(
        "policynumber string, set_month string, creditstrategy string, totalpolicyav double",
        ("D1", "202401", "s", 5.0),
        ("D1", "202401", "t", 5.0),
        ("D1", "202402", "s", 5.0),
        ("D2", "202401", "s", 5.0),
        ("D3", "202401", "s", -1.0),
        ("D4", "202401", "other", 5.0),
        ("T1", "202401", "s", 5.0),
    )
    policies = frame(
        "policynumber string, set_month string, creditstrategy string, reported_date string",
        ("D1", "202401", "s", "202401"),
        ("D1", "202401", "t", "202312"),
        ("D1", "202402", "s", "202401"),
        ("D2", "202401", "s", "202401"),
        ("D3", "202401", "s", "202401"),
        ("D4", "202401", "s", "202401"),
        ("T1", "202401", "s", "202401"),
    )
    got = cohorts_monthly_policy(snapshot, policies, "D%")
    assert dict(got.dtypes)["report_year"] == "int"
    assert rows(got) == [
        ("202401", 2023, 1, 1),  # D1 is new under its smallest year
        ("202401", 2024, 2, 3),  # D2, D3 and D4
        ("202402", 2024, 1, 0),
    ]
    assert rows(cohorts_monthly_policy(snapshot, policies, "T%")) == [("202401", 2024, 1, 1)]
    # prefixes that overlap, one listed twice, one that nothing fits
    several = cohorts_monthly_policy(snapshot, policies, ["D%", "T%", "%1", "D%", "X%"])
    for prefix in ("D%", "T%", "%1", "X%"):
        part = several.filter(F.col("prefix") == prefix).drop("prefix")
        assert rows(part) == rows(cohorts_monthly_policy(snapshot, policies, prefix))


def test_prefixes_are_matched_in_one_pass(frame):
    snapshot = frame(
        "policynumber string, set_month string, creditstrategy string, totalpolicyav double",
        ("D1", "202401", "s", 5.0),
    )
    policies = frame(
        "policynumber string, set_month string, creditstrategy string, reported_date string",
        ("D1", "0009", "s", "202401"),
    )
    one, four = (
        plan_of(cohorts_monthly_policy(snapshot, policies, prefixes))
        for prefixes in (["D%"], ["D%", "T%", "X%", "%"])
    )
    assert four.count("Scan") == one.count("Scan") and four.count("Exchange") == one.count("Exchange")
    # a month of any text, also one with leading zeros
    assert rows(cohorts_monthly_policy(snapshot.withColumn("set_month", F.lit("0009")), policies)) == [
        ("0009", 2024, 1, 1)
    ]


NEW = "mpolicy string, set_month string, reported_date string, current_status string"


def test_migration(frame):
    new_system = frame(
        NEW,
        ("a", "202505", "202001", "Active"),  # a month before: doubled with the old system
        ("a", "202506", "202001", "Active"),
        ("b", "202506", "202506", "Active"),
        ("b", "202506", "202506", "Active"),  # rows, not policies
        ("c", "202506", "202506", "Lapsed"),
        ("d", "202506", "202506", "Active"),  # surrendered in the month
        ("a", "202507", "202001", "Active"),
        ("d", "202507", "202506", "Active"),
        ("e", "202507", "202507", "Active"),
        ("f", "202507", "202507", "Lapsed"),  # new by first month whatever its status
        ("e", "202508", None, "Active"),
    )
    old_system = frame(
        SINGLE, ("a", "202505", "202001", 1.0), ("z", "202506", "202001", 1.0)
    )
    surrenders = frame("policy_number string, set_month string", ("d", "202506"), ("e", "202509"))
    got = cohorts_migration(new_system, old_system, surrenders)
    assert rows(got) == [
        ("202505", "2020", 1, 1),
        ("202505", "2020", 1, 1),
        ("202506", "2020", 1, 0),
        ("202506", "2025", 2, 2),
        ("202507", "2020", 1, 0),
        ("202507", "2025", 1, 2),
        ("202508", None, 1, 0),
    ]
    other_month = cohorts_migration(new_system, old_system, surrenders, cut_over="202507")
    assert ("202506", "2020", 1, 1) in rows(other_month)


def test_null_surrender_empties_the_months_from_its_own_on(frame):
    new_system = frame(
        NEW, ("a", "202505", "202001", "Active"), ("a", "202507", "202001", "Active")
    )
    surrenders = frame("policy_number string, set_month string", (None, "202506"))
    got = active_not_surrendered(new_system, surrenders)
    assert rows(got, "mpolicy", "set_month", "n") == [("a", "202505", 1)]


COHORTS = "set_month string, plangroup string, report_year string, ct_inforce long, new_issued_policies long"


def test_triangles(frame):
    cohorts = frame(
        COHORTS,
        ("202401", "x", "2023", 5, 1),
        ("202401", "y", "2023", 7, 2),
        ("202402", "x", "2024", 3, 3),
        ("202403", "x", None, 9, 9),
    )
    assert cohort_months(cohorts) == ["202401", "202402"]
    assert triangle_new(cohorts).columns == ["report_year", "202401", "202402"]
    assert rows(triangle_new(cohorts)) == [("2023", 3, 0), ("2024", 0, 3)]
    assert rows(triangle_in_force(cohorts, ["202402", "202403"])) == [
        ("2023", 0, 0),
        ("2024", 3, 0),
    ]


def test_one_scan_and_one_wide_shuffle_of_the_snapshot(frame, spark, tmp_path):
    path = str(tmp_path / "snapshot")
    frame(SINGLE, ("a", "202401", "202401", 1.0), ("b", "202402", "202401", 1.0)).write.parquet(path)
    report = cohorts_single(spark.read.parquet(path))
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2  # by policy, then by month
    assert "Join" not in plan


def test_months_that_are_no_calendar_months_stay(frame):
    snapshot = frame(
        SINGLE,
        ("a", None, "202401", 1.0),
        ("b", "202413", "202401", 1.0),
        ("c", "002401", "202401", 1.0),
        ("c", "202401", "202401", 1.0),
    )
    assert rows(cohorts_single(snapshot)) == [
        ("002401", "2024", 1, 1),
        ("202401", "2024", 1, 0),
        ("202413", "2024", 1, 1),
        (None, "2024", 1, 0),
    ]
