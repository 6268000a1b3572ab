from __future__ import annotations

import itertools

import pytest

from cedeflow import fixed_values as fixed
from cedeflow.operators.absence import not_in, not_in_as_of
from cedeflow.operators.new_policies import count_new_policies
from helpers import plan_of, rows

ROWS = [("a", "202401"), ("b", "202401"), ("a", "202402"), (None, "202401"), (None, "202403")]
LISTS = {
    "some": [("a", "202401")],
    "empty": [],
    "null": [("b", "202402"), (None, "202402")],
    "only null": [(None, "202401")],
}


@pytest.mark.parametrize("name", LISTS)
def test_not_in_equals_sql(spark, frame, name):
    r = frame("p string, m string", *ROWS)
    listed = frame("p string, m string", *LISTS[name])
    r.createOrReplaceTempView("r")
    listed.createOrReplaceTempView("l")
    whole = spark.sql("SELECT * FROM r WHERE p NOT IN (SELECT p FROM l)")
    assert rows(not_in(r, listed, "p"), "p", "m") == rows(whole)
    by_month = spark.sql("SELECT * FROM r WHERE p NOT IN (SELECT p FROM l WHERE l.m = r.m)")
    assert rows(not_in(r, listed, "p", "m"), "p", "m") == rows(by_month)
    as_of = spark.sql("SELECT * FROM r WHERE p NOT IN (SELECT p FROM l WHERE l.m <= r.m)")
    assert rows(not_in_as_of(r, listed, "p", "m", listed_month="m"), "p", "m") == rows(as_of)


def test_not_in_does_not_broadcast_the_list(spark, frame):
    r = frame("p string, m string", *ROWS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            plan_of(not_in(r, r, "p")),
            plan_of(not_in(r, r, "p", "m")),
            plan_of(not_in_as_of(r, r, "p", "m", listed_month="m")),
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan in plans:
        assert "SortMergeJoin" in plan
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("null_at", [None, "202312", "202401", "202402"])
def test_new_policies_equal_sql(spark, frame, null_at):
    data = [
        ("a", "202312", "x"),
        ("a", "202401", "x"),
        ("b", "202401", "x"),
        ("b", "202402", "y"),
        ("c", "202402", "y"),
        ("c", "202402", "y"),
        ("d", "202404", "x"),
        (None, "202404", "z"),
    ]
    if null_at:
        data.append((None, null_at, "x"))
    snapshot = frame("policy_number string, set_month string, g string", *data)
    snapshot.createOrReplaceTempView("s")
    expected = spark.sql(
        """SELECT s.set_month, s.g, count(*) n FROM s
           WHERE s.policy_number NOT IN
                 (SELECT p.policy_number FROM s p
                  WHERE date_format(add_months(to_date(p.set_month, 'yyyyMM'), 1), 'yyyyMM')
                        = s.set_month)
           GROUP BY s.set_month, s.g"""
    )
    got = count_new_policies(snapshot, None, ["g"])
    assert rows(got, "set_month", "g", "n") == rows(expected)
    for months in (["202402"], ["202401", "202404"]):
        one = count_new_policies(snapshot, months, ["g"])
        assert rows(one, "set_month", "g", "n") == [r for r in rows(expected) if r[0] in months]


def test_one_policy_with_most_rows(frame):
    hot = [("hot", m, "x") for m in ("202401", "202402", "202403") for _ in range(500)]
    cold = [(f"p{i}", m, "x") for i, m in itertools.product(range(20), ("202402", "202403"))]
    snapshot = frame("policy_number string, set_month string, g string", *hot, *cold)
    assert rows(count_new_policies(snapshot, None, ["g"]), "set_month", "n") == [
        ("202401", 500),
        ("202402", 20),
    ]


@pytest.mark.parametrize("month", ["009912", "202401", "1234567", None])
def test_not_in_by_any_month(frame, spark, month):
    data = frame("k string, m string", ("a", month), ("b", month), (None, month), ("c", "202402"))
    listed = frame("k string, m string", ("a", month), (None, month), ("d", "202402"))
    data.createOrReplaceTempView("r")
    listed.createOrReplaceTempView("l")
    expected = spark.sql("SELECT * FROM r WHERE r.k NOT IN (SELECT l.k FROM l WHERE l.m = r.m)")
    assert rows(not_in(data, listed, "k", "m")) == rows(expected)


def test_group_outside_the_terms_is_left_out(frame):
    from cedeflow.operators.group_reconciliation import TERMS_95, withdrawal_cells

    kind = fixed.WITHDRAWAL_TYPES[0]
    moved = frame(
        "set_month string, plangroup string, withdrawal_type string, withdrawal_amount double",
        ("202401", TERMS_95.plan_groups[0], kind, 10.0),
        ("202401", "NOT A GROUP", kind, 10.0),
    )
    assert {r.plangroup for r in withdrawal_cells(moved, TERMS_95).collect()} == {
        TERMS_95.plan_groups[0]
    }


def test_new_policies_move_once_by_policy(spark, frame):
    snapshot = frame("policy_number string, set_month string, g string", ("a", "202401", "x"))
    plan = plan_of(count_new_policies(snapshot, None, ["g"]))
    by_policy = [line for line in plan.splitlines() if "Exchange hashpartitioning(policy_number" in line]
    assert len(by_policy) == 1
    assert plan.count("Join") == 0
    # the policy, the cells, the months
    assert plan.count("Exchange") == 3
