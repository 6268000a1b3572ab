from __future__ import annotations

from datetime import date

import pytest

from cedeflow.operators.movements import tag_movements
from cedeflow.operators.rollforward import (
    COLUMNS,
    rollforward,
    rollforward_existing,
    rollforward_new,
    total_difference,
    with_checks,
)
from helpers import PREMIUM, POLICY, SNAPSHOT, WITHDRAWAL, plan_of, rows

KINDS = (
    "full_surrenders",
    "cancellations",
    "surrender_fees",
    "aiw",
    "rmd",
    "penalty_free",
    "partial_surrenders",
    "death_claims",
)


@pytest.fixture
def block(frame):
    """A block over the turn of the year, with one case of each kind."""
    snapshot = [
        # stays, flag changes from P to AF
        ("stay", "202312", "pl", "P", "v0", 100.0, 10.0, 1000.0, 900.0),
        ("stay", "202401", "pl", "AF", "v1", 120.0, 13.0, 1100.0, 950.0),
        # leaves
        ("gone", "202312", "pl", None, "v0", 50.0, 5.0, 500.0, 450.0),
        # new and issued in the month
        ("new", "202401", "pl", "P", "v2", 200.0, 1.0, 201.0, 190.0),
        # appears but was issued before the month
        ("late", "202401", "pl", "P", "v3", 300.0, 1.0, 301.0, 290.0),
        # present last month though issued in the month
        ("both", "202312", "pl", "P", "v4", 10.0, 1.0, 11.0, 9.0),
        ("both", "202401", "pl", "P", "v4", 20.0, 2.0, 22.0, 19.0),
        # not in the policy master
        ("orphan", "202312", "pl", "P", "v5", 1.0, 1.0, 1.0, 1.0),
        (None, "202312", "pl", "P", "v6", 1.0, 1.0, 1.0, 1.0),
    ]
    policies = [
        ("stay", date(2020, 1, 1), "202001"),
        ("gone", date(2020, 1, 1), "202001"),
        ("new", date(2024, 1, 1), "202401"),
        ("late", date(2023, 12, 31), "202312"),
        ("both", date(2024, 1, 15), "202401"),
        (None, date(2024, 1, 15), "202401"),
    ]
    moved = {kind: [] for kind in KINDS}
    moved["rmd"] = [("stay", "202401", 7.0, "P"), ("stay", "202401", 3.0, "P")]
    moved["surrender_fees"] = [("gone", "202401", 20.0, None)]
    moved["full_surrenders"] = [("gone", "202401", 480.0, None), ("gone", "202312", 9.0, None)]
    moved["death_claims"] = [("new", "202401", 1.0, "P")]
    tables = {kind: frame(WITHDRAWAL, *data) for kind, data in moved.items()}
    return frame(SNAPSHOT, *snapshot), frame(POLICY, *policies), tag_movements(tables)


def by_policy(report):
    return {(r["policy_number"], r["new_policy_check"]): r for r in report.collect()}


def test_both_parts_of_a_month(block):
    report = rollforward(*block, "202401")
    assert tuple(report.columns) == COLUMNS
    got = by_policy(report)
    assert set(got) == {("stay", "0"), ("gone", "0"), ("both", "0"), ("both", "1"), ("new", "1")}
    assert {r["set_month"] for r in got.values()} == {"202401"}


def test_shares_follow_the_flag_of_their_month(block):
    r = by_policy(rollforward(*block, "202401"))["stay", "0"]
    assert r["beginning_fund_value"] == pytest.approx(1000 * 0.65)
    assert r["premium"] == pytest.approx(120 * 0.4 - 100 * 0.65)
    assert r["interest_earned"] == pytest.approx(13 * 0.4 - 10 * 0.65)
    assert r["rmd"] == pytest.approx(10 * 0.65)
    assert r["end_fund_value"] == pytest.approx(1100 * 0.65)
    assert float(r["qs"]) == 0.65
    assert r["beginning_reserve_stat"] == pytest.approx(900 * 0.65)
    assert r["end_reserve_stat"] == pytest.approx(950 * 0.65)
    assert r["val_code"] == "v1"


def test_a_policy_that_left(block):
    r = by_policy(rollforward(*block, "202401"))["gone", "0"]
    assert (r["premium"], r["interest_earned"], r["end_fund_value"], r["end_reserve_stat"]) == (
        0,
        0,
        0,
        0,
    )
    assert r["val_code"] is None
    assert r["full_surrender"] == pytest.approx(480 * 0.4)
    assert r["surrender_fees"] == pytest.approx(20 * 0.4)


def test_a_new_policy(block):
    r = by_policy(rollforward(*block, "202401"))["new", "1"]
    assert (r["beginning_fund_value"], r["beginning_reserve_stat"]) == (0, 0)
    assert r["premium"] == pytest.approx(130.0)
    assert r["death_claims"] == pytest.approx(0.65)
    assert r["val_code"] == "v2"


def test_checks_leave_fees_out_and_take_the_size_of_the_net(block):
    got = by_policy(with_checks(rollforward(*block, "202401")))
    gone = got["gone", "0"]
    assert gone["inflow"] == 0
    assert gone["outflow"] == pytest.approx(480 * 0.4)
    assert gone["exp_av"] == pytest.approx(500 * 0.4 - 480 * 0.4)
    assert gone["diff"] == pytest.approx(-gone["exp_av"])
    stay = got["stay", "0"]
    assert stay["premium"] + stay["interest_earned"] < 0
    assert stay["inflow"] == pytest.approx(-(stay["premium"] + stay["interest_earned"]))
    total = total_difference(with_checks(rollforward(*block, "202401"))).collect()
    assert total[0]["sum_diff"] == pytest.approx(sum(abs(r["diff"]) for r in got.values()))


def test_all_months_contain_each_month(block):
    everything = rollforward(*block)
    january = everything.filter("set_month = '202401'")
    assert rows(january) == rows(rollforward(*block, "202401"))
    # an issue date after the month is also on or after its first day
    december = everything.filter("set_month = '202312'")
    assert rows(december) == rows(rollforward(*block, "202312"))
    assert rows(december, "policy_number", "new_policy_check") == [("both", "1")]
    several = rollforward(*block, ["202401", "202312"])
    assert rows(several) == rows(everything)
    # the month after the last snapshot, when asked for: everything has left
    after = rollforward(*block, "202402").collect()
    assert {r["policy_number"] for r in after} == {"stay", "new", "late", "both"}
    assert {r["end_fund_value"] for r in after} == {0}


def test_parts_alone(block):
    assert {r[0] for r in rows(rollforward_existing(*block), "policy_number")} == {
        "stay",
        "gone",
        "both",
    }
    assert {r[0] for r in rows(rollforward_new(*block), "policy_number")} == {"both", "new"}


def test_two_ending_rows_are_an_error_but_two_beginning_rows_are_not(block, frame):
    snapshot, policies, movements = block
    again = frame(SNAPSHOT, ("gone", "202312", "pl", "P", "v0", 1.0, 1.0, 2.0, 1.0))
    doubled = snapshot.unionByName(again)
    report = rollforward(doubled, policies, movements, "202401")
    assert len([1 for r in report.collect() if r["policy_number"] == "gone"]) == 2
    again = frame(SNAPSHOT, ("stay", "202401", "pl", "P", "v0", 1.0, 1.0, 2.0, 1.0))
    with pytest.raises(Exception, match="more than one snapshot row"):
        rollforward(snapshot.unionByName(again), policies, movements, "202401").collect()
    # a duplicate the report does not reach does no harm
    again = frame(SNAPSHOT, ("late", "202401", "pl", "P", "v0", 1.0, 1.0, 2.0, 1.0))
    rollforward(snapshot.unionByName(again), policies, movements, "202401").collect()


def test_a_policy_listed_twice_is_reported_twice(block, frame):
    snapshot, policies, movements = block
    twice = policies.unionByName(frame(POLICY, ("stay", date(2020, 1, 1), "202001")))
    report = rollforward(snapshot, twice, movements, "202401")
    assert len([1 for r in report.collect() if r["policy_number"] == "stay"]) == 2


def test_plan_reads_the_snapshot_once_and_joins_without_another_shuffle(spark, block):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(rollforward(*block, "202401"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Python" not in plan
    # movements and the policy master
    assert plan.count("SortMergeJoin") == 2
    # the snapshot once, by policy; movements by policy and month, their sums by policy
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("Window") == 1 and plan.count("Generate") == 1


def test_premium_table_has_its_own_amount_column(frame):
    premium = frame(PREMIUM, ("a", "202401", 5.0, 0.5, "P"))
    other = frame(WITHDRAWAL, ("a", "202401", 3.0, "P"))
    tagged = tag_movements({"premium": premium, "rmd": other})
    assert rows(tagged, "kind", "amount") == [("premium", 5.0), ("rmd", 3.0)]
