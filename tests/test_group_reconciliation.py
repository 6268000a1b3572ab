from __future__ import annotations

import pytest

from cedeflow import fixed_values as fixed
from cedeflow.operators.group_reconciliation import TERMS_50, TERMS_95, group_reconciliation
from helpers import rows

SNAPSHOT = (
    "policy_number string, set_month string, plangroup string, term string, reported_date string,"
    " eom_fund_value double, stat_reserve double, interest_credited double,"
    " bonus_credited double, expense_charges double"
)
PREMIUM = (
    "set_month string, plangroup string, total_premium double, renewal_premium double,"
    " initial_commission double"
)
WITHDRAWALS = (
    "set_month string, plangroup string, withdrawal_type string, withdrawal_amount double"
)


@pytest.fixture
def inputs(frame):
    def make(first, second):
        snapshot = [
            ("a", "202312", first, "3", "202001", 1.0, 90.0, 1.0, 1.0, 2.0),
            ("a", "202401", first, "3", "202001", 1.0, 100.0, 10.0, 1.0, 2.0),
            ("b", "202401", first, "3", "202401", 1.0, 100.0, 20.0, None, 3.0),
            # moved here from another group, so not new to the block
            ("a", "202401", second, "3", "202001", 1.0, 10.0, None, 1.0, None),
            ("c", "202401", "not reported", "3", "202401", 1.0, 10.0, 1.0, 1.0, 1.0),
        ]
        premium = [
            ("202401", first, 1000.0, 100.0, 50.0),
            ("202401", first, 500.0, None, None),
            ("202312", first, 9.0, 9.0, 9.0),
        ]
        withdrawals = [
            ("202401", first, "RMD Withdrawals", 40.0),
            ("202401", first, "RMD Withdrawals", 2.0),
            ("202401", second, "Death Benefit", 7.0),
            ("202401", second, "No such type", 7.0),
        ]
        return (
            frame(SNAPSHOT, *snapshot),
            frame(PREMIUM, *premium),
            frame(WITHDRAWALS, *withdrawals),
        )

    return make


def totals(report):
    return {(r["plan_group"], r["type"]): r["total"] for r in report.collect()}


def test_95_block(inputs):
    report = group_reconciliation(*inputs("MYGE03", "MYGE05"), TERMS_95, "202401")
    assert report.columns == ["set_month", "line_no", "plan_group", "type", "total"]
    assert report.count() == 68
    got = totals(report)
    assert got["MYGE03", "total_premium"] == pytest.approx(1500 * 0.95)
    assert got["MYGE03", "renewal_premium"] == pytest.approx(95)
    assert got["MYGE03", "initial_commission"] == pytest.approx(47.5)
    assert got["MYGE03", "RMD Withdrawals"] == pytest.approx(42 * 0.95)
    assert got["MYGE05", "Death Benefit"] == pytest.approx(7 * 0.95)
    # expenses are not shared; only b is new to the block
    assert got["MYGE03", "issue"] == 180
    assert got["MYGE05", "issue"] == 0
    assert got["MYGE03", "admin"] == pytest.approx(2 * 10 * 1.02)
    assert got["MYGE07", "admin"] == 0
    assert got["MYGE03", "reserves"] == pytest.approx(190)
    # a NULL bonus takes its row out of the interest
    assert got["MYGE03", "interest"] == pytest.approx(11 * 0.95)
    assert got["MYGE05", "interest"] is None
    assert got["MYGE03", "policy_deduction"] == pytest.approx(4.75)
    # empty sums are NULL
    assert got["MYGE10", "total_premium"] is None
    assert got["MYGE10", "reserves"] is None


def test_50_block(inputs):
    report = group_reconciliation(*inputs("MYG03", "MYG05"), TERMS_50, "202401")
    lines = report.orderBy("line_no").collect()
    assert len(lines) == 144
    assert [r["type"] for r in lines[:8]] == ["issue"] * 8
    assert [r["plan_group"] for r in lines[:8]] == list(fixed.PLAN_GROUPS_50)
    assert len([r for r in lines if r["type"] == "issue"]) == 16
    got = totals(report)
    # both expenses count premium rows and are shared
    assert got["MYG03", "issue"] == pytest.approx(2 * 37.5 * 0.5)
    assert got["MYG03", "admin"] == pytest.approx(2 * 20 / 12 * 0.5)
    assert got["MYG05", "issue"] == 0
    assert got["MYG03", "reserves"] == pytest.approx(100)


def test_order_of_the_95_block(inputs):
    report = group_reconciliation(*inputs("MYGE03", "MYGE05"), TERMS_95, "202401")
    lines = [(r["plan_group"], r["type"]) for r in report.orderBy("line_no").collect()]
    assert lines[:3] == [
        ("MYGE03", "total_premium"),
        ("MYGE03", "renewal_premium"),
        ("MYGE05", "total_premium"),
    ]
    assert lines[8:17] == [("MYGE03", t) for t in fixed.WITHDRAWAL_TYPES]
    assert lines[44:48] == [(g, "initial_commission") for g in fixed.PLAN_GROUPS_95]
    assert lines[-4:] == [(g, "policy_deduction") for g in fixed.PLAN_GROUPS_95]


@pytest.mark.parametrize("terms", [TERMS_95, TERMS_50])
def test_all_months_contain_each_month(inputs, terms):
    data = inputs(*terms.plan_groups[:2])
    everything = group_reconciliation(*data, terms)
    for month in ("202312", "202401"):
        one = rows(group_reconciliation(*data, terms, month))
        assert one == rows(everything.filter(f"set_month = '{month}'"))
    both = group_reconciliation(*data, terms, ["202312", "202401"])
    assert rows(both) == rows(everything)


def test_a_month_without_data_has_all_lines(inputs):
    report = group_reconciliation(*inputs("MYGE03", "MYGE05"), TERMS_95, "203001")
    assert report.count() == 68
    assert set(totals(report).values()) == {None, 0.0}


def test_null_policy_last_month_leaves_nothing_new(inputs, frame):
    snapshot, premium, withdrawals = inputs("MYGE03", "MYGE05")
    nobody = frame(SNAPSHOT, (None, "202312", "x", "3", "2020", 1.0, 1.0, 1.0, 1.0, 1.0))
    report = group_reconciliation(
        snapshot.unionByName(nobody), premium, withdrawals, TERMS_95, "202401"
    )
    assert totals(report)["MYGE03", "issue"] == 0


def test_bad_month_is_refused(inputs):
    with pytest.raises(ValueError):
        group_reconciliation(*inputs("MYGE03", "MYGE05"), TERMS_95, "2024")
