from __future__ import annotations

from datetime import date

import pytest

from cedeflow import fixed_values as fixed
from cedeflow.operators.movements import tag_movements
from cedeflow.operators.treaty_reconciliation import treaty_reconciliation
from helpers import POLICY, PREMIUM, SNAPSHOT, WITHDRAWAL, rows


@pytest.fixture
def inputs(frame):
    def held(policy, month, flag):
        return (policy, month, "pl", flag, "v", 1.0, 1.0, 1.0, 1.0)

    snapshot = [
        held("old", "202312", "P"),
        held("old", "202401", "P"),
        held("n1", "202401", "P"),
        held("n2", "202401", "AF"),
        held("n3", "202401", "Z"),
        held("n4", "202401", None),
    ]
    day = date(2020, 1, 1)
    policies = [(p, day, "202001") for p in ("old", "n1", "twice", "twice")]
    premium = [
        ("old", "202401", -1000.0, 0.5, "P"),
        ("unknown", "202401", -100.0, 0.5, "P"),
    ]
    surrenders = [
        ("old", "202401", 10.0, "P"),
        ("old", "202401", 5.0, "P"),
        ("n1", "202401", 1.0, "3C"),
        ("twice", "202401", 100.0, None),
        ("unknown", "202401", 1.0, "P"),
    ]
    tables = {kind: frame(WITHDRAWAL) for kind in fixed.TREATY_MOVEMENTS}
    tables["premium"] = frame(PREMIUM, *premium)
    tables["full_surrenders"] = frame(WITHDRAWAL, *surrenders)
    commissions = frame(
        "set_month string, reins_flag string, paid double",
        ("202401", "P", 100.0),
        ("202401", "AF", 10.0),
        ("202401", None, 10.0),
    )
    return (
        frame(SNAPSHOT, *snapshot),
        frame(POLICY, *policies),
        tag_movements(tables),
        tables["premium"],
        commissions,
    )


def test_lines_of_a_month(inputs):
    report = treaty_reconciliation(*inputs, "202401")
    assert report.columns == ["set_month", "line_no", "fieldname", "withdrawal_amount"]
    lines = report.orderBy("line_no").collect()
    assert [r["fieldname"] for r in lines] == [
        *fixed.TREATY_EXPENSES,
        *fixed.TREATY_MOVEMENTS,
        "commission",
    ]
    got = {r["fieldname"]: r["withdrawal_amount"] for r in lines}
    # P and AF are loaded by 1.2; an unknown and a NULL flag take 0.4 and no load
    assert got["issue_expense"] == pytest.approx(60 * (0.65 * 1.2 + 0.4 * 1.2 + 0.4 + 0.4))
    # orphans count for the rates on premium, and the sign is dropped
    assert got["marketing_expense"] == pytest.approx(1100 * 0.5 * 0.0019)
    assert got["additional/ceding_allowance"] == pytest.approx(1100 * 0.5 * 0.03 / 2)
    # distinct policies by code: old and unknown under P, n1 under 3C, twice under NULL
    assert got["surrender_expense"] == pytest.approx(
        20 * (2 * 0.65 * 1.13 + 0.4 * 1.04 + 0.4 * 1.13)
    )
    assert got["death_claim_expense"] is None
    # movements of unknown policies drop out, those of a doubled policy count twice
    assert got["full_surrenders"] == pytest.approx(15 * 0.65 + 1 * 0.4 + 2 * 100 * 0.4)
    assert got["premium"] == pytest.approx(-1000 * 0.65)
    assert got["rmd"] is None
    assert got["commission"] == pytest.approx(100 * 0.65 + 20 * 0.4)


def test_all_months_contain_each_month(inputs):
    everything = treaty_reconciliation(*inputs)
    for month in ("202312", "202401"):
        one = rows(treaty_reconciliation(*inputs, month))
        assert len(one) == 16
        assert one == rows(everything.filter(f"set_month = '{month}'"))


def test_nothing_carries_over_between_calls(inputs):
    first = rows(treaty_reconciliation(*inputs, "202401"))
    treaty_reconciliation(*inputs, "202312").collect()
    assert rows(treaty_reconciliation(*inputs, "202401")) == first


def test_no_new_policies_is_null_not_zero(inputs, frame):
    snapshot, *rest = inputs
    nobody = frame(SNAPSHOT, (None, "202312", "pl", "P", "v", 1.0, 1.0, 1.0, 1.0))
    report = treaty_reconciliation(snapshot.unionByName(nobody), *rest, "202401")
    got = {r["fieldname"]: r["withdrawal_amount"] for r in report.collect()}
    assert got["issue_expense"] is None
