from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from cedeflow.operators.cohorts import cohorts_single
from cedeflow.operators.first_months import KIND, FirstMonths
from cedeflow.sources.policy_store import PolicyStore
from helpers import plan_of, rows

SCHEMA = (
    "policy_number string, set_month string, reported_date string, plangroup string,"
    " gross_account_value double"
)
MONTHS = ("202311", "202312", "202401", "202402")


@pytest.fixture
def state(spark):
    store = PolicyStore(spark, f"cohorts_{uuid.uuid4().hex}", 8)
    yield FirstMonths(store, ["plangroup"])
    store.drop(KIND)


def _snapshot(frame, seed=1, months=MONTHS):
    rnd = random.Random(seed)
    table = [
        (
            rnd.choice([f"p{n}", f"p{n}", f"p{n}", None]),
            month,
            rnd.choice(("202311", "202201", None)),
            rnd.choice(("A", "B", None)),
            rnd.choice((5.0, 0.0, None, 7.0)),
        )
        for n in range(25)
        for month in months
        if rnd.random() < 0.7
    ]
    return frame(SCHEMA, *table, *table[:5])


def _full(snapshot, month):
    return rows(cohorts_single(snapshot, by=["plangroup"]).filter(F.col("set_month") == month))


def test_merged_months_equal_the_full_run_and_a_rerun_changes_nothing(frame, state):
    snapshot = _snapshot(frame)
    for month in MONTHS:
        state.merge(snapshot, month)
        assert rows(state.cohorts(snapshot, month)) == _full(snapshot, month)
    kept = rows(state.as_of("202402"))
    state.merge(snapshot, "202402")
    assert rows(state.as_of("202402")) == kept
    # only the last states are kept
    assert state.store.months(KIND) == ["202401", "202402"]


def test_a_corrected_month_takes_the_place_of_the_first_run(frame, state):
    first, corrected = _snapshot(frame, 1), _snapshot(frame, 2, MONTHS[2:3])
    for month in MONTHS[:3]:
        state.merge(first, month)
    state.merge(corrected, "202401")
    whole = first.filter("set_month < '202401'").unionByName(corrected)
    assert rows(state.cohorts(corrected, "202401")) == _full(whole, "202401")


def test_a_month_whose_state_before_is_gone_is_refused(frame, state):
    snapshot = _snapshot(frame)
    for month in MONTHS:
        state.merge(snapshot, month)
    for month in ("202312", "202401"):
        with pytest.raises(ValueError, match="no longer kept"):
            state.merge(snapshot, month)
    with pytest.raises(ValueError, match="not a YYYYMM month"):
        state.merge(snapshot, "2024")


def test_an_empty_month(frame, state):
    snapshot = _snapshot(frame)
    state.merge(snapshot, "202311")
    state.merge(snapshot.limit(0), "202312")
    assert rows(state.cohorts(snapshot.limit(0), "202312")) == []
    state.merge(snapshot, "202402")
    whole = snapshot.filter("set_month in ('202311', '202402')")
    assert rows(state.cohorts(snapshot, "202402")) == _full(whole, "202402")


def test_a_run_reads_one_month_of_state(frame, state):
    snapshot = _snapshot(frame)
    for month in MONTHS[:2]:
        state.merge(snapshot, month)
    plan = plan_of(state.cohorts(snapshot, "202312"))
    assert "PartitionFilters: [isnotnull(set_month" in plan and "= 202312)]" in plan
