"""Reports by block of business.

A block is named by how its data is laid out:

=============  ===============================================================
``strategy``   snapshot and policy master per month and credit strategy
``treaty``     snapshot with reinsurance flag, timeless policy master
``group_95``   snapshot with plan group, 95 % quota share
``group_50``   snapshot with plan group, 50 % quota share
``life``       life snapshot with annuities, premiums and claims
``migration``  a block that moved from an old to a new system
``index``      one index-annuity snapshot
=============  ===============================================================
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cedeflow import fixed_values as fixed
from cedeflow.operators.account_value import net_av_flag, net_av_flat
from cedeflow.operators.cohorts import (
    cohorts_migration,
    cohorts_monthly_policy,
    cohorts_policy,
    cohorts_single,
)
from cedeflow.operators.group_reconciliation import TERMS_50, TERMS_95, group_reconciliation
from cedeflow.operators.rollforward import rollforward, with_checks
from cedeflow.operators.tranches import life_report
from cedeflow.operators.treaty_reconciliation import treaty_reconciliation
from cedeflow.sinks.published import publish
from cedeflow.sinks.reports import write_flat, write_monthly, write_sheets
from cedeflow.sources.tables import Tables


@dataclass(frozen=True)
class CohortReport:
    """A cohort report and, for some blocks, the account values beside it."""

    name: str
    cohorts: Callable[[Tables], DataFrame]
    account_value: Callable[[Tables], DataFrame] | None = None
    sort: Sequence[str] = ("set_month", "report_year")


def _by_prefix(prefix: str) -> Callable[[Tables], DataFrame]:
    return lambda t: cohorts_monthly_policy(t["snapshot"], t["policies"], prefix)


def _by_plan_group(t: Tables) -> DataFrame:
    return cohorts_single(t["snapshot"], value="eom_fund_value", by=["plangroup"])


GROUP_SORT = ("set_month", "plangroup", "report_year")
COHORT_REPORTS: dict[str, tuple[CohortReport, ...]] = {
    "strategy": tuple(
        CohortReport(f"strategy_{prefix.rstrip('%')}", _by_prefix(prefix))
        for prefix in fixed.POLICY_PREFIXES
    ),
    "treaty": (
        CohortReport(
            "treaty",
            lambda t: cohorts_policy(t["snapshot"], t["policies"]),
            lambda t: net_av_flag(t["snapshot"], t["terms"]),
        ),
    ),
    "group_95": (
        CohortReport("group_95", _by_plan_group, lambda t: net_av_flat(t["snapshot"]), GROUP_SORT),
    ),
    "group_50": (
        CohortReport("group_50", _by_plan_group, lambda t: net_av_flat(t["snapshot"]), GROUP_SORT),
    ),
    "migration": (
        CohortReport(
            "migration",
            lambda t: cohorts_migration(t["new_system"], t["old_system"], t["surrenders"]),
        ),
    ),
    "index": (CohortReport("index", lambda t: cohorts_single(t["snapshot"], policy="policy_id")),),
}
BLOCKS = (*COHORT_REPORTS, "life")

_GROUP_COLUMNS = {
    "snapshot": ("policy_number", "set_month", "plangroup", "term", "reported_date", "eom_fund_value")
}
#: The columns that a block's reports read, by table.
NEEDED: dict[str, dict[str, Sequence[str]]] = {
    "strategy": {
        "snapshot": ("policynumber", "set_month", "creditstrategy", "totalpolicyav"),
        "policies": ("policynumber", "set_month", "creditstrategy", "reported_date"),
    },
    "treaty": {
        "snapshot": ("policy_number", "set_month", "plan", "reins_flag", "fund_value"),
        "policies": ("policy_number", "reported_date"),
        "terms": ("plan", "term"),
    },
    "group_95": _GROUP_COLUMNS,
    "group_50": _GROUP_COLUMNS,
    "migration": {
        "new_system": ("mpolicy", "set_month", "reported_date", "current_status"),
        "old_system": ("policy_number", "set_month", "reported_date", "gross_account_value"),
        "surrenders": ("policy_number", "set_month"),
    },
    "index": {"snapshot": ("policy_id", "set_month", "reported_date", "gross_account_value")},
    "life": {
        "snapshot": ("pmdno", "set_month", "pbfamt", "pmdissuedt", "pbfrsvcd1"),
        "annuities": ("policyno", "set_month", "total2"),
        "codes": ("valcode_new", "exhibit"),
        "premiums": ("policyno", "set_month", "gross_premium"),
        "claims": ("policyno", "set_month", "net_payable", "issue_date"),
    },
}
_MOVEMENT_COLUMNS = ("policy_number", "set_month", "withdrawal_amount", "reins_code")
#: The same for reconciliations and the roll-forward.
RECONCILIATION_NEEDED: dict[str, dict[str, Sequence[str]]] = {
    "group": {
        "snapshot": (
            "policy_number",
            "set_month",
            "plangroup",
            "eom_fund_value",
            "stat_reserve",
            "interest_credited",
            "bonus_credited",
            "expense_charges",
        ),
        "premium": ("set_month", "plangroup", "total_premium", "renewal_premium", "initial_commission"),
        "withdrawals": ("set_month", "plangroup", "withdrawal_type", "withdrawal_amount"),
    },
    "treaty": {
        "snapshot": ("policy_number", "set_month", "reins_flag"),
        "policies": ("policy_number",),
        "commissions": ("set_month", "reins_flag", "paid"),
        **{kind: _MOVEMENT_COLUMNS for kind in fixed.TREATY_MOVEMENTS if kind != "premium"},
        "premium": ("policy_number", "set_month", "premium_amount", "quota_share", "reins_code"),
    },
    "rollforward": {
        "snapshot": (
            "policy_number",
            "set_month",
            "reins_flag",
            "val_code",
            "purchase_price",
            "interest_earned",
            "fund_value",
            "stat_reserve",
        ),
        "policies": ("policy_number", "date_issued"),
        **{kind: _MOVEMENT_COLUMNS for kind in fixed.ROLLFORWARD_MOVEMENTS},
    },
}


def life_block_report(tables: Tables) -> DataFrame:
    tables.check(NEEDED["life"])
    return life_report(
        tables["snapshot"],
        tables["annuities"],
        tables["codes"],
        tables["premiums"],
        tables["claims"],
    )


def block_reports(block: str, tables: Tables) -> dict[str, DataFrame]:
    """All reports of a block by name, as lazy DataFrames; AV sheets end in ``_av``."""
    if block == "life":
        return {"life": life_block_report(tables)}
    reports = {}
    for report in _reports_of(block, tables):
        reports[report.name] = report.cohorts(tables)
        if report.account_value is not None:
            reports[f"{report.name}_av"] = report.account_value(tables)
    return reports


def export_block(
    block: str, tables: Tables, path: str, file_format: str = "parquet"
) -> dict[str, DataFrame]:
    """Writes a block's reports under ``path``, replacing earlier ones.

    Returns the sheets by their place there.
    """
    if block == "life":
        report = life_block_report(tables)
        write_flat(report, f"{path}/life", ["set_month", "tranche_mapping"], file_format)
        return {"life": report}
    written = {}
    for report in _reports_of(block, tables):
        value = report.account_value(tables) if report.account_value else None
        sheets = write_sheets(
            f"{path}/{report.name}", report.cohorts(tables), value, report.sort, file_format
        )
        written |= {f"{report.name}/{name}": sheet for name, sheet in sheets.items()}
    return written


def publish_block(block: str, tables: Tables, path: str, file_format: str = "parquet") -> str:
    """Writes a block's reports beside earlier ones, which readers get until all are there.

    ``sinks.published.published`` reads a sheet, such as ``treaty/NB``.
    """
    return publish(
        tables.spark, path, lambda folder: export_block(block, tables, folder, file_format), file_format
    )


def _reports_of(block: str, tables: Tables) -> tuple[CohortReport, ...]:
    if block not in COHORT_REPORTS:
        raise ValueError(f"unknown block {block!r}; known blocks: {', '.join(BLOCKS)}")
    tables.check(NEEDED[block])
    return COHORT_REPORTS[block]


GROUP_TERMS = {"group_95": TERMS_95, "group_50": TERMS_50}


def reconciliation(
    block: str, tables: Tables, months: str | Sequence[str] | None = None
) -> DataFrame:
    """The cash-flow reconciliation of a block for a month, several or all."""
    if block in GROUP_TERMS:
        tables.check(RECONCILIATION_NEEDED["group"])
        return group_reconciliation(
            tables["snapshot"], tables["premium"], tables["withdrawals"], GROUP_TERMS[block], months
        )
    if block == "treaty":
        tables.check(RECONCILIATION_NEEDED["treaty"])
        return treaty_reconciliation(
            tables["snapshot"],
            tables["policies"],
            tables.movements(fixed.TREATY_MOVEMENTS),
            tables["premium"],
            tables["commissions"],
            months,
        )
    known = ", ".join([*GROUP_TERMS, "treaty"])
    raise ValueError(f"no reconciliation for block {block!r}; blocks with one: {known}")


def account_value_rollforward(
    tables: Tables, months: str | Sequence[str] | None = None
) -> DataFrame:
    """The treaty block's roll-forward with its check columns."""
    tables.check(RECONCILIATION_NEEDED["rollforward"])
    movements = tables.movements(fixed.ROLLFORWARD_MOVEMENTS)
    return with_checks(rollforward(tables["snapshot"], tables["policies"], movements, months))


def export_reconciliation(
    block: str, tables: Tables, path: str, months: str | Sequence[str] | None = None
) -> None:
    write_monthly(reconciliation(block, tables, months), path, ["line_no"])


def export_rollforward(
    tables: Tables, path: str, months: str | Sequence[str] | None = None
) -> None:
    write_monthly(account_value_rollforward(tables, months), path, ["policy_number"])
