"""Fixed values the reports depend on: rates, codes, report lines, date ranges.

Factors are ``Decimal`` so that they multiply decimal money exactly; against
double money Spark folds them to doubles.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

# --- quota shares -----------------------------------------------------------
FLAG_SHARES = {"P": Decimal("0.65")}
OTHER_FLAG_SHARE = Decimal("0.4")
ACCOUNT_VALUE_SHARE = Decimal("0.95")
LIFE_SHARE = Decimal("0.95")

# --- treaty expenses --------------------------------------------------------
ISSUE_COST = 60
SURRENDER_COST = 20
DEATH_CLAIM_COST = 50
ISSUE_LOAD_FLAGS = ("AF", "P", "V")
ISSUE_LOAD = Decimal("1.2")
OTHER_ISSUE_LOAD = Decimal("1")
CLAIM_LOAD_CODES = ("3C", "3D")
CLAIM_LOAD = Decimal("1.04")
OTHER_CLAIM_LOAD = Decimal("1.13")
MARKETING_RATE = Decimal("0.0019")
CEDING_RATE = Decimal("0.03")
CEDING_DIVISOR = 2

# --- movement tables --------------------------------------------------------
# Tables of the roll-forward, each with the report column it fills.
ROLLFORWARD_MOVEMENTS = {
    "full_surrenders": "full_surrender",
    "cancellations": "cancellation",
    "surrender_fees": "surrender_fees",
    "aiw": "aiw",
    "rmd": "rmd",
    "penalty_free": "penalty_free",
    "partial_surrenders": "partial_surrender",
    "death_claims": "death_claims",
}
# Report columns that reduce the account value; fees are shown but not counted.
OUTFLOW_COLUMNS = (
    "full_surrender",
    "cancellation",
    "aiw",
    "rmd",
    "penalty_free",
    "partial_surrender",
    "death_claims",
)
TREATY_MOVEMENTS = (
    "full_surrenders",
    "partial_surrenders",
    "aiw",
    "rmd",
    "cancellations",
    "surrender_fees",
    "penalty_free",
    "death_claims",
    "premium",
    "premium_taxes",
)
TREATY_EXPENSES = (
    "issue_expense",
    "marketing_expense",
    "surrender_expense",
    "death_claim_expense",
    "additional/ceding_allowance",
)

# --- plan-group reconciliation ----------------------------------------------
PREMIUM_TYPES = ("total_premium", "renewal_premium")
COMMISSION_TYPE = "initial_commission"
WITHDRAWAL_TYPES = (
    "Full Surrender Withdrawals",
    "Partial Withdrawal with SC",
    "RMD Withdrawals",
    "Free Interest Credit Withdrawals",
    "Freelook Withdrawals",
    "Cancellation Withdrawals",
    "Death Benefit",
    "Enhanced Benefit Withdrawals",
    "Free Partial Withdrawals",
)
PLAN_GROUPS_95 = ("MYGE03", "MYGE05", "MYGE07", "MYGE10")
PLAN_GROUPS_50 = (
    "MYG03",
    "MYG04",
    "MYG05",
    "MYG06",
    "MYG07",
    "MYG08",
    "MYG09",
    "MYG10",
)

# --- cohorts and account values ---------------------------------------------
CUT_OVER_MONTH = "202506"
ACCOUNT_VALUE_SINCE = "202401"
POLICY_PREFIXES = ("D%", "T%")
ACTIVE = "Active"

# --- life tranches ----------------------------------------------------------
# (tranche, first issue date, last issue date), both days included.  The first
# tranche ends a day before 2017-09-30, so that day belongs to none.
LIFE_TRANCHES = (
    (1, None, date(2017, 9, 29)),
    (2, date(2017, 10, 1), date(2018, 9, 30)),
    (3, date(2018, 10, 1), date(2020, 9, 30)),
    (4, date(2020, 10, 1), date(2022, 9, 30)),
)
LIFE_EXHIBIT = "5A"
ANNUITY_EXHIBIT = "5B"
RESERVE_CODE_LENGTH = 5
