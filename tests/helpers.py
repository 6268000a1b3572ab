from __future__ import annotations

SNAPSHOT = (
    "policy_number string, set_month string, plan string, reins_flag string, val_code string,"
    " purchase_price double, interest_earned double, fund_value double, stat_reserve double"
)
POLICY = "policy_number string, date_issued date, reported_date string"
WITHDRAWAL = "policy_number string, set_month string, withdrawal_amount double, reins_code string"
PREMIUM = (
    "policy_number string, set_month string, premium_amount double, quota_share double,"
    " reins_code string"
)


def rows(frame, *columns):
    """The rows as sorted tuples, of the given columns or of all."""
    if columns:
        frame = frame.select(*columns)
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
