"""Independent SQL for the sample queries.

The SQL states each report in its plainest form - correlated sub-queries,
``NOT IN``, one SELECT per report line - rather than the way the operators
compute it.
"""

from __future__ import annotations

from cedeflow import fixed_values as fixed
from cedeflow.samples.views_sql import with_views

SHARE_95 = "0.95::DECIMAL(3,2)"
SHARE_50 = "0.50::DECIMAL(3,2)"
FLAG_SHARE = "CASE WHEN {0} = 'P' THEN 0.65::DECIMAL(3,2) ELSE 0.40::DECIMAL(3,2) END"
CODE_SHARE = FLAG_SHARE.format("code")
ISSUE_LOAD = "CASE WHEN {0} IN ('AF', 'P', 'V') THEN 1.2::DECIMAL(3,2) ELSE 1::DECIMAL(3,2) END"
CLAIM_LOAD = "CASE WHEN {0} IN ('3C', '3D') THEN 1.04::DECIMAL(3,2) ELSE 1.13::DECIMAL(3,2) END"
GROUPS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "ABSENT")
TRIANGLE_MONTHS = [f"{year}{month:02d}" for year in range(1995, 2002) for month in range(1, 13)]
BY_MONTH = "SELECT DISTINCT ym FROM px_line"


def _moved(kind: str, outer: str, month: str, share: str) -> str:
    return (
        f"COALESCE((SELECT SUM(m.amount) FROM px_movement m WHERE m.kind = '{kind}'"
        f" AND m.policy = {outer}.policy AND m.ym = {outer}.{month}) * {outer}.{share}, 0)::DOUBLE"
    )


def _at_end(value: str) -> str:
    return f"(SELECT {value} FROM px_snapshot e WHERE e.policy = b.policy AND e.ym = b.ym_next)"


def _movement_columns(outer: str, month: str) -> str:
    return ",\n".join(
        f"{_moved(kind, outer, month, 'share')} AS {column}"
        for kind, column in fixed.ROLLFORWARD_MOVEMENTS.items()
    )


EXISTING = f"""
SELECT b.ym_next AS set_month, b.policy AS policy_number, px_policy.issued AS date_issued,
       (b.fund * b.share)::DOUBLE AS beginning_fund_value,
       COALESCE({_at_end('e.purchase * e.share')} - b.purchase * b.share, 0)::DOUBLE AS premium,
       COALESCE({_at_end('e.interest * e.share')} - b.interest * b.share, 0)::DOUBLE
           AS interest_earned,
       {_movement_columns('b', 'ym_next')},
       COALESCE({_at_end('e.fund')} * b.share, 0)::DOUBLE AS end_fund_value,
       b.share::DOUBLE AS qs,
       (b.reserve * b.share)::DOUBLE AS beginning_reserve_stat,
       COALESCE({_at_end('e.reserve')} * b.share, 0)::DOUBLE AS end_reserve_stat,
       '0' AS new_policy_check,
       {_at_end('e.brand')} AS val_code
FROM px_snapshot b JOIN px_policy ON px_policy.policy = b.policy
WHERE b.ym_next <= (SELECT MAX(ym) FROM px_snapshot)"""

NEW = f"""
SELECT c.ym AS set_month, c.policy AS policy_number, px_policy.issued AS date_issued,
       0::DOUBLE AS beginning_fund_value,
       (c.purchase * c.share)::DOUBLE AS premium,
       (c.interest * c.share)::DOUBLE AS interest_earned,
       {_movement_columns('c', 'ym')},
       (c.fund * c.share)::DOUBLE AS end_fund_value,
       c.share::DOUBLE AS qs,
       0::DOUBLE AS beginning_reserve_stat,
       (c.reserve * c.share)::DOUBLE AS end_reserve_stat,
       '1' AS new_policy_check,
       c.brand AS val_code
FROM px_snapshot c JOIN px_policy ON px_policy.policy = c.policy
WHERE px_policy.issued >= strptime(c.ym || '01', '%Y%m%d')::DATE"""

MONEY_COLUMNS = (
    "beginning_fund_value",
    "premium",
    "interest_earned",
    *fixed.ROLLFORWARD_MOVEMENTS.values(),
    "end_fund_value",
)


def _exact(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18,6))"


OUTFLOW = " + ".join(
    _exact(c)
    for c in (
        "full_surrender",
        "cancellation",
        "aiw",
        "rmd",
        "penalty_free",
        "partial_surrender",
        "death_claims",
    )
)
CHECKED = f"""
SELECT *, inflow_exact::DOUBLE AS inflow, outflow_exact::DOUBLE AS outflow,
       ({_exact('beginning_fund_value')} + inflow_exact - outflow_exact)::DOUBLE AS exp_av,
       ({_exact('end_fund_value')} - {_exact('beginning_fund_value')} - inflow_exact
           + outflow_exact)::DOUBLE AS diff
FROM (SELECT *, abs({_exact('premium')} + {_exact('interest_earned')}) AS inflow_exact,
             abs({OUTFLOW}) AS outflow_exact
      FROM ({EXISTING} UNION ALL {NEW}))"""
CHECKED_REPORT = f"SELECT * EXCLUDE (inflow_exact, outflow_exact) FROM ({CHECKED})"
DIFFERENCE = f"""
SELECT set_month, SUM(abs(CAST(diff AS DECIMAL(18,6))))::DOUBLE AS sum_diff
FROM ({CHECKED}) GROUP BY set_month"""


# --- plan-group reconciliation ----------------------------------------------
def _cells(total: str, source: str, kind: str, share: str) -> str:
    """One line per month and plan group, NULL where the source has no row."""
    return f"""
    SELECT months.ym AS set_month, g.plan_group, {kind} AS type,
           (SELECT SUM({total}) * {share} FROM {source}
            AND s.ym = months.ym AND s.plangroup = g.plan_group)::DOUBLE AS total
    FROM ({BY_MONTH}) months, groups g"""


NEW_ROWS = """
    SELECT s.ym, s.plangroup, s.flag FROM px_snapshot s
    WHERE s.policy NOT IN (SELECT l.policy FROM px_snapshot l WHERE l.ym = s.ym_before)"""
YEAR = "CAST(left(months.ym, 4) AS INTEGER)"


def _counted(cost: str, source: str, kind: str) -> str:
    return f"""
    SELECT months.ym AS set_month, g.plan_group, '{kind}' AS type,
           round((SELECT COUNT(*) FROM ({source}) s
                  WHERE s.ym = months.ym AND s.plangroup = g.plan_group) * {cost}, 6) AS total
    FROM ({BY_MONTH}) months, groups g"""


def _group_report(share: str, issue: str, admin: str, issue_first: bool) -> str:
    sections = []
    if issue_first:
        sections.append([("issue", issue)])
    sections.append(
        [(t, _cells(t, "px_group_premium s WHERE TRUE", f"'{t}'", share)) for t in fixed.PREMIUM_TYPES]
    )
    sections.append(
        [
            (w, _cells("amount", f"px_group_withdrawal s WHERE s.kind = '{w}'", f"'{w}'", share))
            for w in fixed.WITHDRAWAL_TYPES
        ]
    )
    commission = fixed.COMMISSION_TYPE
    sections.append(
        [(commission, _cells(commission, "px_group_premium s WHERE TRUE", f"'{commission}'", share))]
    )
    sections.append([("issue", issue)])
    sections.append([("admin", admin)])
    for kind, total in (
        ("reserves", "reserve"),
        ("interest", "interest + bonus"),
        ("policy_deduction", "charges"),
    ):
        sections.append([(kind, _cells(total, "px_snapshot s WHERE TRUE", f"'{kind}'", share))])
    parts, line = [], 0
    for section in sections:
        width = len(section)
        for position, (_, sql) in enumerate(section):
            parts.append(
                f"SELECT r.set_month, CAST({line} + (g.no - 1) * {width} + {position + 1} AS INTEGER)"
                f" AS line_no, r.plan_group, r.type, r.total"
                f" FROM ({sql}) r JOIN groups g ON g.plan_group = r.plan_group"
            )
        line += width * len(GROUPS)
    return " UNION ALL ".join(parts)


def _with_groups(body: str) -> str:
    rows = ", ".join(f"({no}, '{g}')" for no, g in enumerate(GROUPS, start=1))
    text = with_views(body + " -- px_line")
    return text.replace("WITH ", f"WITH groups(no, plan_group) AS (VALUES {rows}),\n", 1)


ISSUE_95 = _counted("180.0::DOUBLE", NEW_ROWS, "issue")
ADMIN_95 = _counted(
    f"10.0::DOUBLE * pow(1.02::DOUBLE, {YEAR} - 2023)", "SELECT ym, plangroup FROM px_snapshot", "admin"
)
PREMIUM_ROWS = "SELECT ym, plangroup FROM px_group_premium"
ISSUE_50 = _counted("18.75::DOUBLE", PREMIUM_ROWS, "issue")
ADMIN_50 = _counted(
    f"(20::DOUBLE / 12) * pow(1.03::DOUBLE, {YEAR} - 2024) * 0.5::DOUBLE", PREMIUM_ROWS, "admin"
)


def _present(sql: str) -> str:
    """The same cells without those no row fell into."""
    return f"""
    SELECT set_month, plan_group AS plangroup, type, total FROM ({sql})
    WHERE total IS NOT NULL AND NOT (type IN ('issue', 'admin') AND total = 0)"""


def _held(sql: str) -> str:
    """The cells of months and plan groups with a snapshot row, whatever their total."""
    return f"""
    SELECT r.set_month, r.plan_group AS plangroup, r.type, round(r.total, 6) AS total
    FROM ({sql}) r
    WHERE EXISTS (SELECT 1 FROM px_snapshot s
                  WHERE s.ym = r.set_month AND s.plangroup = r.plan_group)"""


def _premium_cells(share: str) -> list[str]:
    return [
        _cells(t, "px_group_premium s WHERE TRUE", f"'{t}'", share)
        for t in (*fixed.PREMIUM_TYPES, fixed.COMMISSION_TYPE)
    ]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# --- treaty reconciliation --------------------------------------------------
def _per_month(name: str, total: str, source: str) -> str:
    return f"""
    SELECT months.ym AS set_month, '{name}' AS cell,
           (SELECT {total} FROM {source})::DOUBLE AS total
    FROM ({BY_MONTH}) months"""


TREATY_ISSUE = _per_month(
    "issue_expense",
    f"SUM(60 * n * ({FLAG_SHARE.format('flag')}) * ({ISSUE_LOAD.format('flag')}))",
    f"(SELECT ym, flag, COUNT(*) AS n FROM ({NEW_ROWS}) GROUP BY ym, flag) c WHERE c.ym = months.ym",
)
TREATY_MARKETING = _per_month(
    "marketing_expense",
    "abs(SUM(amount * ceded_part * 0.0019::DECIMAL(5,4)))",
    "px_premium p WHERE p.ym = months.ym",
)
TREATY_CEDING = _per_month(
    "additional/ceding_allowance",
    "abs(SUM(amount * ceded_part * 0.03::DECIMAL(3,2)))::DOUBLE / 2",
    "px_premium p WHERE p.ym = months.ym",
)


def _claim_cost(name: str, kind: str, cost: int) -> str:
    return _per_month(
        name,
        f"SUM({cost} * n * ({CODE_SHARE}) * ({CLAIM_LOAD.format('code')}))",
        f"(SELECT ym, code, COUNT(DISTINCT policy) AS n FROM px_movement WHERE kind = '{kind}'"
        " GROUP BY ym, code) c WHERE c.ym = months.ym",
    )


TREATY_SURRENDER = _claim_cost("surrender_expense", "full_surrenders", 20)
TREATY_DEATH = _claim_cost("death_claim_expense", "death_claims", 50)
TREATY_MOVEMENT = [
    _per_month(
        kind,
        f"SUM(m.amount * ({FLAG_SHARE.format('m.code')}))",
        "px_any_movement m JOIN px_policy p ON p.policy = m.policy"
        f" WHERE m.kind = '{kind}' AND m.ym = months.ym",
    )
    for kind in fixed.TREATY_MOVEMENTS
]
TREATY_COMMISSION = _per_month(
    "commission",
    f"SUM(paid * ({FLAG_SHARE.format('flag')}))",
    "px_commission c WHERE c.ym = months.ym",
)
TREATY_LINES = [
    TREATY_ISSUE,
    TREATY_MARKETING,
    TREATY_SURRENDER,
    TREATY_DEATH,
    TREATY_CEDING,
    *TREATY_MOVEMENT,
    TREATY_COMMISSION,
]
TREATY = _union(
    [
        f"SELECT set_month, CAST({no} AS INTEGER) AS line_no, cell AS fieldname,"
        f" total AS withdrawal_amount FROM ({sql})"
        for no, sql in enumerate(TREATY_LINES, start=1)
    ]
)


def _found(parts: list[str]) -> str:
    return f"SELECT * FROM ({_union(parts)}) WHERE total IS NOT NULL"


# --- cohorts ----------------------------------------------------------------
def _cohorts(live: str, seen: str, keys: str) -> str:
    """``live`` and ``seen`` select (ym, policy, keys...) of rows in force and of all rows."""
    names = [k.strip() for k in keys.split(",")]
    match = " AND ".join(f"f.{k} = v.{k}" for k in names)
    return f"""
    SELECT v.ym AS set_month, {', '.join('v.' + k for k in names)},
           COUNT(DISTINCT v.policy) AS ct_inforce,
           (SELECT COUNT(f.policy)
            FROM (SELECT policy, {keys}, MIN(ym) AS from_ym FROM ({seen}) GROUP BY policy, {keys}) f
            WHERE f.from_ym = v.ym AND {match}) AS new_issued_policies
    FROM ({live}) v GROUP BY v.ym, {', '.join('v.' + k for k in names)}"""


SINGLE = "SELECT ym, policy, plangroup, left(reported, 4) AS report_year, fund FROM px_snapshot"
MASTERED = """SELECT s.ym, s.policy, left(p.reported, 4) AS report_year, s.fund
              FROM px_snapshot s JOIN px_policy p ON p.policy = s.policy"""
COHORTS_GROUP = _cohorts(f"{SINGLE} WHERE fund > 0", SINGLE, "plangroup, report_year")
COHORTS_INDEX = _cohorts(f"{SINGLE} WHERE fund > 0", SINGLE, "report_year")
COHORTS_POLICY = _cohorts(f"{MASTERED} WHERE s.fund > 0", MASTERED, "report_year")


def _cohorts_prefix(prefix: str) -> str:
    return f"""
    SELECT '{prefix}' AS prefix, v.ym AS set_month, CAST(v.report_year AS INTEGER) AS report_year,
           COUNT(DISTINCT v.policy) AS ct_inforce,
           (SELECT COUNT(*)
            FROM (SELECT policy, MIN(ym) AS from_ym, MIN(left(reported, 4)) AS report_year
                  FROM px_strategy_policy WHERE policy LIKE '{prefix}' GROUP BY policy) f
            WHERE f.from_ym = v.ym AND f.report_year = v.report_year) AS new_issued_policies
    FROM (SELECT s.ym, s.policy, left(p.reported, 4) AS report_year
          FROM px_strategy s
          JOIN px_strategy_policy p
            ON p.policy = s.policy AND p.ym = s.ym AND p.strategy = s.strategy
          WHERE s.policy LIKE '{prefix}' AND s.av > 0) v
    GROUP BY v.ym, v.report_year"""


ACTIVE = """
    SELECT s.ym, s.policy, left(s.reported, 4) AS report_year, s.reported, s.fund
    FROM px_snapshot s
    WHERE s.current_status = 'Active'
      AND s.policy NOT IN (SELECT g.policy FROM px_surrender g WHERE g.ym <= s.ym)"""
MIGRATION = f"""
    SELECT a.ym AS set_month, a.report_year, COUNT(a.policy) AS ct_inforce,
           (SELECT COUNT(f.policy)
            FROM (SELECT policy, left(reported, 4) AS report_year, MIN(ym) AS from_ym
                  FROM px_snapshot GROUP BY ALL) f
            WHERE f.from_ym = a.ym AND f.report_year = a.report_year) AS new_issued_policies
    FROM ({ACTIVE}) a WHERE a.ym <> '199806' GROUP BY a.ym, a.report_year
    UNION ALL
    SELECT * FROM ({COHORTS_INDEX}) WHERE set_month < '199806'
    UNION ALL
    SELECT a.ym, a.report_year, COUNT(*),
           SUM(CASE WHEN a.reported = a.ym THEN 1 ELSE 0 END)::BIGINT
    FROM ({ACTIVE}) a WHERE a.ym = '199806' GROUP BY a.ym, a.report_year"""


def _triangle(value: str) -> str:
    columns = ", ".join(
        f"COALESCE(SUM(CASE WHEN set_month = '{m}' THEN {value} END), 0)::BIGINT AS \"{m}\""
        for m in TRIANGLE_MONTHS
    )
    return f"SELECT report_year, {columns} FROM ({COHORTS_GROUP}) GROUP BY report_year"


# --- account value and life -------------------------------------------------
def _dedup(prefix: str) -> str:
    return f"""
    SELECT '{prefix}' AS prefix, ym AS set_month, plan, SUM(av * ceded_part)::DOUBLE AS net_av
    FROM (SELECT DISTINCT s.policy, s.av, p.plan, s.ceded_part, s.ym
          FROM px_strategy s JOIN px_strategy_policy p ON p.policy = s.policy AND p.ym = s.ym
          WHERE s.ym >= '199701' AND s.policy LIKE '{prefix}')
    GROUP BY ym, plan"""


ISSUED = "(SELECT MIN(i.ordered) FROM px_life i WHERE i.policy = l.policy)"
LIFE_PREMIUM = f"""
    SELECT ym AS set_month,
           CASE WHEN issued < DATE '1996-12-31' THEN 1
                WHEN issued BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' THEN 2
                WHEN issued BETWEEN DATE '1998-07-01' AND DATE '1999-12-31' THEN 3
                WHEN issued BETWEEN DATE '2000-01-01' AND DATE '2001-03-31' THEN 4
           END AS tranche_mapping,
           COUNT(*) AS ct, (SUM(price) * {SHARE_95})::DOUBLE AS net_prem
    FROM (SELECT l.ym, l.price, {ISSUED} AS issued FROM px_line l)
    GROUP BY ALL"""
COVERED = """
    SELECT h.policy, h.ym, h.tranche, h.face, c.exhibit
    FROM px_life h JOIN px_code c ON c.code = lpad(h.reserve_code, 5, '0')
    WHERE c.exhibit IN ('5A', '5B')"""
LIFE_FACE = f"""
    SELECT t.ym AS set_month, t.tranche AS tranche_mapping,
           (SELECT COUNT(DISTINCT k.policy) FROM ({COVERED}) k
            WHERE k.ym = t.ym AND k.tranche = t.tranche
            HAVING COUNT(*) > 0) AS "count",
           (t.amount * {SHARE_95})::DOUBLE AS famt
    FROM (SELECT h.ym, h.tranche,
                 SUM(CASE h.exhibit WHEN '5A' THEN h.face WHEN '5B' THEN a.total2 END) AS amount
          FROM ({COVERED}) h
          LEFT JOIN px_annuity a ON a.policy = h.policy AND a.ym = h.ym
          GROUP BY h.ym, h.tranche) t"""
LIFE_CLAIMS = f"""
    SELECT ym AS set_month, tranche AS tranche_mapping, COUNT(policy) AS ct,
           (SUM(payable) * {SHARE_95})::DOUBLE AS claim_amount
    FROM px_claim GROUP BY ym, tranche"""
SAME = "x.set_month = f.set_month AND x.tranche_mapping IS NOT DISTINCT FROM f.tranche_mapping"
LIFE_MERGED = f"""
    SELECT f.*, p.ct AS prem_ct, p.net_prem, c.ct AS claim_ct, c.claim_amount
    FROM ({LIFE_FACE}) f
    LEFT JOIN ({LIFE_PREMIUM}) p ON {SAME.replace('x.', 'p.')}
    LEFT JOIN ({LIFE_CLAIMS}) c ON {SAME.replace('x.', 'c.')}"""

BODIES = {
    "rollforward_existing": EXISTING,
    "rollforward_new": NEW,
    "rollforward_checked": CHECKED_REPORT,
    "rollforward_difference": DIFFERENCE,
    "treaty_reconciliation": TREATY,
    "treaty_movement_totals": _found(TREATY_MOVEMENT),
    "treaty_commission": _found([TREATY_COMMISSION]),
    "treaty_issue_expense": _found([TREATY_ISSUE]),
    "treaty_premium_allowances": _found([TREATY_MARKETING, TREATY_CEDING]),
    "treaty_claim_expenses": _found([TREATY_SURRENDER, TREATY_DEATH]),
    "cohorts_monthly_policy": _union([_cohorts_prefix(p) for p in fixed.POLICY_PREFIXES]),
    "cohorts_policy": COHORTS_POLICY,
    "cohorts_plan_group": COHORTS_GROUP,
    "cohorts_index": COHORTS_INDEX,
    "cohorts_migration": MIGRATION,
    "active_not_surrendered": f"""
        SELECT ym AS set_month, report_year, COUNT(*) AS ct_active,
               COUNT(*) FILTER (WHERE reported = ym) AS ct_reported
        FROM ({ACTIVE}) GROUP BY ym, report_year""",
    "triangle_new": _triangle("new_issued_policies"),
    "triangle_in_force": _triangle("ct_inforce"),
    "net_av_dedup": _union([_dedup(p) for p in fixed.POLICY_PREFIXES]),
    "net_av_flat": f"""
        SELECT ym AS set_month, term, COUNT(policy) AS ct,
               SUM(fund * {SHARE_95})::DOUBLE AS net_fund_value
        FROM px_snapshot GROUP BY ym, term""",
    "net_av_flag": """
        SELECT s.ym AS set_month, t.term, COUNT(s.policy) AS ct,
               SUM(s.fund * s.share)::DOUBLE AS net_fund_value
        FROM px_snapshot s JOIN px_term t ON t.plan = s.brand
        WHERE s.ym >= '199701' GROUP BY s.ym, t.term""",
    "life_premium": LIFE_PREMIUM,
    "life_face": LIFE_FACE,
    "life_claims": LIFE_CLAIMS,
    "life_merged": LIFE_MERGED,
    "anti_join_null_aware": """
        SELECT s.policy AS policy_number, s.ym AS set_month, s.fund::DOUBLE AS fund_value
        FROM px_snapshot s
        WHERE s.current_status = 'Active'
          AND s.policy NOT IN (SELECT l.policy FROM px_snapshot l WHERE l.ym = s.ym_before)""",
    "anti_join_as_of": f"""
        SELECT policy AS policy_number, ym AS set_month, fund::DOUBLE AS fund_value
        FROM ({ACTIVE})""",
    "movement_union": """
        SELECT ym AS set_month, kind, COUNT(*) AS ct, SUM(amount)::DOUBLE AS amount
        FROM px_any_movement GROUP BY ym, kind""",
    "movements_wide": "SELECT policy AS policy_number, ym AS set_month, "
    + ", ".join(
        f"(SUM(amount) FILTER (WHERE kind = '{kind}'))::DOUBLE AS {column}"
        for kind, column in fixed.ROLLFORWARD_MOVEMENTS.items()
    )
    + " FROM px_movement WHERE kind <> 'premium_taxes' GROUP BY policy, ym",
    "month_arithmetic": """
        SELECT ym AS set_month,
               strftime(strptime(ym || '01', '%Y%m%d') - INTERVAL 1 MONTH, '%Y%m') AS previous_month,
               strftime(strptime(ym || '01', '%Y%m%d') + INTERVAL 1 MONTH, '%Y%m') AS next_month,
               strptime(ym || '01', '%Y%m%d')::DATE AS first_day, left(ym, 4) AS year,
               COUNT(*) AS ct
        FROM px_line GROUP BY ym""",
    "rate_factors": f"""
        SELECT flag AS reins_flag, ({FLAG_SHARE.format('flag')})::DOUBLE AS qs,
               ({ISSUE_LOAD.format('flag')})::DOUBLE AS issue_load,
               ({CLAIM_LOAD.format('flag')})::DOUBLE AS claim_load, COUNT(*) AS ct
        FROM px_snapshot GROUP BY flag""",
}
GROUP_BODIES = {
    "group_reconciliation_95": _group_report(SHARE_95, ISSUE_95, ADMIN_95, False),
    "group_reconciliation_50": _group_report(SHARE_50, ISSUE_50, ADMIN_50, True),
    "group_premium_cells": _present(_union(_premium_cells(SHARE_95))),
    "group_withdrawal_cells": _present(
        _union(
            [
                _cells("amount", f"px_group_withdrawal s WHERE s.kind = '{w}'", f"'{w}'", SHARE_95)
                for w in fixed.WITHDRAWAL_TYPES
            ]
        )
    ),
    "group_snapshot_cells": _held(
        _union(
            [
                _cells("reserve", "px_snapshot s WHERE TRUE", "'reserves'", SHARE_95),
                _cells("interest + bonus", "px_snapshot s WHERE TRUE", "'interest'", SHARE_95),
                _cells("charges", "px_snapshot s WHERE TRUE", "'policy_deduction'", SHARE_95),
                ADMIN_95,
            ]
        )
    ),
    "group_issue_cells": _present(ISSUE_95),
    "group_premium_expense_cells": _held(_union([*_premium_cells(SHARE_50), ISSUE_50, ADMIN_50])),
}

ORACLE_SQL = {name: with_views(body) for name, body in BODIES.items()} | {
    name: _with_groups(body) for name, body in GROUP_BODIES.items()
}

#: A report of one month is that month of the report of all months.
ORACLE_SQL |= {
    f"{name}_one_month": f"SELECT * FROM ({ORACLE_SQL[all_months]}\n) WHERE set_month = '199801'"
    for name, all_months in (
        ("rollforward", "rollforward_checked"),
        ("group_reconciliation", "group_reconciliation_95"),
        ("treaty_reconciliation", "treaty_reconciliation"),
    )
}
