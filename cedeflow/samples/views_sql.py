"""The sample views as SQL, assembled into the WITH list a query needs."""

from __future__ import annotations

import re

VIEWS = {
    "px_line": """
        SELECT l_orderkey, l_partkey, CAST(l_partkey AS VARCHAR) AS policy, l_linenumber AS line,
               CAST(l_quantity AS DECIMAL(8,2)) AS quantity,
               CAST(l_extendedprice AS DECIMAL(8,2)) AS price,
               CAST(l_discount AS DECIMAL(4,2)) AS discount,
               CAST(l_tax AS DECIMAL(4,2)) AS tax,
               l_returnflag AS flag, l_linestatus AS status,
               CAST(l_shipdate AS DATE) AS shipped, strftime(l_shipdate, '%Y%m') AS ym,
               CASE l_returnflag WHEN 'N' THEN 'P' WHEN 'A' THEN '3C' ELSE 'AF' END AS code
        FROM lineitem""",
    "px_part": """
        SELECT p_partkey, p_brand AS brand, p_type AS plangroup, p_size AS size FROM part""",
    "px_snapshot": """
        SELECT g.*, CASE flag_no WHEN 0 THEN 'AF' WHEN 1 THEN 'P' ELSE 'X' END AS flag,
               CASE WHEN flag_no = 1 THEN 0.65::DECIMAL(3,2) ELSE 0.40::DECIMAL(3,2) END AS share,
               CASE WHEN is_open = 1 THEN 'Active' ELSE 'Lapsed' END AS current_status,
               brand, plangroup, right(brand, 1) AS term,
               strftime(strptime(ym || '01', '%Y%m%d') - to_months(size - 1), '%Y%m') AS reported,
               strftime(strptime(ym || '01', '%Y%m%d') + INTERVAL 1 MONTH, '%Y%m') AS ym_next,
               strftime(strptime(ym || '01', '%Y%m%d') - INTERVAL 1 MONTH, '%Y%m') AS ym_before
        FROM (SELECT l_partkey, policy, ym,
                     CAST(SUM(CASE WHEN status = 'O' THEN price ELSE 0 END) AS DECIMAL(18,2)) AS fund,
                     CAST(SUM(quantity) AS DECIMAL(18,2)) AS purchase,
                     CAST(SUM(CAST(price * tax AS DECIMAL(8,2))) AS DECIMAL(18,2)) AS interest,
                     CAST(SUM(price - CAST(price * discount AS DECIMAL(8,2))) AS DECIMAL(18,2)) AS reserve,
                     CAST(SUM(CASE WHEN flag = 'R' THEN CAST(price * discount AS DECIMAL(8,2)) END)
                          AS DECIMAL(18,2)) AS bonus,
                     CAST(SUM(CAST(quantity * tax AS DECIMAL(8,2))) AS DECIMAL(18,2)) AS charges,
                     MIN(CASE flag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) AS flag_no,
                     MAX(CASE WHEN status = 'O' THEN 1 ELSE 0 END) AS is_open
              FROM px_line GROUP BY ALL) g
        JOIN px_part ON p_partkey = l_partkey""",
    "px_policy": """
        SELECT policy, MIN(shipped) AS issued, strftime(MIN(shipped), '%Y%m') AS reported
        FROM px_line GROUP BY policy""",
    "px_movement": """
        SELECT policy, ym, code, CAST(price * discount AS DECIMAL(8,2)) AS amount,
               CASE line WHEN 1 THEN 'full_surrenders' WHEN 2 THEN 'cancellations'
                         WHEN 3 THEN 'surrender_fees' WHEN 4 THEN 'aiw' WHEN 5 THEN 'rmd'
                         WHEN 6 THEN 'penalty_free'
                         ELSE CASE WHEN status = 'F' THEN 'death_claims'
                                   WHEN flag = 'N' THEN 'premium_taxes'
                                   ELSE 'partial_surrenders' END END AS kind
        FROM px_line""",
    "px_premium": """
        SELECT policy, ym, code, CAST(price AS DECIMAL(8,2)) AS amount,
               CAST(1 - discount AS DECIMAL(3,2)) AS ceded_part
        FROM px_line""",
    "px_any_movement": """
        SELECT policy, ym, kind, amount, code FROM px_movement
        UNION ALL SELECT policy, ym, 'premium', amount, code FROM px_premium""",
    "px_commission": """
        SELECT ym, code AS flag, CAST(price * tax AS DECIMAL(8,2)) AS paid FROM px_line""",
    "px_group_premium": """
        SELECT ym, plangroup, CAST(price AS DECIMAL(8,2)) AS total_premium,
               CAST(price * tax AS DECIMAL(8,2)) AS renewal_premium,
               CAST(price * discount AS DECIMAL(8,2)) AS initial_commission
        FROM px_line JOIN px_part ON p_partkey = l_partkey""",
    "px_group_withdrawal": """
        SELECT ym, plangroup, CAST(price * discount AS DECIMAL(8,2)) AS amount,
               CASE line WHEN 1 THEN 'Full Surrender Withdrawals'
                         WHEN 2 THEN 'Partial Withdrawal with SC'
                         WHEN 3 THEN 'RMD Withdrawals'
                         WHEN 4 THEN 'Free Interest Credit Withdrawals'
                         WHEN 5 THEN 'Freelook Withdrawals'
                         WHEN 6 THEN 'Cancellation Withdrawals'
                         WHEN 7 THEN 'Death Benefit' END AS kind
        FROM px_line JOIN px_part ON p_partkey = l_partkey""",
    "px_term": """
        SELECT DISTINCT brand AS plan, right(brand, 1) AS term FROM px_part""",
    "px_surrender": """
        SELECT policy, ym FROM px_line WHERE flag = 'R' AND quantity >= 45""",
    "px_strategy": """
        SELECT CASE WHEN plangroup IN ('ECONOMY', 'LARGE', 'MEDIUM') THEN 'D' ELSE 'T' END || policy
                   AS policy,
               ym, flag AS strategy,
               CAST(SUM(CASE WHEN status = 'O' THEN price ELSE 0 END) AS DECIMAL(18,2)) AS av,
               CASE flag WHEN 'N' THEN 0.65::DECIMAL(3,2) WHEN 'A' THEN 0.40::DECIMAL(3,2)
                         ELSE 0.50::DECIMAL(3,2) END AS ceded_part
        FROM px_line JOIN px_part ON p_partkey = l_partkey
        GROUP BY ALL""",
    "px_strategy_policy": """
        SELECT CASE WHEN plangroup IN ('ECONOMY', 'LARGE', 'MEDIUM') THEN 'D' ELSE 'T' END || policy
                   AS policy,
               ym, flag AS strategy, brand AS plan,
               strftime(strptime(ym || '01', '%Y%m%d') - to_months(size - 1), '%Y%m') AS reported
        FROM px_line JOIN px_part ON p_partkey = l_partkey""",
    "px_order": """
        SELECT o_orderkey, o_custkey, CAST(o_custkey AS VARCHAR) AS policy,
               CAST(o_totalprice AS DECIMAL(8,2)) AS total,
               CAST(o_orderdate AS DATE) AS ordered, strftime(o_orderdate, '%Y%m') AS order_ym,
               CASE WHEN o_orderdate < DATE '1996-12-31' THEN 1
                    WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' THEN 2
                    WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1998-07-01' AND DATE '1999-12-31' THEN 3
                    WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2001-03-31' THEN 4
               END AS tranche
        FROM orders""",
    "px_segment": """
        SELECT c_custkey, c_mktsegment AS segment,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'BUI' WHEN 'MACHINERY' THEN 'MACHIN'
                                 ELSE left(c_mktsegment, 5) END AS reserve_code
        FROM customer""",
    "px_life": """
        SELECT policy, order_ym AS ym, total AS face, ordered, tranche, reserve_code
        FROM px_order JOIN px_segment ON c_custkey = o_custkey""",
    "px_code": """
        SELECT DISTINCT lpad(reserve_code, 5, '0') AS code,
               CASE segment WHEN 'BUILDING' THEN '5A' WHEN 'AUTOMOBILE' THEN '5A'
                            WHEN 'MACHINERY' THEN '5B' WHEN 'HOUSEHOLD' THEN '5B'
                            ELSE '5C' END AS exhibit
        FROM px_segment""",
    "px_annuity": """
        SELECT o.policy, order_ym AS ym, CAST(price AS DECIMAL(8,2)) AS total2
        FROM px_line JOIN px_order o ON o_orderkey = l_orderkey""",
    "px_claim": """
        SELECT o.policy, l.ym, tranche, CAST(price - price * discount AS DECIMAL(8,2)) AS payable
        FROM px_line l JOIN px_order o ON o_orderkey = l_orderkey""",
}


def with_views(body: str) -> str:
    """The query with the views it uses, directly or through another, in front."""
    needed: set[str] = set()

    def add(text: str) -> None:
        for name in re.findall(r"\bpx_\w+", text):
            if name in VIEWS and name not in needed:
                needed.add(name)
                add(VIEWS[name])

    add(body)
    listed = [f"{name} AS MATERIALIZED ({VIEWS[name]})" for name in VIEWS if name in needed]
    return "WITH " + ",\n".join(listed) + "\n" + body.strip()
