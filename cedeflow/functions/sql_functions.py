"""The rate factors as SQL functions of a session, for reports written in SQL.

Each is a function with a RETURN body, so Spark puts its expression into the
plan: nothing is called per row, and no Python runs.  The bodies are built from
the same fixed values as the column functions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from decimal import Decimal

from pyspark.sql import SparkSession

from cedeflow import fixed_values as fixed

RATE = "DECIMAL(10, 4)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _by_code(rates: Mapping[str, Decimal], other: Decimal) -> str:
    cases = " ".join(f"WHEN {_text(code)} THEN {rate}" for code, rate in rates.items())
    return f"CASE code {cases} ELSE {other} END" if rates else str(other)


def _in_codes(codes: Iterable[str], load: Decimal, other: Decimal) -> str:
    return _by_code(dict.fromkeys(codes, load), other)


def _tranche(tranches: Iterable[tuple[int, date | None, date | None]]) -> str:
    cases = []
    for number, first, last in tranches:
        ends = [f"day >= DATE'{first}'"] if first else []
        ends += [f"day <= DATE'{last}'"] if last else []
        cases.append(f"WHEN {' AND '.join(ends)} THEN {number}")
    return f"CASE {' '.join(cases)} END"


def bodies() -> dict[str, tuple[str, str, str]]:
    """Each function's parameters, result type and expression, by its name."""
    share = _by_code(fixed.FLAG_SHARES, fixed.OTHER_FLAG_SHARE)
    issue = _in_codes(fixed.ISSUE_LOAD_FLAGS, fixed.ISSUE_LOAD, fixed.OTHER_ISSUE_LOAD)
    claim = _in_codes(fixed.CLAIM_LOAD_CODES, fixed.CLAIM_LOAD, fixed.OTHER_CLAIM_LOAD)
    years = "CAST(left(month, 4) AS INT) - base_year"
    return {
        "quota_share": ("code STRING", RATE, share),
        "issue_load": ("code STRING", RATE, issue),
        "claim_load": ("code STRING", RATE, claim),
        "inflation": ("month STRING, rate DOUBLE, base_year INT", "DOUBLE", f"power(1 + rate, {years})"),
        "tranche_of": ("day DATE", "INT", _tranche(fixed.LIFE_TRANCHES)),
    }


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session; their names."""
    made = bodies()
    for name, (parameters, result, body) in made.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}"
        )
    return list(made)
