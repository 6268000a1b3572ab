from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from cedeflow.operators.account_value import net_av_dedup, net_av_flag, net_av_flat
from cedeflow.operators.tranches import (
    life_claims,
    life_face,
    life_merged,
    life_premium,
    life_report,
)
from helpers import rows


def test_flat_share(frame):
    snapshot = frame(
        "policy_number string, set_month string, term string, eom_fund_value double",
        ("a", "202401", "3", 100.0),
        (None, "202401", "3", 100.0),
        ("b", "202401", None, None),
    )
    assert rows(net_av_flat(snapshot)) == [("202401", "3", 1, 190.0), ("202401", None, 1, None)]
    half = net_av_flat(snapshot, Decimal("0.5"))
    assert ("202401", "3", 1, 100.0) in rows(half)


def test_flag_share_by_term(frame):
    snapshot = frame(
        "policy_number string, set_month string, plan string, reins_flag string,"
        " fund_value double",
        ("a", "202401", "p1", "P", 100.0),
        ("b", "202401", "p2", None, 100.0),
        ("c", "202401", "unknown", "P", 100.0),
        ("d", "202312", "p1", "P", 100.0),
    )
    terms = frame("plan string, term string", ("p1", "3"), ("p2", "3"), ("p2", "5"))
    assert rows(net_av_flag(snapshot, terms)) == [
        ("202401", "3", 2, pytest.approx(105.0)),
        ("202401", "5", 1, pytest.approx(40.0)),
    ]


def test_deduplicated_value(frame):
    snapshot = frame(
        "policynumber string, set_month string, creditstrategy string, totalpolicyav double,"
        " ceded_share double",
        ("D1", "202401", "s", 100.0, 0.5),
        ("D1", "202401", "t", 100.0, 0.5),  # the same value again
        ("D1", "202401", "u", 100.0, 0.4),  # another share is summed
        ("D1", "202312", "s", 100.0, 0.5),
        ("T1", "202401", "s", 10.0, 0.5),
    )
    policies = frame(
        "policynumber string, set_month string, creditstrategy string, plan string",
        ("D1", "202401", "s", "pl"),
        ("D1", "202401", "t", "pl"),
        ("D1", "202312", "s", "pl"),
        ("T1", "202401", "s", "pl"),
    )
    assert rows(net_av_dedup(snapshot, policies, "D%")) == [("202401", "pl", pytest.approx(90.0))]
    assert rows(net_av_dedup(snapshot, policies, "D%", since="202301"))[0][:2] == ("202312", "pl")
    several = net_av_dedup(snapshot, policies, ["D%", "%", "X%"])
    for prefix in ("D%", "%", "X%"):
        part = several.filter(several.prefix == prefix).drop("prefix")
        assert rows(part) == rows(net_av_dedup(snapshot, policies, prefix))


LIFE = (
    "pmdno string, set_month string, pbfamt double, pmdissuedt timestamp, pbfrsvcd1 string"
)
ANNUITY = "policyno string, set_month string, total2 double"
CODE = "valcode_new string, exhibit string"
PREMIUM = "policyno string, set_month string, gross_premium double"
CLAIM = "policyno string, set_month string, net_payable double, issue_date timestamp"


def day(*d):
    return datetime(*d)


@pytest.fixture
def life(frame):
    snapshot = frame(
        LIFE,
        ("a", "202401", 100.0, day(2015, 1, 1), "123"),  # padded to 00123, exhibit 5A
        ("a", "202402", 100.0, day(2016, 1, 1), "123"),
        ("b", "202401", 999.0, day(2015, 1, 1), "456789"),  # cut to 45678, exhibit 5B
        ("b", "202401", 999.0, day(2015, 1, 1), "456789"),
        ("c", "202401", 50.0, day(2017, 9, 30), "123"),  # in the gap
        ("d", "202401", 70.0, day(2019, 1, 1), "99999"),  # exhibit not reported
        ("e", "202401", 70.0, day(2019, 1, 1), "00000"),  # no exhibit
        ("f", "202401", 30.0, day(2019, 1, 1), "dup"),  # listed twice under 5A
        ("g", "202401", None, day(2021, 1, 1), "123"),
    )
    annuities = frame(
        ANNUITY,
        ("b", "202401", 10.0),
        ("b", "202401", 5.0),
        ("a", "202401", 1.0),
        ("a", "202401", 1.0),
        ("b", "202402", 1000.0),
    )
    codes = frame(
        CODE,
        ("00123", "5A"),
        ("45678", "5B"),
        ("99999", "5C"),
        ("00dup", "5A"),
        ("00dup", "5A"),
    )
    premiums = frame(
        PREMIUM,
        ("a", "202402", 10.0),
        ("a", "202402", 20.0),
        ("c", "202401", 1.0),
        ("nobody", "202401", 3.0),
        ("d", "202401", None),
    )
    claims = frame(
        CLAIM,
        ("a", "202401", 40.0, day(2015, 1, 1)),
        (None, "202401", 2.0, day(2015, 1, 1)),
        ("x", "202401", 8.0, None),
    )
    return snapshot, annuities, codes, premiums, claims


def test_face_amount(life):
    snapshot, annuities, codes, _, _ = life
    got = {tuple(r)[:2]: tuple(r)[2:] for r in life_face(snapshot, annuities, codes).collect()}
    # a counts once per annuity row, b's two rows meet two annuities each
    assert got["202401", 1] == (2, pytest.approx((2 * 100 + 2 * 15) * 0.95))
    assert got["202402", 1] == (1, pytest.approx(95.0))
    assert got["202401", None] == (None, pytest.approx(47.5))
    assert got["202401", 3] == (1, pytest.approx(2 * 30 * 0.95))
    assert got["202401", 4] == (1, None)
    assert len(got) == 5


def test_face_amount_equals_sql(spark, life):
    snapshot, annuities, codes, _, _ = life
    snapshot.createOrReplaceTempView("sn")
    annuities.createOrReplaceTempView("an")
    codes.createOrReplaceTempView("co")
    expected = spark.sql(
        """SELECT s.set_month, year(s.pmdissuedt) y,
                  sum(CASE c.exhibit WHEN '5A' THEN s.pbfamt WHEN '5B' THEN a.total2 END) * 0.95D
           FROM sn s LEFT JOIN an a ON a.policyno = s.pmdno AND a.set_month = s.set_month
           LEFT JOIN co c ON c.valcode_new = lpad(s.pbfrsvcd1, 5, '0')
           WHERE c.exhibit IN ('5A', '5B') GROUP BY ALL"""
    )
    years = [(y, date(y, 1, 1), date(y, 12, 31)) for y in range(2014, 2023)]
    got = life_face(snapshot, annuities, codes, years).select(
        "set_month", "tranche_mapping", "famt"
    )
    assert [r[:2] for r in rows(got)] == [r[:2] for r in rows(expected)]
    assert [r[2] for r in rows(got)] == pytest.approx([r[2] for r in rows(expected)])


def test_premium_uses_the_first_issue_date_of_all_snapshots(life):
    snapshot, _, _, premiums, _ = life
    assert rows(life_premium(premiums, snapshot), "set_month", "tranche_mapping", "ct", "net_prem") == [
        ("202401", 3, 1, None),
        ("202401", None, 2, pytest.approx(3.8)),
        ("202402", 1, 2, pytest.approx(28.5)),
    ]


def test_claims(life):
    assert rows(life_claims(life[4]), "set_month", "tranche_mapping", "ct", "claim_amount") == [
        ("202401", 1, 1, pytest.approx(39.9)),
        ("202401", None, 1, pytest.approx(7.6)),
    ]


def test_merge_keeps_face_rows_and_matches_missing_tranches(life):
    report = life_report(*life)
    assert report.columns == [
        "set_month",
        "tranche_mapping",
        "count",
        "famt",
        "prem_ct",
        "net_prem",
        "claim_ct",
        "claim_amount",
    ]
    got = {tuple(r)[:2]: tuple(r)[2:] for r in report.collect()}
    assert got["202401", None][2:] == (2, pytest.approx(3.8), 1, pytest.approx(7.6))
    assert got["202402", 1][2:] == (2, pytest.approx(28.5), None, None)
    assert got["202401", 1][2:] == (None, None, 1, pytest.approx(39.9))


def test_merge_drops_premium_without_face(frame):
    face = frame("set_month string, tranche_mapping int, count long, famt double", ("m", 1, 1, 1.0))
    premium = frame("set_month string, tranche_mapping int, ct long, net_prem double", ("m", 2, 1, 1.0))
    claims = frame("set_month string, tranche_mapping int, ct long, claim_amount double")
    assert rows(life_merged(face, premium, claims)) == [("m", 1, 1, 1.0, None, None, None, None)]
