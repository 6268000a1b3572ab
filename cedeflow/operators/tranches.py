"""Life premium, face amount and claims by month and issue-date tranche."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed
from cedeflow.functions.factors import tranche_of

KEYS = ("set_month", "tranche_mapping")


def reserve_code(code: Column) -> Column:
    """The code as the lookup table writes it: padded, or cut, to five characters."""
    return F.lpad(code, fixed.RESERVE_CODE_LENGTH, "0")


def life_premium(
    premiums: DataFrame, snapshot: DataFrame, tranches=fixed.LIFE_TRANCHES
) -> DataFrame:
    """Premium rows and ceded premium by the first issue date of their policy.

    The earliest date over all snapshots counts; an unknown policy has no
    tranche.  Premiums are grouped by policy and month before the join.
    """
    paid = premiums.groupBy(F.col("policyno").alias("policy"), "set_month").agg(
        F.count("*").alias("rows"), F.sum("gross_premium").alias("gross")
    )
    issued = snapshot.groupBy(F.col("pmdno").alias("policy")).agg(
        F.min(F.col("pmdissuedt").cast("date")).alias("issued")
    )
    return (
        paid.join(issued, "policy", "left")
        .groupBy("set_month", tranche_of(F.col("issued"), tranches).alias("tranche_mapping"))
        .agg(
            F.sum("rows").alias("ct"),
            (F.sum("gross") * F.lit(fixed.LIFE_SHARE)).alias("net_prem"),
        )
    )


def life_face(
    snapshot: DataFrame, annuities: DataFrame, codes: DataFrame, tranches=fixed.LIFE_TRANCHES
) -> DataFrame:
    """Policies in force and ceded face amount of the two reported exhibits.

    The face amount is the policy's own for the life exhibit and the annuity
    total for the annuity exhibit.  Repeated lookup and annuity rows multiply
    the face amount but not the policy count; without a tranche there is no
    count.

    Everything is summed per policy and month before the annuity join: the
    face amount is linear in both sides, so each key is one row on either.
    The code lookup is counted to one row a code, so that the join adds no rows
    however often a code is listed.  It is left to Spark, which broadcasts it if
    it is small and else splits codes that hold too many policies.
    """
    is_life = F.col("exhibit") == fixed.LIFE_EXHIBIT
    exhibits = (
        codes.filter(F.col("exhibit").isin(fixed.LIFE_EXHIBIT, fixed.ANNUITY_EXHIBIT))
        .groupBy(F.col("valcode_new").alias("code"))
        .agg(
            F.count_if(is_life).cast("int").alias("n_life"),
            F.count_if(~is_life).alias("n_annuity"),
        )
    )
    held = (
        snapshot.withColumn("code", reserve_code(F.col("pbfrsvcd1")))
        .join(exhibits, "code")
        .groupBy(
            F.col("pmdno").alias("policy"),
            "set_month",
            tranche_of(F.col("pmdissuedt"), tranches).alias("tranche_mapping"),
        )
        .agg(
            F.sum(F.when(F.col("n_life") > 0, F.col("pbfamt") * F.col("n_life"))).alias(
                "life_face"
            ),
            F.sum("n_annuity").alias("annuity_rows"),
        )
    )
    paying = annuities.groupBy(F.col("policyno").alias("policy"), "set_month").agg(
        F.count("*").alias("matches"), F.sum("total2").alias("annuity_total")
    )
    life = F.sum(F.col("life_face") * F.coalesce("matches", F.lit(1)))
    annuity = F.sum(
        F.when(F.col("annuity_rows") > 0, F.col("annuity_total") * F.col("annuity_rows"))
    )
    return (
        held.join(paying, ["policy", "set_month"], "left")
        .groupBy(*KEYS)
        .agg(
            F.count("policy").alias("policies"),
            life.alias("life"),
            annuity.alias("annuity"),
        )
        .select(
            *KEYS,
            F.when(F.col("tranche_mapping").isNotNull(), F.col("policies")).alias("count"),
            (
                F.coalesce(F.col("life") + F.col("annuity"), "life", "annuity")
                * F.lit(fixed.LIFE_SHARE)
            ).alias("famt"),
        )
    )


def life_claims(claims: DataFrame, tranches=fixed.LIFE_TRANCHES) -> DataFrame:
    """Claims and ceded claim amount by the issue date of the claim row."""
    return claims.groupBy(
        "set_month", tranche_of(F.col("issue_date"), tranches).alias("tranche_mapping")
    ).agg(
        F.count("policyno").alias("ct"),
        (F.sum("net_payable") * F.lit(fixed.LIFE_SHARE)).alias("claim_amount"),
    )


def life_merged(face: DataFrame, premium: DataFrame, claims: DataFrame) -> DataFrame:
    """Premium and claims beside the face amounts; a missing tranche matches itself."""
    premium = premium.select(
        F.col("set_month").alias("premium_month"),
        F.col("tranche_mapping").alias("premium_tranche"),
        F.col("ct").alias("prem_ct"),
        "net_prem",
    )
    claims = claims.select(
        F.col("set_month").alias("claim_month"),
        F.col("tranche_mapping").alias("claim_tranche"),
        F.col("ct").alias("claim_ct"),
        "claim_amount",
    )
    month, tranche = F.col("set_month"), F.col("tranche_mapping")
    return (
        face.join(
            premium,
            month.eqNullSafe(F.col("premium_month"))
            & tranche.eqNullSafe(F.col("premium_tranche")),
            "left",
        )
        .join(
            claims,
            month.eqNullSafe(F.col("claim_month")) & tranche.eqNullSafe(F.col("claim_tranche")),
            "left",
        )
        .select(
            *KEYS, "count", "famt", "prem_ct", "net_prem", "claim_ct", "claim_amount"
        )
    )


def life_report(
    snapshot: DataFrame,
    annuities: DataFrame,
    codes: DataFrame,
    premiums: DataFrame,
    claims: DataFrame,
    tranches=fixed.LIFE_TRANCHES,
) -> DataFrame:
    return life_merged(
        life_face(snapshot, annuities, codes, tranches),
        life_premium(premiums, snapshot, tranches),
        life_claims(claims, tranches),
    )
