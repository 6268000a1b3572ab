"""Report inputs derived from order tables.

A part stands for a policy, its line items for the policy's movements, and the
line items of a part in a month for its snapshot.  ``views_sql`` states the
same views in SQL.  Money is exact decimal, so that both sides agree to the
last digit whatever the order of summation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed
from cedeflow.functions.months import month_of

MONEY = "decimal(8,2)"
# Every first word of a part's type, and one that no part has.
PLAN_GROUPS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "ABSENT")
WITHDRAWAL_BY_LINE = dict(enumerate(fixed.WITHDRAWAL_TYPES[:7], start=1))
MOVEMENT_BY_LINE = {
    1: "full_surrenders",
    2: "cancellations",
    3: "surrender_fees",
    4: "aiw",
    5: "rmd",
    6: "penalty_free",
}


def _choose(code: Column, values: dict, other=None) -> Column:
    result = F.lit(other)
    for value, label in values.items():
        result = F.when(code == value, F.lit(label)).otherwise(result)
    return result


class SampleViews:
    """The input tables of the reports, each a method; nothing runs until used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey"),
            F.col("l_partkey"),
            F.col("l_partkey").cast("string").alias("policy_number"),
            F.col("l_linenumber").alias("line"),
            F.col("l_quantity").cast(MONEY).alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("price"),
            F.col("l_discount").cast("decimal(4,2)").alias("discount"),
            F.col("l_tax").cast("decimal(4,2)").alias("tax"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linestatus").alias("status"),
            F.col("l_shipdate").cast("date").alias("shipped"),
            month_of(F.col("l_shipdate")).alias("set_month"),
            _choose(F.col("l_returnflag"), {"N": "P", "A": "3C"}, "AF").alias("reins_code"),
        )

    def snapshot(self) -> DataFrame:
        """One row per part and month, with the part's plan and plan group."""
        open_price = F.when(F.col("status") == "O", F.col("price")).otherwise(F.lit(0).cast(MONEY))
        discount = (F.col("price") * F.col("discount")).cast(MONEY)
        tax = (F.col("price") * F.col("tax")).cast(MONEY)
        flag = _choose(F.col("flag"), {"A": 0, "N": 1}, 2)
        sums = {
            "fund_value": open_price,
            "purchase_price": F.col("quantity"),
            "interest_earned": tax,
            "stat_reserve": (F.col("price") - discount).cast(MONEY),
            "bonus_credited": F.when(F.col("flag") == "R", discount),
            "expense_charges": (F.col("quantity") * F.col("tax")).cast(MONEY),
        }
        grouped = (
            self.lines()
            .groupBy("l_partkey", "set_month")
            .agg(
                *[F.sum(value).alias(name) for name, value in sums.items()],
                F.min(flag).alias("flag_no"),
                F.max(F.when(F.col("status") == "O", 1).otherwise(0)).alias("open"),
            )
        )
        return grouped.join(self.parts(), "l_partkey").select(
            F.col("l_partkey").cast("string").alias("policy_number"),
            "set_month",
            _choose(F.col("flag_no"), {0: "AF", 1: "P"}, "X").alias("reins_flag"),
            *sums,
            F.col("interest_earned").alias("interest_credited"),
            F.col("fund_value").alias("eom_fund_value"),
            F.col("fund_value").alias("gross_account_value"),
            F.col("brand").alias("val_code"),
            F.col("brand").alias("plan"),
            F.col("plangroup"),
            F.right("brand", F.lit(1)).alias("term"),
            self._reported().alias("reported_date"),
            _choose(F.col("open"), {1: fixed.ACTIVE}, "Lapsed").alias("current_status"),
        )

    def last_month(self) -> Column:
        """The snapshot's last month: every line's part is in the part table."""
        return self.lines().agg(F.max("set_month")).scalar()

    def parts(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("plangroup"),
            F.col("p_size").alias("size"),
        )

    @staticmethod
    def _reported() -> Column:
        """The month ``size - 1`` months before the snapshot month."""
        number = F.col("set_month").cast("int")
        index = F.floor(number / 100) * 12 + number % 100 - F.col("size")
        return (F.floor(index / 12) * 100 + index % 12 + 1).cast("string")

    def policies(self) -> DataFrame:
        return (
            self.lines()
            .groupBy("policy_number")
            .agg(F.min("shipped").alias("date_issued"))
            .withColumn("reported_date", month_of(F.col("date_issued")))
        )

    def movements(self) -> DataFrame:
        """Withdrawals of nine kinds, one per line item."""
        last = (
            F.when(F.col("status") == "F", "death_claims")
            .when(F.col("flag") == "N", "premium_taxes")
            .otherwise("partial_surrenders")
        )
        return self.lines().select(
            "policy_number",
            "set_month",
            F.coalesce(_choose(F.col("line"), MOVEMENT_BY_LINE), last).alias("kind"),
            (F.col("price") * F.col("discount")).cast(MONEY).alias("amount"),
            "reins_code",
        )

    def movement_tables(self) -> dict[str, DataFrame]:
        """The same as a table per kind, with the premium table."""
        rows = self.movements().withColumnRenamed("amount", "withdrawal_amount")
        return {
            kind: self.premium() if kind == "premium" else rows.filter(F.col("kind") == kind)
            for kind in fixed.TREATY_MOVEMENTS
        }

    def all_movements(self) -> DataFrame:
        """The nine kinds and the premium as the tenth."""
        premium = self.premium().select(
            "policy_number",
            "set_month",
            F.lit("premium").alias("kind"),
            F.col("premium_amount").alias("amount"),
            "reins_code",
        )
        return self.movements().unionByName(premium)

    def premium(self) -> DataFrame:
        return self.lines().select(
            "policy_number",
            "set_month",
            F.col("price").cast(MONEY).alias("premium_amount"),
            (F.lit(1) - F.col("discount")).cast("decimal(3,2)").alias("quota_share"),
            "reins_code",
        )

    def commissions(self) -> DataFrame:
        return self.lines().select(
            "set_month",
            F.col("reins_code").alias("reins_flag"),
            (F.col("price") * F.col("tax")).cast(MONEY).alias("paid"),
        )

    def group_premium(self) -> DataFrame:
        return self.lines().join(self.parts(), "l_partkey").select(
            "set_month",
            "plangroup",
            F.col("price").cast(MONEY).alias("total_premium"),
            (F.col("price") * F.col("tax")).cast(MONEY).alias("renewal_premium"),
            (F.col("price") * F.col("discount")).cast(MONEY).alias("initial_commission"),
        )

    def group_withdrawals(self) -> DataFrame:
        return self.lines().join(self.parts(), "l_partkey").select(
            "set_month",
            "plangroup",
            _choose(F.col("line"), WITHDRAWAL_BY_LINE).alias("withdrawal_type"),
            (F.col("price") * F.col("discount")).cast(MONEY).alias("withdrawal_amount"),
        )

    def terms(self) -> DataFrame:
        """The term of each plan: the last digit of its name."""
        return (
            self.parts()
            .select(F.col("brand").alias("plan"), F.right("brand", F.lit(1)).alias("term"))
            .distinct()
        )

    def surrenders(self) -> DataFrame:
        large_return = (F.col("flag") == "R") & (F.col("quantity") >= 45)
        return self.lines().filter(large_return).select("policy_number", "set_month")

    def _strategy_policy(self) -> Column:
        """Policy numbers begin with D or T, by plan group."""
        early = F.col("plangroup").isin("ECONOMY", "LARGE", "MEDIUM")
        return F.concat(F.when(early, "D").otherwise("T"), F.col("l_partkey").cast("string"))

    def strategy_snapshot(self) -> DataFrame:
        open_price = F.when(F.col("status") == "O", F.col("price")).otherwise(F.lit(0).cast(MONEY))
        return (
            self.lines()
            .groupBy("l_partkey", "set_month", "flag")
            .agg(F.sum(open_price).alias("totalpolicyav"))
            .join(self.parts(), "l_partkey")
            .select(
                self._strategy_policy().alias("policynumber"),
                "set_month",
                F.col("flag").alias("creditstrategy"),
                "totalpolicyav",
                _choose(F.col("flag"), {"N": "0.65", "A": "0.40"}, "0.50")
                .cast("decimal(3,2)")
                .alias("ceded_share"),
            )
        )

    def strategy_policies(self) -> DataFrame:
        return (
            self.lines()
            .join(self.parts(), "l_partkey")
            .select(
                self._strategy_policy().alias("policynumber"),
                "set_month",
                F.col("flag").alias("creditstrategy"),
                F.col("brand").alias("plan"),
                self._reported().alias("reported_date"),
            )
        )

    def new_system(self) -> DataFrame:
        return self.snapshot().select(
            F.col("policy_number").alias("mpolicy"), "set_month", "reported_date", "current_status"
        )

    def index_snapshot(self) -> DataFrame:
        return self.snapshot().withColumnRenamed("policy_number", "policy_id")

    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").alias("c_custkey"),
            F.col("o_custkey").cast("string").alias("policy"),
            F.col("o_totalprice").cast(MONEY).alias("total"),
            F.col("o_orderdate").alias("ordered"),
            month_of(F.col("o_orderdate")).alias("order_month"),
        )

    @staticmethod
    def _reserve_code() -> Column:
        segment = F.col("c_mktsegment")
        return (
            F.when(segment == "BUILDING", "BUI")
            .when(segment == "MACHINERY", "MACHIN")
            .otherwise(F.left(segment, F.lit(5)))
        )

    def life_snapshot(self) -> DataFrame:
        customers = self.table("customer").select("c_custkey", "c_mktsegment")
        return self.orders().join(customers, "c_custkey").select(
            F.col("policy").alias("pmdno"),
            F.col("order_month").alias("set_month"),
            F.col("total").alias("pbfamt"),
            F.col("ordered").alias("pmdissuedt"),
            self._reserve_code().alias("pbfrsvcd1"),
        )

    def life_codes(self) -> DataFrame:
        exhibits = {"BUILDING": "5A", "AUTOMOBILE": "5A", "MACHINERY": "5B", "HOUSEHOLD": "5B"}
        return (
            self.table("customer")
            .select(
                F.lpad(self._reserve_code(), 5, "0").alias("valcode_new"),
                _choose(F.col("c_mktsegment"), exhibits, "5C").alias("exhibit"),
            )
            .distinct()
        )

    def life_annuities(self) -> DataFrame:
        return self.lines().join(self.orders(), "l_orderkey").select(
            F.col("policy").alias("policyno"),
            F.col("order_month").alias("set_month"),
            F.col("price").cast(MONEY).alias("total2"),
        )

    def life_premiums(self) -> DataFrame:
        return self.lines().select(
            F.col("policy_number").alias("policyno"),
            "set_month",
            F.col("price").cast(MONEY).alias("gross_premium"),
        )

    def life_claims(self) -> DataFrame:
        return self.lines().join(self.orders(), "l_orderkey").select(
            F.col("policy").alias("policyno"),
            "set_month",
            (F.col("price") - F.col("price") * F.col("discount")).cast(MONEY).alias("net_payable"),
            F.col("ordered").alias("issue_date"),
        )
