from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from cedeflow import fixed_values as fixed
from cedeflow.plans import blocks
from cedeflow.sinks.published import current, published
from cedeflow.sinks.reports import write_flat, write_monthly
from cedeflow.sources.tables import Tables
from helpers import POLICY, PREMIUM, SNAPSHOT, WITHDRAWAL, rows

GROUP_SNAPSHOT = (
    "policy_number string, set_month string, plangroup string, term string, reported_date string,"
    " eom_fund_value double, stat_reserve double, interest_credited double,"
    " bonus_credited double, expense_charges double"
)


@pytest.fixture
def store(spark, frame, tmp_path):
    """Writes frames as parquet tables and returns them as ``Tables``."""

    def make(**data):
        locations = {}
        for name, (schema, *table_rows) in data.items():
            locations[name] = str(tmp_path / "in" / name)
            frame(schema, *table_rows).write.parquet(locations[name])
        return Tables(spark, locations)

    return make


@pytest.fixture
def treaty(store):
    withdrawals = {
        kind: (WITHDRAWAL,) for kind in {*fixed.TREATY_MOVEMENTS, *fixed.ROLLFORWARD_MOVEMENTS}
    }
    withdrawals["premium"] = (PREMIUM, ("a", "202401", 10.0, 0.5, "P"))
    return store(
        **withdrawals,
        snapshot=(
            SNAPSHOT,
            ("a", "202312", "pl", "P", "v", 1.0, 1.0, 10.0, 9.0),
            ("a", "202401", "pl", "P", "v", 2.0, 1.0, 11.0, 9.0),
            ("b", "202401", "pl", "AF", "v", 2.0, 1.0, 11.0, 9.0),
        ),
        policies=(POLICY, ("a", date(2020, 1, 1), "202001"), ("b", date(2024, 1, 2), "202401")),
        terms=("plan string, term string", ("pl", "5")),
        commissions=("set_month string, reins_flag string, paid double", ("202401", "P", 1.0)),
    )


def test_tables_are_limited_to_the_named_ones(spark, treaty):
    assert treaty["terms"].count() == 1
    with pytest.raises(KeyError, match="unknown table"):
        treaty["passwords"]
    treaty["terms"].createOrReplaceTempView("some_terms")
    assert Tables(spark, {"terms": "some_terms"})["terms"].count() == 1


def test_treaty_block(treaty, spark, tmp_path):
    reports = blocks.block_reports("treaty", treaty)
    assert rows(reports["treaty"]) == [
        ("202312", "2020", 1, 1),
        ("202401", "2020", 1, 0),
        ("202401", "2024", 1, 1),
    ]
    assert rows(reports["treaty_av"]) == [("202401", "5", 2, pytest.approx(11.55))]
    out = str(tmp_path / "out")
    for _ in range(2):  # a second export replaces the first
        blocks.export_block("treaty", treaty, out)
    assert sorted(os.listdir(f"{out}/treaty")) == ["AV", "Data", "IF", "NB"]
    assert rows(spark.read.parquet(f"{out}/treaty/Data")) == rows(reports["treaty"])
    assert rows(spark.read.parquet(f"{out}/treaty/NB")) == [("2020", 1, 0), ("2024", 0, 1)]
    assert rows(spark.read.parquet(f"{out}/treaty/IF")) == [("2020", 1, 1), ("2024", 0, 1)]
    assert rows(spark.read.parquet(f"{out}/treaty/AV")) == rows(reports["treaty_av"])


def test_treaty_exports_by_month(treaty, spark, tmp_path):
    path = str(tmp_path / "roll")
    blocks.export_rollforward(treaty, path)
    everything = blocks.account_value_rollforward(treaty)
    columns = everything.columns
    written = spark.read.schema(everything.schema).parquet(path)
    assert rows(written, *columns) == rows(everything)
    # a single month replaces its own directory only
    blocks.export_rollforward(treaty, path, "202401")
    assert rows(spark.read.schema(everything.schema).parquet(path), *columns) == rows(everything)
    assert {f for f in os.listdir(path) if "=" in f} == {"set_month=202401"}

    path = str(tmp_path / "recon")
    blocks.export_reconciliation("treaty", treaty, path, ["202312", "202401"])
    assert spark.read.parquet(path).count() == 32


def test_a_block_is_published_whole_or_not_at_all(treaty, spark, tmp_path):
    path = str(tmp_path / "published")
    sheets = ["treaty/Data", "treaty/NB", "treaty/IF", "treaty/AV"]
    assert current(spark, path) is None
    with pytest.raises(KeyError, match="nothing is published"):
        published(spark, path, "treaty/Data")
    blocks.publish_block("treaty", treaty, path)
    first = {name: rows(published(spark, path, name)) for name in sheets}
    assert first["treaty/NB"] == [("2020", 1, 0), ("2024", 0, 1)]
    with pytest.raises(KeyError, match="treaty/AV"):
        published(spark, path, "treaty/XX")

    # the next run has other numbers and is lost after three of its four sheets
    more = treaty["snapshot"].unionByName(treaty["snapshot"].withColumn("policy_number", F.lit("b")))
    treaty._read["snapshot"] = more.withColumn("fund_value", F.col("fund_value") + 1)
    treaty._read["terms"] = treaty["terms"].withColumn("term", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        blocks.publish_block("treaty", treaty, path, "parquet")
    runs = [name for name in os.listdir(path) if name.startswith("run_")]
    begun = [name for name in runs if os.path.exists(f"{path}/{name}/treaty/IF/_SUCCESS")]
    assert len(runs) == 2 and len(begun) == 2
    assert {name: rows(published(spark, path, name)) for name in sheets} == first

    # and the run after that takes their place
    del treaty._read["terms"]
    blocks.publish_block("treaty", treaty, path, "csv")
    assert current(spark, path).number == 2
    second = {name: rows(published(spark, path, name)) for name in sheets}
    assert second["treaty/AV"] != first["treaty/AV"]
    assert second["treaty/Data"] == rows(blocks.block_reports("treaty", treaty)["treaty"])


def test_group_block(store, spark, tmp_path):
    tables = store(
        snapshot=(
            GROUP_SNAPSHOT,
            ("a", "202401", "MYGE03", "3", "202401", 100.0, 1.0, 1.0, 1.0, 1.0),
        ),
        premium=(
            "set_month string, plangroup string, total_premium double, renewal_premium double,"
            " initial_commission double",
        ),
        withdrawals=(
            "set_month string, plangroup string, withdrawal_type string,"
            " withdrawal_amount double",
        ),
    )
    reports = blocks.block_reports("group_95", tables)
    assert rows(reports["group_95"]) == [("202401", "MYGE03", "2024", 1, 1)]
    # the account value takes 0.95 in both group blocks
    for block in ("group_95", "group_50"):
        av = blocks.block_reports(block, tables)[f"{block}_av"]
        assert rows(av) == [("202401", "3", 1, pytest.approx(95.0))]
    assert blocks.reconciliation("group_95", tables, "202401").count() == 68
    assert blocks.reconciliation("group_50", tables, "202401").count() == 144
    blocks.export_block("group_95", tables, str(tmp_path / "out"), "csv")
    nb = spark.read.option("header", "true").csv(str(tmp_path / "out/group_95/NB"))
    assert rows(nb) == [("2024", "1")]


def test_strategy_block_has_a_report_per_prefix(store):
    tables = store(
        snapshot=(
            "policynumber string, set_month string, creditstrategy string, totalpolicyav double",
            ("D1", "202401", "s", 1.0),
            ("T1", "202402", "s", 1.0),
        ),
        policies=(
            "policynumber string, set_month string, creditstrategy string, reported_date string",
            ("D1", "202401", "s", "202401"),
            ("T1", "202402", "s", "202401"),
        ),
    )
    reports = blocks.block_reports("strategy", tables)
    assert rows(reports["strategy_D"]) == [("202401", 2024, 1, 1)]
    assert rows(reports["strategy_T"]) == [("202402", 2024, 1, 1)]


def test_index_and_migration_blocks(store):
    value = "set_month string, reported_date string, gross_account_value double"
    tables = store(
        snapshot=(f"policy_id string, {value}", ("a", "202401", "202401", 1.0)),
        old_system=(f"policy_number string, {value}", ("a", "202401", "202401", 1.0)),
        new_system=(
            "mpolicy string, set_month string, reported_date string, current_status string",
            ("b", "202506", "202506", "Active"),
        ),
        surrenders=("policy_number string, set_month string",),
    )
    assert rows(blocks.block_reports("index", tables)["index"]) == [("202401", "2024", 1, 1)]
    assert rows(blocks.block_reports("migration", tables)["migration"]) == [
        ("202401", "2024", 1, 1),
        ("202506", "2025", 1, 1),
    ]


def test_life_block(store, spark, tmp_path):
    tables = store(
        snapshot=(
            "pmdno string, set_month string, pbfamt double, pmdissuedt date, pbfrsvcd1 string",
            ("a", "202401", 100.0, date(2015, 1, 1), "1"),
        ),
        annuities=("policyno string, set_month string, total2 double",),
        codes=("valcode_new string, exhibit string", ("00001", "5A")),
        premiums=("policyno string, set_month string, gross_premium double",),
        claims=("policyno string, set_month string, net_payable double, issue_date date",),
    )
    out = str(tmp_path / "out")
    blocks.export_block("life", tables, out)
    assert rows(spark.read.parquet(f"{out}/life"), "set_month", "count", "famt") == [
        ("202401", 1, 95.0)
    ]


def test_unknown_blocks_are_refused(treaty):
    with pytest.raises(ValueError, match="unknown block"):
        blocks.block_reports("no such block", treaty)
    with pytest.raises(ValueError, match="no reconciliation"):
        blocks.reconciliation("life", treaty)


def test_missing_tables_and_columns_are_named_before_anything_runs(store, spark, treaty):
    tables = store(
        other=("policynumber string, creditstrategy string", ("D1", "s")),
    )
    tables = Tables(spark, {"snapshot": tables.locations["other"]})
    with pytest.raises(ValueError) as error:
        blocks.block_reports("strategy", tables)
    assert str(error.value) == (
        "not in the tables: snapshot.set_month, snapshot.totalpolicyav, table 'policies'"
    )
    with pytest.raises(ValueError, match="snapshot.reins_flag.*table 'policies'.*table 'commissions'"):
        blocks.reconciliation("treaty", tables)
    with pytest.raises(ValueError, match="snapshot.fund_value"):
        blocks.account_value_rollforward(tables)
    with pytest.raises(ValueError, match="table 'annuities'"):
        blocks.block_reports("life", tables)
    blocks.account_value_rollforward(treaty)


def test_sorted_outputs(frame, spark, tmp_path):
    report = frame("set_month string, k int", *[("202401", i * 7 % 50) for i in range(50)])
    write_flat(report, str(tmp_path / "flat"), ["k"])
    flat = spark.read.option("header", "true").csv(str(tmp_path / "flat"))
    assert flat.count() == 50
    write_monthly(report, str(tmp_path / "monthly"), ["k"])
    files = [
        f for f in os.listdir(tmp_path / "monthly" / "set_month=202401") if f.endswith(".parquet")
    ]
    assert len(files) == 1
    got = [r["k"] for r in spark.read.parquet(str(tmp_path / "monthly")).collect()]
    assert got == sorted(got)


def test_a_month_in_order_over_several_files(frame, spark, tmp_path):
    report = frame("set_month string, k int", *[("202401", i * 7 % 500) for i in range(500)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_monthly(report.repartition(4), str(tmp_path / "monthly"), ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    month = tmp_path / "monthly" / "set_month=202401"
    files = sorted(f for f in os.listdir(month) if f.endswith(".parquet"))
    assert len(files) > 1
    parts = [[r["k"] for r in spark.read.parquet(str(month / f)).collect()] for f in files]
    assert [k for part in parts for k in part] == sorted(i * 7 % 500 for i in range(500))


def test_months_of_a_partitioned_table_are_text(frame, spark, tmp_path):
    from pyspark.sql import functions as F

    from cedeflow.operators.account_value import net_av_flat
    from cedeflow.operators.cohorts import cohorts_single
    from cedeflow.sources.tables import Tables

    data = frame(
        "policy_number string, set_month string, reported_date string, term string, "
        "gross_account_value double, eom_fund_value double",
        ("a", "202401", "202401", "x", 1.0, 2.0),
        ("b", "009912", "009912", "x", 1.0, 3.0),
    )
    data.write.parquet(str(tmp_path / "flat"))
    data.write.partitionBy("set_month").parquet(str(tmp_path / "by_month"))
    tables = Tables(spark, {"flat": str(tmp_path / "flat"), "by_month": str(tmp_path / "by_month")})
    for make in (cohorts_single, net_av_flat):
        flat, parted = make(tables["flat"]), make(tables["by_month"])
        assert dict(parted.dtypes) == dict(flat.dtypes)
        assert rows(parted, *flat.columns) == rows(flat)
    one = tables["by_month"].filter(F.col("set_month").isin(["009912"]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "009912" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert one.count() == 1
