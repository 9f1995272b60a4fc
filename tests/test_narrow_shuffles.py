"""Sums kept once in a shuffle, and members of periods from one number per member and year: same results, fewer bytes."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan_text, rows
from tidemark.operators.summary import member_rollup, member_summary, summary_from_rollup
from tidemark.plans.queries_incremental import members_of_periods
from tidemark.sources.adapters import landing_transactions

from conftest import SF_SMALL


def transactions(spark, amount_type):
    data = [("a", "2024-01", "POS", dt.date(2024, 1, 2), "99999999.99", 10, 1), ("a", "2024-01", "POS", dt.date(2024, 1, 9), "0.01", 10, 2),
            ("a", "2024-02", None, dt.date(2024, 2, 1), "-3.37", 5, 0), ("b", "2024-02", "POS", dt.date(2024, 2, 1), None, 5, 0),
            ("a", "2024-12", "POS", dt.date(2024, 12, 1), "7.10", 0, 0)]
    return spark.createDataFrame(data, "member_id string, transaction_month string, channel string, transaction_date date, amount string, "
                                       "points_earned int, redemption_points int").withColumn("amount", F.col("amount").cast(amount_type))


@pytest.mark.parametrize("amount_type", ["decimal(10,2)", "decimal(12,4)", "decimal(38,2)", "double"])
def test_rollup_spend_is_the_sum_of_amounts(spark, amount_type):
    txns = transactions(spark, amount_type)
    rollup = member_rollup(txns)
    want = txns.groupBy("member_id", "transaction_month", "channel").agg(F.sum("amount").alias("spend"))
    assert rollup.schema["spend"].dataType == want.schema["spend"].dataType
    assert sorted(map(str, rollup.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    as_of = dt.date(2025, 1, 1)
    assert sorted(map(str, summary_from_rollup(rollup, as_of).collect())) == sorted(map(str, member_summary(txns, as_of).collect()))


def test_rollup_and_summary_shuffle_no_second_sum(spark):
    rollup = member_rollup(transactions(spark, "decimal(10,2)"))
    assert "sum(amount" not in plan_text(rollup)
    stored = spark.createDataFrame([("a", "2024-01", "POS", 1, None, 1, 1, 1, None, None)], rollup.schema)
    plan = summary_from_rollup(stored, dt.date(2025, 1, 1))._jdf.queryExecution().executedPlan().toString()
    shuffled = [x for x in plan.split("REPARTITION_BY_COL")[1].splitlines() if "Project" in x][0]
    assert "cents" in shuffled and "spend" not in shuffled


def test_members_of_months_quarters_and_years(spark):
    txns = spark.createDataFrame([("a", "2023-12"), ("a", "2024-01"), ("a", "2024-03"), ("b", "2024-03"), ("b", "2024-03"),
                                  ("c", "2024-04"), (None, "2024-04"), ("a", "2024-12")], "member_id string, transaction_month string")
    want = [("2023", 1), ("2023-12", 1), ("2023-Q4", 1), ("2024", 3), ("2024-01", 1), ("2024-03", 2), ("2024-04", 1), ("2024-12", 1),
            ("2024-Q1", 2), ("2024-Q2", 1), ("2024-Q4", 1)]
    assert rows(members_of_periods(txns)) == want
    assert "Expand" not in plan_text(members_of_periods(txns))


def test_landing_shuffles_made_columns_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = landing_transactions(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan.split("Exchange hashpartitioning(l_orderkey")[1].split("FileScan")[0]
    assert "l_partkey" in plan and "AS amount" in below and "AS transaction_date" in below
