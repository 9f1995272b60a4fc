import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.dedup import ingest_order, latest_per_key
from tidemark.operators.enrich import DuplicateKeyError, enrich
from tidemark.operators.merge import apply_changes, capture_changes, upsert, upsert_with_changes
from tidemark.operators.quality import (Expectation, GateFailed, default_suite,
                                        expectation_report, gate, split_rules)
from tidemark.operators.summary import member_summary

TXN_SCHEMA = ("transaction_id string, member_id string, transaction_date date, "
              "amount decimal(10,2), points_earned int, channel string, store_id string, "
              "tier string, redemption_points int")
D = dt.date


def txns(spark, data):
    return spark.createDataFrame(data, TXN_SCHEMA)


def test_split_rules_null_amount_goes_to_quarantine(spark):
    df = txns(spark, [
        ("T1", "M1", D(2024, 1, 1), Decimal("10.00"), 10, "POS", "S1", "gold", 0),
        ("T2", "M1", D(2024, 1, 1), None, 10, "POS", "S1", "gold", 0),         # NULL amount
        ("T3", None, D(2024, 1, 1), Decimal("5.00"), 10, "POS", "S1", "gold", 0),
        ("T4", "M2", D(2024, 1, 1), Decimal("-1.00"), 10, "POS", "S1", "gold", 0),
        ("T5", "M2", None, Decimal("3.00"), 10, "POS", "S1", "gold", 0),
    ])
    clean, bad = split_rules(df)
    assert rows(clean, "transaction_id") == [("T1",)]
    assert rows(bad, "transaction_id") == [("T2",), ("T3",), ("T4",), ("T5",)]
    assert clean.count() + bad.count() == df.count()
    reasons = {r["transaction_id"]: r["failed_rules"] for r in bad.collect()}
    assert reasons["T2"] == ["amount_positive"] and reasons["T3"] == ["member_present"]


def test_latest_per_key_total_order_and_plan(spark):
    df = txns(spark, [
        ("T1", "M1", D(2024, 1, 1), Decimal("10.00"), 10, "POS", "S1", "gold", 0),
        ("T1", "M1", D(2024, 1, 2), Decimal("9.00"), 10, "POS", "S1", "gold", 0),
        ("T1", "M1", D(2024, 1, 2), Decimal("11.00"), 10, "POS", "S1", "gold", 0),
        ("T2", "M2", D(2024, 1, 1), Decimal("1.00"), 10, "POS", "S1", "gold", 0),
    ])
    out = latest_per_key(df, "transaction_id", ingest_order(df))
    assert rows(out, "transaction_id", "amount") == [("T1", Decimal("11.00")),
                                                     ("T2", Decimal("1.00"))]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_member_summary_exact_rounding_mode_and_ltv(spark):
    df = txns(spark, [
        # avg basket 2.01 / 2 = 1.005 -> 1.01 (exact half-up, not binary)
        ("T1", "M1", D(2024, 1, 1), Decimal("1.00"), 100, "POS", "S1", "gold", 10),
        ("T2", "M1", D(2024, 1, 1), Decimal("1.01"), 100, "mobile_app", "S1", "gold", 20),
        ("T3", "M2", D(2024, 1, 1), Decimal("500.00"), 50, None, "S1", "gold", 0),
        ("T4", "M2", D(2024, 12, 31), Decimal("600.00"), 50, "partner_api", "S1", "gold", 0),
    ])
    s = {r["member_id"]: r for r in member_summary(df, D(2025, 1, 10)).collect()}
    m1, m2 = s["M1"], s["M2"]
    assert m1["avg_transaction_value"] == Decimal("1.01")
    assert m1["preferred_channel"] == "POS"            # tie -> smallest value
    assert m1["annual_ltv"] is None                    # single active day
    assert m1["reward_breakage_rate"] == 85.0          # (1 - 30/200) * 100
    assert m1["current_tier"] == "bronze" and m2["current_tier"] == "silver"
    assert m2["annual_ltv"] == Decimal("1100.00")      # 1100 over 365 days
    assert m2["days_since_last_txn"] == 10
    assert m2["preferred_channel"] == "partner_api"    # NULL ignored


def _state(spark, data):
    return spark.createDataFrame(data, "k string, v int, ver int")


def test_upsert_is_idempotent_and_guarded(spark):
    target = _state(spark, [("a", 1, 1), ("b", 2, 5)])
    source = _state(spark, [("b", 20, 3), ("c", 3, 1), ("a", 10, 2)])
    once = upsert(target, source, ["k"], version_cols=("ver",))
    assert rows(once) == [("a", 10, 2), ("b", 2, 5), ("c", 3, 1)]   # older b loses
    twice = upsert(once, source, ["k"], version_cols=("ver",))
    assert rows(twice) == rows(once)
    _, changes = upsert_with_changes(once, source, ["k"], version_cols=("ver",))
    assert changes.count() == 0                                      # no-op second merge


def test_upsert_adds_new_columns_and_deletes(spark):
    target = _state(spark, [("a", 1, 1), ("b", 2, 1)])
    source = spark.createDataFrame([("c", 3, 1, 1.5)], "k string, v int, ver int, extra double")
    dels = spark.createDataFrame([("a",)], "k string")
    result, changes = upsert_with_changes(target, source, ["k"], delete_keys=dels)
    assert rows(result) == [("b", 2, 1, None), ("c", 3, 1, 1.5)]
    assert sorted(r["_change_type"] for r in changes.collect()) == ["delete", "insert"]


def _odd_sides(spark):
    """Keys on either side and on both, null keys, a target with a key twice, newer, older and equal versions."""
    target = _state(spark, [("a", 1, 5), ("b", 2, 1), ("b", 9, 1), ("c", 3, 3), (None, 4, 1), (None, 5, 1), ("e", None, None), ("f", 6, None)])
    source = _state(spark, [("a", 7, 4), ("b", 8, 2), ("c", 3, 3), (None, 4, 2), ("d", 1, 1), ("e", 1, 1), ("f", 7, None)])
    return target, source


@pytest.mark.parametrize("version_cols", [None, ("ver",)])
@pytest.mark.parametrize("deleted", [[], ["a", "d", "zz"]])
def test_both_joins_of_a_merge_give_the_same_rows(spark, version_cols, deleted):
    target, source = _odd_sides(spark)
    dels = spark.createDataFrame([(k,) for k in deleted], "k string") if deleted else None
    by_keys, outer = [upsert_with_changes(target, source, ["k"], version_cols, dels, by_keys=x) for x in (True, False)]
    for one, other in zip(by_keys, outer, strict=True):
        assert one.dtypes == other.dtypes
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_outer_join_of_a_merge_refuses_a_key_twice(spark):
    target, source = _odd_sides(spark)
    with pytest.raises(Exception, match="several rows for one key"):
        upsert(target, source.unionByName(source.where("k = 'd'")), ["k"]).collect()


def test_upsert_reads_either_side_once(spark, tmp_path):
    for name, df in zip(("target", "source"), _odd_sides(spark), strict=True):
        df.write.parquet(f"{tmp_path}/{name}")
    target, source = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("target", "source"))
    plan = upsert(target, source, ["k"], ("ver",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_change_capture_roundtrip(spark):
    old = _state(spark, [("a", 1, 1), ("b", 2, 1), ("c", 3, 1)])
    new = _state(spark, [("a", 1, 1), ("b", 5, 2), ("d", 4, 1)])
    ch = capture_changes(old, new, ["k"])
    kinds = sorted((r["k"], r["_change_type"]) for r in ch.collect())
    assert kinds == [("b", "update_postimage"), ("b", "update_preimage"), ("c", "delete"),
                     ("d", "insert")]
    assert rows(apply_changes(old, ch, ["k"])) == rows(new)


def test_expectation_report_and_gate(spark):
    df = txns(spark, [
        ("T1", "M1", D(2024, 1, 1), Decimal("10.00"), 10, "POS", "S1", "gold", 0),
        ("T1", None, D(2024, 1, 1), Decimal("3000.00"), 10, "fax", "S1", "gold", 0),
    ])
    rep = {r["expectation"]: r for r in expectation_report(df, default_suite()).collect()}
    assert rep["not_null_member_id"]["unexpected_count"] == 1
    assert rep["channel_in_set"]["success"] is False
    assert rep["unique_transaction_id"]["unexpected_count"] == 2
    assert rep["row_count_min"]["success"] is False and rep["row_count_min"]["severity"] == "warning"
    assert rep["amount_typical_range"]["unexpected_pct"] == 50.0
    with pytest.raises(GateFailed):
        gate(expectation_report(df, default_suite()))
    warn_only = [Expectation("rows", "row_count", None, "warning", min_value=100)]
    assert len(gate(expectation_report(df, warn_only))) == 1          # warns, no raise


def test_enrich_checks_key_and_broadcasts_small_dim(spark):
    fact = spark.createDataFrame([("S1", 1), ("S2", 2), ("S9", 3)], "store_id string, n int")
    dim = spark.createDataFrame([("S1", "a"), ("S2", "b")], "store_id string, name string")
    out = enrich(fact, dim, "store_id")
    assert rows(out, "store_id", "name") == [("S1", "a"), ("S2", "b"), ("S9", None)]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(DuplicateKeyError):
        enrich(fact, dim.unionByName(dim), "store_id")


def test_summary_from_rollup_equals_direct_summary(spark):
    from tidemark.functions.exprs import month_of
    from tidemark.operators.summary import member_rollup, summary_from_rollup
    from tidemark.plans.queries import silver_frame
    from conftest import SF_SMALL
    silver = silver_frame(spark, SF_SMALL)
    as_of = dt.date(2001, 12, 31)
    direct = member_summary(silver, as_of).drop("last_updated_ts")
    via = summary_from_rollup(member_rollup(silver), as_of).drop("last_updated_ts")
    assert dict(direct.dtypes) == dict(via.dtypes)
    assert rows(direct) == rows(via)


def test_store_join_match_rate_on_driver_tables(spark):
    from conftest import SF_SMALL
    from tidemark.operators.enrich import match_rate
    from tidemark.sources.adapters import landing_transactions, store_dim
    r = match_rate(landing_transactions(spark, SF_SMALL), store_dim(spark, SF_SMALL),
                   "store_id").first()
    assert r["fact_rows"] > 0 and r["matched_rows"] == r["fact_rows"]


def test_reconcile_keeps_rounding_casts(spark):
    """Only casts that turn a value into NULL are quarantined; 1.239 -> 1.24 passes."""
    from pyspark.sql.types import DecimalType, StructField, StructType
    from tidemark.operators.schema import reconcile_schema
    target = StructType([StructField("amount", DecimalType(10, 2))])
    df = spark.createDataFrame([("1.239",), ("x",), (None,)], "amount string")
    good, bad = reconcile_schema(df, target)
    assert sorted(r["amount"] for r in good.collect() if r["amount"] is not None) == [Decimal("1.24")]
    assert good.count() == 2 and [r["raw_row"] for r in bad.collect()] == ['{"amount":"x"}']


def test_ratios_of_very_large_sums(spark):
    """1e18 cents and more: products are taken on decimals, not on BIGINT."""
    from tidemark.functions.exprs import round_ratio_decimal, round_ratio_half_up
    df = spark.sql("SELECT 1000000000000000000L AS cents, 3L AS n, 5000000000000000000L AS p, 7000000000000000000L AS q")
    r = df.select(round_ratio_half_up("cents", "n * 100000000").alias("a"), round_ratio_half_up("p * 100", "q").alias("b"),
                  round_ratio_decimal("cents * 365", "n * 100000000", 27).alias("c")).first()
    assert (r["a"], r["b"]) == (3333333333.33, 71.43) and str(r["c"]) == "1216666666666.67"


def test_sample_is_a_seeded_subset(spark):
    from tidemark.operators.quality import dq_sample
    df = spark.range(40000).withColumnRenamed("id", "v")
    got = dq_sample(df, 40000)
    assert 250 < got.count() < 550 and got.exceptAll(df).isEmpty()
    assert sorted(got.collect()) == sorted(dq_sample(df, 40000).collect())
