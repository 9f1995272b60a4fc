"""Upstream schema drift on the driver's own rows: columns added, removed and retyped."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidemark.operators.merge import upsert
from tidemark.operators.schema import reconcile_schema
from tidemark.sources.adapters import landing_transactions

KEY = ["transaction_id"]


@pytest.fixture(scope="module")
def landing(spark):
    """One row per transaction id, so that each drifted batch is a valid merge source."""
    df = landing_transactions(spark, SF_SMALL).dropDuplicates(KEY).orderBy("transaction_id")
    return df.limit(60).cache()


def _split(landing):
    ordered = [r["transaction_id"] for r in landing.select("transaction_id").collect()]
    first, second = ordered[:35], ordered[25:]          # ten transactions come again
    pick = lambda ids: landing.where(F.col("transaction_id").isin(ids))
    return pick(first), pick(second), first, second


def test_added_column_is_null_in_earlier_rows(landing):
    target, batch, first, second = _split(landing)
    batch = batch.withColumn("priority", F.col("points_earned") + 1)
    good, bad = reconcile_schema(batch, target.schema)
    merged = {r["transaction_id"]: r for r in upsert(target, good, KEY).collect()}
    assert bad.count() == 0 and set(merged) == set(first) | set(second)
    assert all((merged[t]["priority"] is None) == (t not in second) for t in merged)
    assert all(merged[t]["priority"] == merged[t]["points_earned"] + 1 for t in second)


def test_removed_columns_become_typed_nulls(landing):
    target, batch, first, second = _split(landing)
    good, bad = reconcile_schema(batch.drop("store_id", "amount"), target.schema)
    out = upsert(target, good, KEY)
    assert bad.count() == 0 and dict(out.dtypes) == dict(target.dtypes)
    for r in out.collect():
        if r["transaction_id"] in second:
            assert r["store_id"] is None and r["amount"] is None
        else:
            assert r["store_id"] is not None


def test_retyped_columns_cast_or_go_to_quarantine(landing):
    """Two columns arrive as text; rows fail in either, in both, or in none."""
    target, batch, *_ = _split(landing)
    number = F.regexp_extract("transaction_id", r"(\d+)_", 1).cast("int")
    text = batch.select("*", number.alias("_n")).withColumn(
        "redemption_points", F.when(F.col("_n") % 3 == 0, "many").otherwise(F.col("redemption_points").cast("string"))).withColumn(
        "transaction_date", F.when(F.col("_n") % 4 == 0, "soon").otherwise(F.col("transaction_date").cast("string")))
    failing = {r["transaction_id"]: (r["_n"] % 3 == 0, r["_n"] % 4 == 0) for r in text.collect()}
    good, bad = reconcile_schema(text.drop("_n"), target.schema)
    assert dict(good.dtypes) == dict(target.dtypes)
    quarantined = {r["transaction_id"]: r for r in bad.collect()}
    assert set(quarantined) == {t for t, f in failing.items() if any(f)}
    for t, r in quarantined.items():
        points, date = failing[t]
        assert r["quarantine_reason"] == ("cast_failed_redemption_points" if points and not date else
                                          "cast_failed_transaction_date" if date and not points else r["quarantine_reason"])
        assert r["quarantine_reason"].startswith("cast_failed_")
        assert ('"redemption_points":"many"' in r["raw_row"]) == points and ('"transaction_date":"soon"' in r["raw_row"]) == date
    assert rows(good, "transaction_id", "redemption_points") == rows(
        batch.where(~F.col("transaction_id").isin(list(quarantined))), "transaction_id", "redemption_points")


def test_drift_in_order_keeps_one_schema(landing):
    target, batch, *_ = _split(landing)
    for drifted in (batch.withColumn("note", F.lit("n")), batch.drop("channel"),
                    batch.withColumn("points_earned", F.col("points_earned").cast("string"))):
        good, bad = reconcile_schema(drifted, target.schema)
        assert bad.count() == 0
        target = upsert(target, good, KEY)
    assert target.columns == landing.columns + ["note"]
    assert target.count() == landing.count()
