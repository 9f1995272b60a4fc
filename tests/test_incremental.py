"""Signed deltas, counts per folder, sketches, samples by key and clustering depth."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.clustering import clustering_depth
from tidemark.operators.deltas import STATE_COLUMNS, apply_deltas, member_state, signed_deltas, summary_from_state
from tidemark.operators.merge import CHANGE_TYPE, capture_changes
from tidemark.operators.quality import default_suite, duplicate_keys, expectation_report, sample_by_key
from tidemark.operators.sketches import ERROR, monthly_sketches, periods
from tidemark.operators.summary import member_summary
from tidemark.plans import gold_deltas, quality_states
from tidemark.plans import pipeline as pl
from tidemark.sources.tables import folder_values

AS_OF, TS = dt.date(2025, 1, 1), dt.datetime(2025, 1, 1)
SCHEMA = ("transaction_id string, member_id string, transaction_date date, amount decimal(10,2), points_earned int, "
          "redemption_points int, channel string, transaction_month string")
TIERS = (("platinum", 300), ("gold", 150), ("silver", 60))


def txns(seed, n, members=12):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.integers(0, 90)))
        out.append((f"t{i}", f"m{rng.integers(0, members)}", day, float(rng.integers(1, 5000)) / 100, int(rng.integers(0, 50)) if i % 5 else None,
                    int(rng.integers(0, 9)) if i % 3 else None, [None, "POS", "app"][rng.integers(0, 3)], f"{day:%Y-%m}"))
    return out


def frame(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(*r[:3], Decimal(str(r[3])), *r[4:]) for r in rows], SCHEMA)


def same(a, b):
    rows = lambda d: sorted(map(str, d.select(*sorted(d.columns)).collect()))
    assert rows(a) == rows(b)


def history(spark):
    """Three states of transactions: some change member, date, channel or amount, some go, some come."""
    first = txns(1, 160)
    second = [r for i, r in enumerate(first) if i % 7] + [(f"new{i}", *r[1:]) for i, r in enumerate(txns(2, 30, 14))]
    moved = txns(3, 200)
    second = [(r[0], *moved[i][1:]) if i % 4 == 0 else r for i, r in enumerate(second)]
    # a member that only the second state has, one that the second loses, a first day that goes and comes
    second += [("solo", "only in b", dt.date(2020, 1, 1), 5.0, 1, 1, "POS", "2020-01"), ("early", "m1", dt.date(2019, 1, 1), 5.0, 1, 1, "POS", "2019-01")]
    third = [r for r in second if r[1] != "m2" and r[0] not in ("solo", "early")] + [("late", "m3", dt.date(2026, 1, 1), 9.0, 1, 1, None, "2026-01")]
    return [frame(spark, rows) for rows in (first, second, third)]


def test_deltas_equal_a_recompute(spark, store):
    a, b, c = (store.stage(x, "state") for x in history(spark))
    stage = lambda df: store.stage(df, "s")
    # one feed of two changes: what comes with the first and goes with the second must leave no trace
    feed = capture_changes(a, b, "transaction_id").unionByName(capture_changes(b, c, "transaction_id"))
    for old, new, changes in ((a, b, capture_changes(a, b, "transaction_id")), (a, c, feed), (a, a.limit(0), capture_changes(a, a.limit(0), "transaction_id"))):
        state = stage(member_state(old))
        changed, gone = apply_deltas(state, stage(signed_deltas(changes)), new, stage)
        keys = ["member_id", "channel_key"]
        result = state.join(changed.select(*keys).unionByName(gone), keys, "left_anti").select(*STATE_COLUMNS).unionByName(changed)
        same(result, member_state(new))
        same(summary_from_state(result, AS_OF, TIERS, TS), member_summary(new, AS_OF, TIERS, TS))


def test_bounds_are_rederived_only_where_a_stored_bound_went(spark, store):
    old = frame(spark, [("a", "x", dt.date(2024, 1, 1), 1.0, 1, 1, "POS", "2024-01"), ("b", "x", dt.date(2024, 1, 5), 1.0, 1, 1, "POS", "2024-01"),
                        ("c", "x", dt.date(2024, 1, 9), 1.0, 1, 1, "POS", "2024-01"), ("d", "y", dt.date(2024, 1, 1), 1.0, 1, 1, "POS", "2024-01")])
    stage = lambda df: store.stage(df, "s")
    nothing = old.limit(0)
    # amounts change and a middle day goes: no transaction has to be read, so an empty table does
    new = old.where("transaction_id <> 'b'").withColumn("amount", (F.col("amount") + 1).cast("decimal(10,2)"))
    changed, _ = apply_deltas(stage(member_state(old)), stage(signed_deltas(capture_changes(old, new, "transaction_id"))), nothing, stage)
    same(changed, member_state(new))
    changed, gone = apply_deltas(stage(member_state(old)), stage(signed_deltas(capture_changes(old, old.where("transaction_id <> 'a'"), "transaction_id"))), nothing, stage)
    assert changed.count() == 0 and gone.count() == 0      # x's first day went: only transactions can tell the next


def test_gold_by_deltas_and_its_folders(spark, store):
    a, b, c = history(spark)
    cfg = pl.Config(tiers=TIERS)
    run = lambda: gold_deltas.run_gold_by_deltas(store, AS_OF, TS, cfg, buckets=4)
    store.create(a, pl.SILVER, partition_by="transaction_month")
    assert run()["mode"] == "full"
    same(store.read_table(gold_deltas.GOLD), member_summary(a, AS_OF, TIERS, TS))
    gone = lambda x, y: x.join(y, "transaction_id", "left_anti").select("transaction_id")
    store.merge(b, pl.SILVER, ["transaction_id"], partition_by="transaction_month", delete_keys=gone(a, b))
    store.merge(c, pl.SILVER, ["transaction_id"], partition_by="transaction_month", delete_keys=gone(b, c))
    gold_deltas.refresh_state(store, store, store.current_version(pl.SILVER))     # a run that crashed here ...
    assert run()["mode"] == "skipped"                                             # ... applies nothing twice
    same(store.read_table(gold_deltas.GOLD), member_summary(c, AS_OF, TIERS, TS))
    assert run()["status"] == "skipped"
    # one member changes its tier: its old and its new folder are rewritten, no other
    before = store.version_info(gold_deltas.GOLD)
    one = store.read_table(gold_deltas.GOLD).where("current_tier = 'bronze'").orderBy("member_id").first().member_id
    rich = frame(spark, [("rich", one, dt.date(2024, 2, 2), 9999.0, 1, 1, "POS", "2024-02")])
    store.merge(rich, pl.SILVER, ["transaction_id"], partition_by="transaction_month")
    run()
    same(store.read_table(gold_deltas.GOLD), member_summary(c.unionByName(rich), AS_OF, TIERS, TS))
    replaced = {folder_values(p) for p in set(before.parts) - set(store.version_info(gold_deltas.GOLD).parts)}
    assert len({b for _, b in replaced}) == 1 and {t for t, _ in replaced} <= {"bronze", "platinum"} and ("bronze", replaced.copy().pop()[1]) in replaced


def landing(spark, rows):
    return frame(spark, rows).withColumn("tier", F.lit("gold"))


def test_counts_per_folder(spark, store):
    suite = default_suite()
    parts = [txns(5, 80), txns(6, 120), [(f"t{i}", None, *r[2:]) for i, r in enumerate(txns(7, 40))]]
    for i, rows in enumerate(parts):
        store.publish_partitions(landing(spark, rows), "l", "transaction_month")
        if i == 1:
            # a run that crashed between its two commits: keys without counts are not read, then replaced
            append = store.append
            store.append = lambda df, name, **k: (_ for _ in ()).throw(RuntimeError("crash")) if name.endswith("counts") else append(df, name, **k)
            with pytest.raises(RuntimeError):
                quality_states.refresh_states(store, "l", suite)
            store.append = append
            store.publish_partitions(landing(spark, rows[:5]), "l", "transaction_month")
        new = quality_states.refresh_states(store, "l", suite)
        assert new and quality_states.refresh_states(store, "l", suite) == []
        whole = store.read_table("l")
        same(quality_states.report(store, "l", suite), expectation_report(whole, suite))
        same(quality_states.duplicate_keys(store, "l"), duplicate_keys(whole, "transaction_id").withColumnRenamed("transaction_id", "key"))
    n = len(store.version_info("l").parts)
    assert len(new) < n
    # a folder that is replaced counts no more
    month = parts[0][0][7]
    store.replace_partitions(landing(spark, [r for r in parts[0] if r[7] == month][:2]), "l", "transaction_month", [month])
    assert len(quality_states.refresh_states(store, "l", suite)) == 1
    same(quality_states.report(store, "l", suite), expectation_report(store.read_table("l"), suite))


def test_sample_depends_on_keys_alone(spark):
    df = spark.range(60000).selectExpr("concat('k', id) k", "id AS _upto")
    got = sample_by_key(df, "k")
    assert 450 < got.count() < 750 and got.columns == df.columns
    same(got, sample_by_key(df.repartition(7, "_upto").orderBy("_upto", ascending=False), "k"))
    assert sample_by_key(df, "k", cap_rows=60).count() < 110
    assert sample_by_key(df.limit(0), "k").count() == 0 and sample_by_key(df.selectExpr("CAST(NULL AS STRING) k", "_upto"), "k").count() == 0
    assert sample_by_key(df, "k", seed=1).exceptAll(got).count() > 300


def test_sketches_merge(spark):
    rows = spark.range(40000).selectExpr("concat('2024-', lpad(1 + id % 12, 2, '0')) transaction_month", "concat('m', id % 9973) member_id")
    stored = monthly_sketches(rows.unionAll(rows.selectExpr("transaction_month", "CAST(NULL AS STRING)")))
    got = {r.period: r.estimate for r in periods(stored).collect()}
    assert set(got) == {f"2024-{m:02d}" for m in range(1, 13)} | {f"2024-Q{q}" for q in range(1, 5)} | {"2024"}
    for period, exact in (("2024", 9973), ("2024-Q1", len({i % 9973 for i in range(40000) if i % 12 < 3})), ("2024-05", len({i % 9973 for i in range(40000) if i % 12 == 4}))):
        assert abs(got[period] - exact) <= ERROR * exact


def test_depth_tells_clustering(spark, store):
    rows = spark.range(1000).selectExpr("concat('m', lpad((id * 7919) % 1000, 4, '0')) member_id", "IF(id % 3 = 0, 'gold', 'silver') tier").repartition(8)
    store.create(rows, "plain", partition_by="tier", rows_per_file=50)
    store.create(rows, "clustered", partition_by="tier", cluster_by=["member_id"], rows_per_file=50)
    depth = lambda t: {r.tier: (r.n_rows, r.depth) for r in clustering_depth(store.read_table(t), "tier", "member_id").collect()}
    assert depth("clustered") == {"gold": (334, 1), "silver": (666, 1)}
    assert depth("plain")["silver"][1] > 5
