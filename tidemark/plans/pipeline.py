"""The five incremental stages and the pipeline that chains them.

Landing -> Bronze -> Silver -> (gate) -> Gold -> tier history. Each stage
reads what is new since the version it last processed, writes its output,
and only then saves the processed version, so a failed run is simply rerun.
``as_of`` (the processing date) and ``run_ts`` are arguments: a run is
reproducible. Stages talk only through tables under one root folder.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import filter_dates
from tidemark.functions.exprs import DEFAULT_TIERS, month_of
from tidemark.operators.dedup import TRANSACTION_TIEBREAK, ingest_order, latest_per_key
from tidemark.operators.quality import default_suite, expectation_report, gate, split_rules
from tidemark.operators.schema import reconcile_schema
from tidemark.operators.scd2 import apply_tier_changes, init_history
from tidemark.operators.summary import (affected_keys, member_rollup, summary_from_rollup,
                                        vanished_keys)
from tidemark.sources.tables import TableStore

LANDING, BRONZE, SILVER, QUARANTINE = "landing", "bronze", "silver", "silver_quarantine"
GOLD, HISTORY, GATE = "gold_member_summary", "member_tier_history", "dq_report"
GOLD_PARTITION = "current_tier"
ROLLUP, JOB_ROLLUP = "member_month_rollup", "member_month_rollup"
JOB_BRONZE, JOB_SILVER, JOB_GOLD, JOB_HISTORY, JOB_GATE = (
    "bronze_ingestion", "silver_transactions", "gold_member_summary", "member_tier_history",
    "dq_gate")
ALL_CHANGES = ("insert", "update_preimage", "update_postimage", "delete")
# Version tuple of a Silver row: newest load first, then the landing batch,
# then the business columns (a total order on distinct rows).
SILVER_VERSION = ("ingested_at", "batch_id") + TRANSACTION_TIEBREAK


# SQL names of the published tables (for ``TableStore.register_views``)
SQL_VIEWS = {"silver_transactions": SILVER, "silver_transactions_quarantine": QUARANTINE,
             "gold_member_summary": GOLD, "gold_member_tier_history": HISTORY,
             "dq_report": GATE, "member_month_rollup": ROLLUP, "job_versions": "job_versions"}


@dataclass
class Config:
    tiers: tuple = DEFAULT_TIERS
    amount_range: tuple = (5.0, 2000.0)
    min_rows: int = 100
    suite: list | None = None
    gold_cluster_by: tuple = ("member_id",)
    extra: dict = field(default_factory=dict)

    def expectations(self):
        return self.suite or default_suite(self.amount_range, self.min_rows)


def _result(stage: str, status: str, **kw) -> dict:
    return {"stage": stage, "status": status, **kw}


def _ts(run_ts) -> dt.datetime:
    return run_ts if isinstance(run_ts, dt.datetime) else dt.datetime.fromisoformat(str(run_ts))


def load_landing(store: TableStore, delivery: DataFrame) -> int:
    """Publish one upstream delivery into Landing as its next commit, whatever
    business dates its rows have; returns the commit number."""
    return store.append(delivery, LANDING)[0]


def run_bronze(store: TableStore, run_ts, upto: int | None = None, by_month: bool = False) -> dict:
    """Landing commits after the last ingested one (all on first run), stamped
    with ``ingested_at``, appended as one Bronze load partitioned by day.

    A load is published under the number of the last Landing commit in it, so
    Bronze itself tells what has been ingested: a run that crashed after the
    append, before the job version was saved, is completed and not repeated.
    ``by_month`` makes the partitions months instead of days, for loads that
    span years of days with a few rows each.
    """
    current = store.current_version(LANDING)
    if current is None:
        return _result("bronze", "skipped", reason="no landing data")
    if upto is not None:
        current = min(current, upto)
    saved, loaded = store.get_last_version(JOB_BRONZE), store.current_version(BRONZE)
    last = max((v for v in (saved, loaded) if v is not None), default=None)
    if loaded is not None and (saved is None or saved < loaded):
        store.save_version(JOB_BRONZE, loaded)
    if last is not None and last >= current:
        return _result("bronze", "skipped", reason="no new landing commits")
    batch = store.read_batches(LANDING, after=last, upto=current)
    batch = (batch.withColumn("ingested_at", F.lit(_ts(run_ts)).cast("timestamp"))
                  .withColumn("load_id", F.lit(int(current))))
    if by_month:
        batch = batch.withColumn("transaction_month", month_of(F.col("transaction_date")))
    _, rows = store.append(batch, BRONZE, version=current,
                           partition_by="transaction_month" if by_month else "transaction_date")
    store.save_version(JOB_BRONZE, current)
    return _result("bronze", "ok", rows=rows, load_id=current, landing_version=current)


def silver_batch(batch: DataFrame, target_schema, run_ts) -> tuple[DataFrame, DataFrame]:
    """reconcile -> row rules -> latest per transaction -> month column.

    Returns (deduplicated rows for the merge, rows for quarantine). Casting
    comes first so rules see target types and a bad newer copy cannot hide a
    good older one.
    """
    batch = batch.drop("load_id", "transaction_month")
    good, cast_bad = reconcile_schema(batch, target_schema)
    clean, dq_bad = split_rules(good, quarantine_ts=_ts(run_ts))
    latest = latest_per_key(clean, "transaction_id", ingest_order(clean))
    latest = latest.withColumn("transaction_month", month_of(F.col("transaction_date")))
    qcols = ["transaction_id", "member_id", "transaction_date", "amount", "batch_id",
             "quarantine_reason", "failed_rules", "raw_row"]
    dq_q = (dq_bad.withColumn("raw_row", F.to_json(F.struct(*[F.col(f"`{c}`") for c in
                                                             good.columns])))
                  .select(*qcols))
    cast_q = cast_bad.select(*[c if c in cast_bad.columns else F.lit(None).alias(c)
                               for c in qcols])
    quarantine = dq_q.unionByName(cast_q, allowMissingColumns=True).withColumn(
        "quarantine_ts", F.lit(_ts(run_ts)).cast("timestamp"))
    return latest, quarantine


def bronze_day(store: TableStore, day) -> DataFrame:
    """Bronze rows of one business date, from loads of either layout: only the
    folders of that day, or of its month in loads made ``by_month``, are read."""
    def of_day(rows, partition_by):
        return filter_dates(rows, day, day, month_col=partition_by if partition_by == "transaction_month" else None)
    return store.read_batches(BRONZE, where=of_day)


def run_silver(store: TableStore, run_ts, rerun_date=None) -> dict:
    last = store.get_last_version(JOB_SILVER)
    current = store.current_version(BRONZE)
    if current is None:
        return _result("silver", "skipped", reason="no bronze data")
    if rerun_date is not None:
        batch = bronze_day(store, rerun_date)
    elif last is not None and last >= current:
        return _result("silver", "skipped", reason="no new bronze loads")
    else:
        batch = store.read_batches(BRONZE, after=last, upto=current)
    target_schema = None
    if store.exists(SILVER):
        target_schema = store.read_table(SILVER).drop("transaction_month").schema
    latest, quarantine = silver_batch(batch, target_schema, run_ts)
    # a batch that is large next to Silver goes into the merge as it is, which computes it once
    at_once = store.merges_at_once(SILVER, batch.count())
    if not at_once:
        latest = store.stage(latest, "silver-batch")      # computed once
    # one quarantine commit per Bronze version, and one per rerun day (under
    # the negative of its date): a retry replaces it
    load = current if rerun_date is None else -int(str(rerun_date).replace("-", ""))
    store.append(quarantine.withColumn("load_id", F.lit(load)), QUARANTINE, version=load)
    version = store.merge(latest, SILVER, ["transaction_id"], version_cols=SILVER_VERSION,
                          partition_by="transaction_month", at_once=at_once)
    if rerun_date is None:
        store.save_version(JOB_SILVER, current)
    store.clear_staged()
    return _result("silver", "ok", silver_version=version, bronze_version=current)


def run_gate(store: TableStore, cfg: Config | None = None) -> dict:
    """Expectations on the whole latest Silver; raises on a critical failure.

    Every expectation scans the whole table: the row-level ones in one
    aggregate pass (no sampling, no shuffle), key uniqueness in one grouped
    pass with map-side counts.
    """
    cfg = cfg or Config()
    silver = store.read_table(SILVER)
    version = store.current_version(SILVER)
    report = store.stage(expectation_report(silver, cfg.expectations()), "dq-report")
    store.publish(report.withColumn("silver_version", F.lit(version)), GATE,
                  operation="VALIDATE")
    failed = gate(report)   # raises GateFailed: Gold is not computed
    store.save_version(JOB_GATE, version)
    store.clear_staged()
    return _result("gate", "ok", warnings=[r["expectation"] for r in failed])


def refresh_rollup(store: TableStore) -> dict:
    """Bring the member x month x channel rollup up to the latest Silver.

    First time: one aggregation over Silver. Afterwards only the months the
    Silver merges rewrote since the last refresh are read (partition-pruned)
    and re-aggregated; every other month folder is carried over.
    """
    last = store.get_last_version(JOB_ROLLUP)
    current = store.current_version(SILVER)
    months = None if last is None or not store.exists(ROLLUP) else \
        store.touched_partitions(SILVER, last, current)
    if last is not None and store.exists(ROLLUP) and last >= current:
        return _result("rollup", "skipped")
    # about two (month, bucket) pairs for each task of a shuffle
    read = months if months is not None else store.partition_values(SILVER)
    buckets = max(1, round(2 * int(store.spark.conf.get("spark.sql.shuffle.partitions")) / max(1, len(read))))
    if months is None:
        rollup = member_rollup(store.read_table(SILVER), buckets=buckets)
        # the aggregation's tasks have few months each and write them as they are
        version = store.create(rollup, ROLLUP, partition_by="transaction_month", spread=False,
                               operation="CREATE" if not store.exists(ROLLUP) else "REBUILD")
        mode = "full"
    else:
        fresh = member_rollup(store.read_table(SILVER, partitions=months), buckets=buckets)
        version = store.replace_partitions(fresh, ROLLUP, "transaction_month", months, spread=False)
        mode = f"{len(months)} months"
    store.save_version(JOB_ROLLUP, current)
    return _result("rollup", "ok", mode=mode, rollup_version=version)


def run_gold(store: TableStore, as_of, run_ts, cfg: Config | None = None,
             rerun_date=None) -> dict:
    """Member summary: full on first run, else only for affected members.

    Affected members are rebuilt from the rollup (member-month grain), not
    from their transaction history, so a daily run reads the Silver months it
    changed plus the rollup rows of the affected members.
    """
    cfg = cfg or Config()
    last = store.get_last_version(JOB_GOLD)
    current = store.current_version(SILVER)
    cluster = list(cfg.gold_cluster_by) or None
    if rerun_date is None and last is not None and store.exists(GOLD) and last >= current:
        return _result("gold", "skipped", reason="no new silver versions")
    refresh_rollup(store)
    rollup = store.read_table(ROLLUP)
    if rerun_date is not None:
        # the month of the day prunes Silver's partitions
        keys = store.stage(filter_dates(store.read_table(SILVER), rerun_date, rerun_date)
                           .select("member_id").distinct(), "gold-keys")
    elif last is None or not store.exists(GOLD):
        full = summary_from_rollup(rollup, as_of, cfg.tiers, _ts(run_ts))
        version = store.create(full, GOLD, partition_by=GOLD_PARTITION, cluster_by=cluster)
        store.save_version(JOB_GOLD, current)
        store.clear_staged()
        return _result("gold", "ok", mode="full", gold_version=version)
    else:
        changes = store.read_changes(SILVER, last, current, ALL_CHANGES)
        keys = store.stage(affected_keys(changes), "gold-keys")
    scoped = rollup.join(keys, "member_id", "left_semi")
    fresh = store.stage(summary_from_rollup(scoped, as_of, cfg.tiers, _ts(run_ts)),
                        "gold-fresh")
    gone = vanished_keys(keys, fresh)
    version = store.merge(fresh, GOLD, ["member_id"], delete_keys=gone,
                          partition_by=GOLD_PARTITION, cluster_by=cluster)
    if rerun_date is None:
        store.save_version(JOB_GOLD, current)
    store.clear_staged()
    return _result("gold", "ok", mode="incremental", gold_version=version)


def run_history(store: TableStore, as_of) -> dict:
    """SCD2 step. The history is partitioned by ``is_current``: closed periods
    never change again, so a run reads and rewrites only the open periods
    (member-sized) and adds one folder with the periods it closed; earlier
    closed folders are referenced as they are."""
    last = store.get_last_version(JOB_HISTORY)
    current = store.current_version(GOLD)
    if last is not None and store.exists(HISTORY) and last >= current:
        return _result("history", "skipped", reason="no new gold versions")
    gold = store.read_table(GOLD).select("member_id", "current_tier")
    if not store.exists(HISTORY):
        version = store.create(init_history(gold, as_of), HISTORY, partition_by="is_current")
        store.save_version(JOB_HISTORY, current)
        return _result("history", "ok", mode="init", history_version=version)
    open_rows = store.read_table(HISTORY, partitions=["true"])
    new_rows, changes = apply_tier_changes(open_rows, gold, as_of)
    staged = store.stage(new_rows, "history")
    staged_changes = store.stage(changes, "history-changes")
    version = store.publish_partitions(staged, HISTORY, "is_current", replace=["true"],
                                       changes=staged_changes, operation="SCD2")
    store.save_version(JOB_HISTORY, current)
    store.clear_staged()
    return _result("history", "ok", mode="apply", history_version=version)


def run_pipeline(store: TableStore, as_of, run_ts, cfg: Config | None = None,
                 landing_upto: int | None = None, rerun_date=None,
                 bronze_by_month: bool = False) -> list[dict]:
    """bronze -> silver -> gate -> gold -> history; stops at the first failure."""
    cfg = cfg or Config()
    out = []
    if rerun_date is None:
        out.append(run_bronze(store, run_ts, upto=landing_upto, by_month=bronze_by_month))
    out.append(run_silver(store, run_ts, rerun_date))
    out.append(run_gate(store, cfg))
    out.append(run_gold(store, as_of, run_ts, cfg, rerun_date))
    out.append(run_history(store, as_of))
    return out
