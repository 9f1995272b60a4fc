"""The expectation report from counts kept per data folder.

A folder of a published table never changes, so neither do its counts. For every
folder that a table's latest version has and no earlier run saw, one pass over
that folder alone keeps what the report is made of: the counts of each row-level
expectation, and the rows per key, by ranges of the key's hash. The report of a
version adds up the counts of its folders; folders that are gone count no more.
Key uniqueness adds the keys' counts, range by range, so a key in an old and a
new folder is found without reading the old one again.

Both kinds are commits named by the table's version, the key counts before the
others. Only commits that have both are read: a run that crashed in between is
repeated as if it had never been.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import Expectation, judged, measures
from tidemark.sources.tables import TableStore, folder_id

RANGES = 16


def _names(name: str) -> tuple[str, str]:
    return f"{name}_folder_counts", f"{name}_folder_keys"


def _folders(store: TableStore, ids) -> DataFrame:
    return store.spark.createDataFrame([(i,) for i in ids], "folder string")


def refresh_states(store: TableStore, name: str, suite: list[Expectation], ranges: int = RANGES) -> list[str]:
    """Count the folders of the latest version of ``name`` that have no counts yet; returns their ids.
    A changed suite needs its counts under another table's name: counts are of the suite that made them."""
    counts, keys = _names(name)
    info = store.version_info(name)
    known = {r[0] for r in store.read_table(counts).select("folder").distinct().collect()} if store.exists(counts) else set()
    new = [p for p in info.parts if folder_id(p) not in known]
    if not new:
        return []
    rows = store.read_folders(name, new, info.partition_by)
    for e in (e for e in suite if e.kind == "unique"):
        per_key = rows.groupBy("folder", F.col(e.column).cast("string").alias("key")).agg(F.count("*").alias("n")).select(
            F.lit(e.name).alias("expectation"), F.pmod(F.xxhash64("key"), F.lit(ranges)).cast("int").alias("key_range"), "folder", "key", "n")
        store.append(per_key, keys, version=info.version, partition_by="key_range")
    row_level = [e for e in suite if e.kind != "unique"]
    # a folder without rows has counts too, so that it is known
    seen = rows.groupBy("folder").agg(*measures(row_level))
    store.append(_folders(store, [folder_id(p) for p in new]).join(seen, "folder", "left"), counts, version=info.version)
    return [folder_id(p) for p in new]


def _current(store: TableStore, name: str) -> DataFrame:
    return _folders(store, [folder_id(p) for p in store.version_info(name).parts])


def key_counts(store: TableStore, name: str, expectation: str | None = None) -> DataFrame:
    """(key, count) over the folders of the latest version, from the kept counts."""
    counts, keys = _names(name)
    kept = store.read_changes(keys, None, None, with_meta=True).where(F.col("_commit_version").isin(store.versions(counts)))
    if expectation is not None:
        kept = kept.where(F.col("expectation") == expectation)
    # the range and its keys in one shuffle; partial sums first, so a key in very many folders is a few rows
    return kept.join(_current(store, name), "folder", "left_semi").groupBy("key_range", "key").agg(F.sum("n").alias("count")).drop("key_range")


def report(store: TableStore, name: str, suite: list[Expectation]) -> DataFrame:
    """As ``expectation_report`` of the whole table, without reading it."""
    row_level = [e for e in suite if e.kind != "unique"]
    kept = store.read_table(_names(name)[0]).join(_current(store, name), "folder", "left_semi")
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for i in range(len(row_level)) for c in (f"n{i}", f"u{i}")]
    return judged(suite, kept.agg(*sums) if row_level else None, lambda e: key_counts(store, name, e.name).withColumnRenamed("key", e.column))


def duplicate_keys(store: TableStore, name: str) -> DataFrame:
    """Keys with several rows in the latest version, with their number."""
    return key_counts(store, name).where(F.col("count") > 1)
