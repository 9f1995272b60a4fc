"""Table convention on plain Parquet (no table format jar needed).

Layout below one root folder (a shared file system path on a cluster):

  <root>/<name>/tm_commit=<n>-<attempt>/[<part>=<value>/]... append-only table, commit n
  <root>/<name>/tm_version=<n>-<attempt>/<part>=<value>/[tm_bucket=<b>/]... keyed table, files of version n
  <root>/<name>/_changes/version=<n>-<attempt>/...          change feed rows of version n, or
  <root>/<name>/tm_version=<n>-<attempt>-feed/<part>=<value>/... of a merge that wrote both at once
  <root>/_log/table_name=<name>/version=<n>/   one row per published version:
        operation, row metrics, and the data folders making up the version

Every write goes to a folder of its own attempt, and only folders that a log
row names are ever read: what a crashed attempt left behind belongs to no
version, and the retry writes elsewhere. A version exists once its log row is
written (last). A log that can't be read is an error, never an empty store. A
keyed version lists its data folders, so a merge rewrites only the partitions
it touches and keeps referring to the untouched folders of older versions.
Partitions are told apart by value, not by folder name (Spark escapes names). A
bucketed table has folders by hash of the key below its partitions: a key's copy
can only be in its bucket, whichever partition holds it, so a merge looks for
old copies in the buckets of its source's keys and rewrites (partition, bucket)
folders, whose number follows the batch and not the table.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import CHANGE_TYPE, rows_and_changes, union_schema, upsert_with_changes
from tidemark.session import delete_path, find_folders, path_exists

LOG = "_log"
CHANGES = "_changes"
VERSION_DIR = "tm_version"   # folder key of a keyed version; dropped on read
COMMIT_DIR = "tm_commit"     # folder key of an append-only commit
BUCKET = "tm_bucket"         # folder key of a hash bucket; not a column of the table
JOB_VERSIONS = "job_versions"
#: Rows of a merge's source up to which its keys are taken to be broadcast; a larger one meets the
#: target in one full outer join (see ``upsert_with_changes``).
SMALL_SOURCE = 100_000
#: Of such sources, one of at least a row per so many of the target's is merged at once (see ``merges_at_once``).
ROWS_PER_SOURCE_ROW = 8
CODEC = "zstd"               # of all data files

LOG_SCHEMA = T.StructType([
    T.StructField("operation", T.StringType()),
    T.StructField("kind", T.StringType()),              # append | keyed
    T.StructField("partition_by", T.StringType()),
    T.StructField("parts", T.ArrayType(T.StringType())),  # data folders of the version
    T.StructField("feed_parts", T.ArrayType(T.StringType())),  # folders of the feed
    T.StructField("has_feed", T.BooleanType()),         # feed_parts hold change rows; else inserts
    T.StructField("rows_written", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("rows_deleted", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("schema_json", T.StringType()),
    T.StructField("feed_schema_json", T.StringType()),
    T.StructField("touched", T.ArrayType(T.StringType())),  # partition values rewritten
    T.StructField("state", T.MapType(T.StringType(), T.LongType())),  # control state
    T.StructField("bucket_by", T.ArrayType(T.StringType())),  # key columns that the buckets hash
    T.StructField("buckets", T.LongType()),
])


def as_value(value) -> str | None:
    """A partition value as folders have it: Spark writes null and an empty text alike, and reads both
    as null."""
    if isinstance(value, bool):
        return str(value).lower()
    return None if value is None or str(value) == "" else str(value)


def folder_values(folder: str) -> tuple[str | None, ...]:
    """The partition value (and bucket) of a data folder, from its path below its version's folder."""
    names = folder.rsplit(f"/{VERSION_DIR}=", 1)[1].split("/")[1:]
    values = [x.split("=", 1)[1] for x in names]
    return tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for v in values)


def folder_id(folder: str) -> str:
    """A short name of a data folder: the attempt that wrote it, its partition value and bucket."""
    attempt = folder.rsplit(f"/{VERSION_DIR}=", 1)[1].split("/")[0]
    return "|".join([attempt, *[v or "" for v in folder_values(folder)]])


def bucket_of(columns, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(int(buckets)).cast("long"))


@dataclass
class VersionInfo:
    version: int
    operation: str
    kind: str
    partition_by: str | None
    parts: list
    feed_parts: list
    has_feed: bool
    schema_json: str | None = None
    bucket_by: list | None = None
    buckets: int | None = None
    state: dict | None = None

    def of_partitions(self, values) -> list:
        """The folders of these partition values."""
        wanted = {as_value(v) for v in values}
        return [p for p in self.parts if folder_values(p)[0] in wanted]

    @property
    def layout(self) -> dict:
        return {"partition_by": self.partition_by, "bucket_by": self.bucket_by, "buckets": self.buckets}


class TableStore:
    def __init__(self, spark: SparkSession, root: str, clock=None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._clock = clock or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self._log_cache: dict[str, list[dict]] = {}
        self._staged: list[str] = []

    # ---- paths and log ------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _log_path(self) -> str:
        return f"{self.root}/{LOG}"

    def log_path(self, name: str) -> str:
        """Folder of one table's log rows."""
        return f"{self._log_path()}/table_name={name}"

    def _write_log(self, name: str, version: int, info: dict) -> None:
        self._write_log_rows([(name, version, info)])

    def _write_log_rows(self, entries: list) -> None:
        """Publish versions: one small job, one folder per (table, version).

        Dynamic partition overwrite makes a retried publication idempotent.
        """
        schema = T.StructType(LOG_SCHEMA.fields + [
            T.StructField("table_name", T.StringType()), T.StructField("version", T.LongType())])
        now = self._clock()
        rows = []
        for name, version, info in entries:
            row = {f.name: info.get(f.name) for f in LOG_SCHEMA.fields}
            row["committed_at"] = row["committed_at"] or now
            row["table_name"], row["version"] = name, int(version)
            rows.append(row)
        (self.spark.createDataFrame(rows, schema).repartition(1).write
             .mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("table_name", "version").parquet(self._log_path()))
        for r in rows:
            if r["table_name"] in self._log_cache:
                kept = [x for x in self._log_cache[r["table_name"]] if x["version"] != r["version"]]
                self._log_cache[r["table_name"]] = kept + [r]

    def _log_schema(self) -> T.StructType:
        return T.StructType(LOG_SCHEMA.fields + [T.StructField("table_name", T.StringType()),
                                                 T.StructField("version", T.LongType())])

    def log(self) -> DataFrame:
        """The version log as a DataFrame (one row per published version)."""
        if not path_exists(self.spark, self._log_path()):
            return self.spark.createDataFrame([], self._log_schema())
        return self.spark.read.schema(self._log_schema()).parquet(self._log_path())

    def refresh(self) -> None:
        """Forget cached state (another process may have published)."""
        self._log_cache = {}

    def _entries(self, name: str) -> list[dict]:
        # One table's log holds one small row per version; it is read once per
        # store and then kept in step with this store's own publications. Only
        # a log folder that doesn't exist means "nothing published"; any
        # failure to read one is raised.
        if name not in self._log_cache:
            rows = self.log().where(F.col("table_name") == name).collect()
            self._log_cache[name] = [r.asDict() for r in rows]
        return self._log_cache[name]

    def current_version(self, name: str) -> int | None:
        vs = [int(r["version"]) for r in self._entries(name)]
        return max(vs) if vs else None

    def versions(self, name: str) -> list[int]:
        return sorted(int(r["version"]) for r in self._entries(name))

    def version_info(self, name: str, version: int | None = None) -> VersionInfo | None:
        if version is None:
            version = self.current_version(name)
            if version is None:
                return None
        rows = [r for r in self._entries(name) if int(r["version"]) == int(version)]
        if not rows:
            return None
        r = rows[0]
        return VersionInfo(int(r["version"]), r["operation"], r["kind"], r["partition_by"],
                           list(r["parts"] or []), list(r["feed_parts"] or []),
                           bool(r["has_feed"]), r["schema_json"], r["bucket_by"], r["buckets"], r["state"])

    def exists(self, name: str) -> bool:
        return self.current_version(name) is not None

    # ---- append-only tables -------------------------------------------------
    def append(self, df: DataFrame, name: str, version: int | None = None,
               partition_by: str | None = None, operation: str = "APPEND",
               spread: bool = True) -> tuple[int, int]:
        """Append ``df`` as one commit; returns (version, rows).

        Commits are numbered in the order of their publication, whatever the
        rows hold, so a reader of "what is new" never misses a late or a
        repeated delivery. With an explicit ``version`` (a consumer that names
        its commits after what it consumed) publishing the same version again
        replaces that commit. Without ``spread`` rows stay in the tasks they are in, each
        writing a file per partition value: for rows whose tasks hold few values each, as the driver keeps a
        record of every file.
        """
        if version is None:
            version = (self.current_version(name) or 0) + 1
        folder = f"{self.path(name)}/{COMMIT_DIR}={version}-{uuid.uuid4().hex[:10]}"
        obs = Observation(f"append_{uuid.uuid4().hex[:10]}")
        # optimized write: few files per partition value; AQE splits a value
        # that holds a large share of the rows and merges small ones
        out = df.hint("rebalance", partition_by) if partition_by and spread else df
        writer = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", CODEC)
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
        rows = int(obs.get.get("rows", 0))
        self._write_log(name, version, {"operation": operation, "kind": "append",
                                        "partition_by": partition_by, "parts": [folder],
                                        "feed_parts": [], "has_feed": False,
                                        "schema_json": df.schema.json(),
                                        "rows_written": rows, "rows_inserted": rows,
                                        "rows_updated": 0, "rows_deleted": 0})
        return version, rows

    def read_batches(self, name: str, after: int | None = None,
                     upto: int | None = None, where=None) -> DataFrame:
        """Rows of the published commits in (after, upto].

        Commits of one schema and partition column are one scan, with that
        schema passed to the reader (no inference); additive differences
        between commits are reconciled by a union by name. ``where`` (rows,
        partition column) -> rows is applied to each scan before the union, so
        a filter can use the partition column that its commits do have.
        """
        return self._read_commits(name, after, upto, where).drop(COMMIT_DIR)

    def _read_commits(self, name: str, after: int | None, upto: int | None,
                      where=None) -> DataFrame:
        infos = [r for r in self._entries(name) if (after is None or r["version"] > after)
                 and (upto is None or r["version"] <= upto)]
        if not self._entries(name):
            raise FileNotFoundError(f"table {name} has no published commit")
        by_layout: dict[tuple, list] = {}
        for r in sorted(infos, key=lambda r: r["version"]):
            by_layout.setdefault((r["schema_json"], r["partition_by"]), []).extend(r["parts"])
        if not by_layout:
            schema = T.StructType.fromJson(json.loads(self.version_info(name).schema_json))
            return self.spark.createDataFrame([], schema).withColumn(COMMIT_DIR, F.lit(""))
        out = None
        for (schema_json, partition_by), parts in by_layout.items():
            schema = T.StructType.fromJson(json.loads(schema_json))
            df = (self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*parts)
                      .select(*schema.fieldNames(), F.col(COMMIT_DIR).cast("string")))
            df = df if where is None else where(df, partition_by)
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out

    def versions_of(self, name: str, parts: list) -> list[int]:
        """The commits that these folders belong to, in order."""
        wanted = set(parts)
        return sorted(int(r["version"]) for r in self._entries(name) if wanted & set(r["parts"]))

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """Materialise ``df`` once under the root and read it back.

        Cuts the lineage (an executor loss replays from these files, not from
        the source) and lets several actions share one computation.
        """
        folder = f"{self.root}/_staging/{label}-{uuid.uuid4().hex[:10]}"
        df.write.option("compression", CODEC).parquet(folder)
        self._staged.append(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def clear_staged(self) -> None:
        """Remove the staged copies of this store object, once what was made from
        them is published."""
        for folder in self._staged:
            delete_path(self.spark, folder)
        self._staged = []

    # ---- keyed tables -------------------------------------------------------
    def _vdir(self, name: str, version: int) -> str:
        """A new folder for one attempt to write ``version``."""
        return f"{self.path(name)}/{VERSION_DIR}={version}-{uuid.uuid4().hex[:10]}"

    def read_table(self, name: str, version: int | None = None,
                   partitions: list | None = None) -> DataFrame:
        """Snapshot of a table at ``version`` (default: latest published).

        ``partitions`` restricts the read to those partition values by
        choosing folders from the version's list (no listing of others).
        """
        info = self.version_info(name, version)
        if info is None:
            raise FileNotFoundError(f"table {name} has no published version")
        if info.kind == "state":
            return self.spark.createDataFrame(
                sorted(self._state(name, info.version).items()),
                "job_name string, last_processed_version long")
        if info.kind == "append":
            upto = info.version
            return self.read_batches(name, None, upto)
        parts = info.parts
        if partitions is not None and info.partition_by:
            parts = info.of_partitions(partitions)
        return self._read_parts(name, parts, info.partition_by, info.schema_json)

    def _read_parts(self, name: str, parts: list, partition_by: str | None,
                    schema_json: str | None = None) -> DataFrame:
        """Read the listed folders with the schema recorded at publication.

        Passing the schema skips footer-based inference (no extra job) and
        keeps partition column types fixed; folders written before a column
        was added read it as NULL.
        """
        if schema_json is None:
            schema_json = self.version_info(name).schema_json
        schema = T.StructType.fromJson(json.loads(schema_json)) if schema_json else None
        if not parts:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", self.path(name))
        reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
        out = reader.parquet(*parts).drop(VERSION_DIR)
        return out.select(*schema.fieldNames()) if schema is not None else out

    def _write_version(self, df: DataFrame, name: str, version: int,
                       partition_by: str | None, cluster_by: list | None,
                       bucket_by: list | None = None, buckets: int | None = None,
                       rows_per_file: int | None = None, spread: bool = True) -> tuple[list, int]:
        out = df.withColumn(BUCKET, bucket_of(bucket_by, buckets)) if bucket_by else df
        folders = ([partition_by] if partition_by else []) + ([BUCKET] if bucket_by else [])
        if cluster_by:
            # clustering inside the partitions: a range sort co-locates keys,
            # so Parquet min/max statistics skip files for key lookups. Staged
            # first, as choosing the ranges evaluates the input once more.
            order = folders + list(cluster_by)
            out = self.stage(out, f"{name}-cluster").repartitionByRange(*order).sortWithinPartitions(*order)
        elif folders and spread:
            # optimized write: rows of one partition value go to few tasks
            # (AQE splits an oversized value and merges small ones), so a
            # version adds a few files per partition instead of one per task.
            out = out.hint("rebalance", *folders)
        obs = Observation(f"write_{uuid.uuid4().hex[:10]}")
        writer = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", CODEC)
        vdir = self._vdir(name, version)
        if folders:
            writer = writer.partitionBy(*folders)
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        writer.parquet(vdir)
        rows = int(obs.get.get("rows", 0))
        if not folders:
            return [vdir], rows
        # one listing of this attempt's own folder: one name per partition value and bucket
        return find_folders(self.spark, vdir, len(folders)), rows

    def create(self, df: DataFrame, name: str, partition_by: str | None = None,
               cluster_by: list | None = None, version: int | None = None,
               operation: str = "CREATE", bucket_by: list | None = None, buckets: int | None = None,
               consumed: dict | None = None, rows_per_file: int | None = None, spread: bool = True) -> int:
        """Write a whole new snapshot as the next version (insert feed = data). ``spread`` is as in
        ``append``. ``bucket_by`` names
        the key columns (all or some of a later merge's keys) whose hash deals rows to ``buckets``
        folders below each partition. ``consumed`` (table -> version) is published with the version, so
        that what went into it and its rows can't disagree after a crash."""
        if version is None:
            cur = self.current_version(name)
            version = 1 if cur is None else cur + 1
        parts, rows = self._write_version(df, name, version, partition_by, cluster_by, bucket_by, buckets, rows_per_file, spread)
        self._write_log(name, version, {"operation": operation, "kind": "keyed",
                                        "partition_by": partition_by, "parts": parts,
                                        "feed_parts": parts, "has_feed": False,
                                        "schema_json": df.schema.json(),
                                        "bucket_by": bucket_by, "buckets": buckets, "state": consumed,
                                        "touched": self._values(parts) if partition_by else None,
                                        "rows_written": rows, "rows_inserted": rows,
                                        "rows_updated": 0, "rows_deleted": 0})
        return version

    @staticmethod
    def _values(parts, more=()) -> list:
        """The different partition values of folders, and ``more`` of them, null first."""
        found = {folder_values(p)[0] for p in parts} | {as_value(v) for v in more}
        return sorted(found, key=lambda v: (v is not None, v or ""))

    def publish(self, df: DataFrame, name: str, changes: DataFrame | None = None,
                partition_by: str | None = None, cluster_by: list | None = None,
                operation: str = "WRITE") -> int:
        """Write a full new snapshot with an explicit change feed."""
        cur = self.current_version(name)
        version = 1 if cur is None else cur + 1
        parts, rows = self._write_version(df, name, version, partition_by, cluster_by)
        metrics = (self._write_changes(name, version, changes) if changes is not None
                   else {"feed_parts": parts, "has_feed": False})
        self._write_log(name, version, {"operation": operation, "kind": "keyed",
                                        "partition_by": partition_by, "parts": parts,
                                        "schema_json": df.schema.json(),
                                        "rows_written": rows, **metrics})
        return version

    def _write_changes(self, name: str, version: int, changes: DataFrame) -> dict:
        obs = Observation(f"changes_{uuid.uuid4().hex[:10]}")
        ct = F.col(CHANGE_TYPE)
        folder = f"{self.path(name)}/{CHANGES}/version={version}-{uuid.uuid4().hex[:10]}"
        (changes.observe(obs,
                         F.count_if(ct == "insert").alias("rows_inserted"),
                         F.count_if(ct == "update_postimage").alias("rows_updated"),
                         F.count_if(ct == "delete").alias("rows_deleted"))
                .write.option("compression", CODEC).parquet(folder))
        got = obs.get
        return {"feed_parts": [folder], "has_feed": True, "feed_schema_json": changes.schema.json(),
                **{k: int(got.get(k, 0) or 0) for k in ("rows_inserted", "rows_updated", "rows_deleted")}}

    def merge(self, source: DataFrame, name: str, keys, version_cols=None,
              partition_by: str | None = None, delete_keys: DataFrame | None = None,
              cluster_by: list | None = None, operation: str = "MERGE", consumed: dict | None = None,
              at_once: bool = False) -> int:
        """Keyed upsert of ``source`` into the latest version of ``name``.

        With ``partition_by`` only the partitions holding a source row or the
        current copy of a source key or of a key in ``delete_keys`` are read
        and rewritten; the new version refers to every other partition folder
        of the previous version. Of a bucketed table (see ``create``, whose
        buckets later versions keep) this holds for folders of one bucket of a
        partition, and current copies are looked for in the buckets of the
        source's and deleted keys only. Creates the table when it does not exist yet.
        ``consumed`` is as in ``create``. ``source`` is read several times (its rows are counted first, to
        choose the join), so it should be staged. ``at_once`` (see ``merges_at_once``; for a table in
        partitions) reads it once instead.
        """
        keys = [keys] if isinstance(keys, str) else list(keys)
        info = self.version_info(name)
        if info is None:
            return self.create(source, name, partition_by, cluster_by, operation="CREATE", consumed=consumed)
        if at_once:
            if not partition_by or info.bucket_by or cluster_by or delete_keys is not None:
                raise ValueError("only an upsert into a table in partitions alone can be merged at once")
            return self._merge_at_once(info, name, source, keys, version_cols, partition_by, operation, consumed)
        version = info.version + 1
        bucket_by, buckets = info.bucket_by, info.buckets
        if partition_by or bucket_by:
            touched = self.touched_folders(info, name, source, keys, delete_keys, partition_by)
            keep = [p for p in info.parts if folder_values(p) not in touched]
            target = self._read_parts(name, [p for p in info.parts if folder_values(p) in touched],
                                      partition_by, info.schema_json)
        else:
            touched = None
            keep, target = [], self._read_parts(name, info.parts, None, info.schema_json)
        result, changes = upsert_with_changes(
            target, source, keys, version_cols, delete_keys,
            materialize=lambda df: self.stage(df, f"{name}-merge"), by_keys=source.count() <= SMALL_SOURCE)
        parts, rows = self._write_version(result, name, version, partition_by, cluster_by, bucket_by, buckets)
        metrics = self._write_changes(name, version, changes)
        self._write_log(name, version, {"operation": operation, "kind": "keyed",
                                        "partition_by": partition_by, "bucket_by": bucket_by, "buckets": buckets, "state": consumed,
                                        "parts": sorted(keep + parts),
                                        "schema_json": result.schema.json(),
                                        "touched": self._values([], [t[0] for t in touched]) if partition_by else None,
                                        "rows_written": rows, **metrics})
        return version

    def merges_at_once(self, name: str, rows: int) -> bool:
        """Whether a source of ``rows`` rows should be merged at once: it is large, also next to the table,
        so that most partitions concern it and looking them up first would not pay. Rows of a table
        are counted from its files' footers."""
        if rows <= SMALL_SOURCE:
            return False
        return not self.exists(name) or rows * ROWS_PER_SOURCE_ROW >= self.read_table(name).count()

    def _merge_at_once(self, info: VersionInfo, name: str, source: DataFrame, keys: list, version_cols,
                       partition_by: str, operation: str, consumed: dict | None) -> int:
        """A merge by one job: the whole table and the source meet in one join, whose rows and changes are
        laid out by partition value and written. Source and table are evaluated once, nothing is staged. Without the
        layout every task of the join would write a file per value, and as many would be listed by the driver in
        each later read. The version consists of the folders that the merge concerns, as
        in ``merge``; what was written of others is removed again, and the folders of before stay."""
        version = info.version + 1
        target = self._read_parts(name, info.parts, partition_by, info.schema_json)
        schema = T.StructType([T.StructField(n, t) for n, t in union_schema(target, source)])
        rows = rows_and_changes(target, source, keys, version_cols, place=partition_by)
        vdir, obs = self._vdir(name, version), Observation(f"merge_{uuid.uuid4().hex[:10]}")
        attempt, kind = vdir.rsplit("=", 1)[1], F.col(CHANGE_TYPE)
        (rows.observe(obs, F.count_if(kind.isNull()).alias("rows_written"), F.count_if(kind == "insert").alias("rows_inserted"),
                      F.count_if(kind == "update_postimage").alias("rows_updated"), F.count_if(kind.isNotNull()).alias("changes"),
                      # at most one value per folder
                      F.to_json(F.collect_set("_from")).alias("from"), F.to_json(F.collect_set("_at")).alias("at"))
             .drop("_from", "_at")
             .withColumn(VERSION_DIR, F.when(kind.isNull(), F.lit(attempt)).otherwise(F.lit(f"{attempt}-feed")))
             .hint("rebalance", VERSION_DIR, partition_by)
             .write.mode("append").option("compression", CODEC).partitionBy(VERSION_DIR, partition_by).parquet(self.path(name)))
        got = obs.get
        touched = {as_value(v[0]) for found in ("from", "at") for v in json.loads(got.get(found) or "[]")}
        written = find_folders(self.spark, vdir, 1)
        parts = [p for p in written if folder_values(p)[0] in touched]
        keep = [p for p in info.parts if folder_values(p)[0] not in touched]
        n_rows = int(got.get("rows_written", 0))
        if len(parts) < len(written):
            n_rows = self._read_parts(name, parts, partition_by, schema.json()).count()
            for folder in set(written) - set(parts):
                delete_path(self.spark, folder)
        feed_schema = T.StructType(schema.fields + [T.StructField(CHANGE_TYPE, T.StringType())])
        self._write_log(name, version, {"operation": operation, "kind": "keyed", "partition_by": partition_by, "state": consumed,
                                        "parts": sorted(keep + parts), "schema_json": schema.json(),
                                        "feed_parts": [f"{vdir}-feed"] if got.get("changes") else [], "has_feed": True,
                                        "feed_schema_json": feed_schema.json(), "touched": self._values([], touched),
                                        "rows_written": n_rows, "rows_inserted": int(got.get("rows_inserted", 0)),
                                        "rows_updated": int(got.get("rows_updated", 0)), "rows_deleted": 0})
        return version

    def touched_folders(self, info: VersionInfo, name: str, source: DataFrame, keys: list,
                        delete_keys: DataFrame | None = None, partition_by: str | None = None) -> set:
        """(value, bucket) of the folders that a merge of ``source`` concerns: where its rows belong, and
        where current copies of its keys or of deleted keys are. Of the table only key and partition
        columns are read, of a bucketed one only in the buckets of these keys. What is collected is at
        most one row per folder."""
        looked_up = source.select(*keys)
        if delete_keys is not None:
            looked_up = looked_up.unionByName(delete_keys.select(*keys))
        place = [F.col(f"`{partition_by}`").cast("string").alias("value")] if partition_by else []
        parts = info.parts
        if info.bucket_by:
            bucket = bucket_of(info.bucket_by, info.buckets).cast("string").alias("bucket")
            place = [*place, bucket]
            hashed = {r[0] for r in looked_up.select(bucket).distinct().collect()}
            parts = [p for p in parts if folder_values(p)[-1] in hashed]
        current = self._read_parts(name, parts, partition_by, info.schema_json)
        of_current = current.select(*dict.fromkeys([*keys, *([partition_by] if partition_by else [])])).join(looked_up, keys, "left_semi")
        rows = source.select(*place).union(of_current.select(*place)).distinct().collect()
        return {tuple(as_value(v) for v in r) for r in rows}

    def read_folders(self, name: str, parts: list, partition_by: str | None) -> DataFrame:
        """Rows of these data folders, with ``folder_id`` of the one that holds a row as ``folder``."""
        schema = T.StructType.fromJson(json.loads(self.version_info(name).schema_json))
        below = [F.col(c).cast("string") for c in ([partition_by] if partition_by else []) + ([BUCKET] if self.version_info(name).bucket_by else [])]
        rows = self.spark.read.option("basePath", self.path(name)).schema(schema).parquet(*parts)
        place = F.concat_ws("|", F.col(VERSION_DIR).cast("string"), *[F.coalesce(c, F.lit("")) for c in below])
        return rows.select(*schema.fieldNames(), place.alias("folder"))

    def read_for_keys(self, name: str, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The rows of a bucketed table that can have one of ``keys`` (its columns are those the buckets
        hash): a read of their buckets' folders. At most one row per bucket is collected."""
        info = self.version_info(name, version)
        bucket = bucket_of(info.bucket_by, info.buckets).cast("string")
        hashed = {r[0] for r in keys.select(bucket).distinct().collect()}
        return self._read_parts(name, [p for p in info.parts if folder_values(p)[-1] in hashed], info.partition_by, info.schema_json)

    def replace_partitions(self, df: DataFrame, name: str, partition_by: str, values,
                           operation: str = "REPLACE_PARTITIONS", spread: bool = True) -> int:
        """New version where the partitions ``values`` hold exactly ``df``'s rows
        (``df`` must only contain those values); every other partition folder of
        the previous version is referenced as is. A value without rows in
        ``df`` disappears. ``spread`` is as in ``append``."""
        info = self.version_info(name)
        if info is None:
            return self.create(df, name, partition_by, operation="CREATE", spread=spread)
        version = info.version + 1
        replaced = set(info.of_partitions(values))
        keep = [p for p in info.parts if p not in replaced]
        parts, rows = self._write_version(df, name, version, partition_by, None, info.bucket_by, info.buckets, spread=spread)
        self._write_log(name, version, {"operation": operation, "kind": "keyed", **info.layout,
                                        "parts": sorted(keep + parts), "feed_parts": parts,
                                        "has_feed": False, "schema_json": df.schema.json(),
                                        "touched": self._values([], values),
                                        "rows_written": rows, "rows_inserted": rows,
                                        "rows_updated": 0, "rows_deleted": 0})
        return version

    def publish_partitions(self, df: DataFrame, name: str, partition_by: str,
                           replace=(), changes: DataFrame | None = None,
                           operation: str = "WRITE_PARTITIONS") -> int:
        """New version from ``df`` (partitioned by ``partition_by``).

        Partition values in ``replace`` are replaced by ``df``'s rows; for any
        other value ``df``'s rows are added next to the folders the previous
        version already has (append). Only ``df`` is written.
        """
        info = self.version_info(name)
        if info is None:
            return self.create(df, name, partition_by)
        version = info.version + 1
        replaced = set(info.of_partitions(replace))
        keep = [p for p in info.parts if p not in replaced]
        parts, rows = self._write_version(df, name, version, partition_by, None, info.bucket_by, info.buckets)
        metrics = (self._write_changes(name, version, changes) if changes is not None
                   else {"feed_parts": parts, "has_feed": False})
        self._write_log(name, version, {"operation": operation, "kind": "keyed", **info.layout,
                                        "parts": sorted(keep + parts),
                                        "schema_json": df.schema.json(),
                                        "touched": self._values(parts, replace),
                                        "rows_written": rows, **metrics})
        return version

    def partition_values(self, name: str) -> list:
        """The partition values that the latest version has folders of."""
        return self._values(self.version_info(name).parts)

    def touched_partitions(self, name: str, after: int | None, upto: int | None) -> list | None:
        """Partition values rewritten by versions in (after, upto]; None when a
        version in the range did not record them (treat as: all)."""
        out = set()
        for r in self._entries(name):
            v = r["version"]
            if (after is None or v > after) and (upto is None or v <= upto):
                if r.get("touched") is None:
                    return None
                out.update(r["touched"])
        return self._values([], out)

    # ---- change feed ----------------------------------------------------------
    def read_changes(self, name: str, after: int | None, upto: int | None = None,
                     change_types=("insert",), with_meta: bool = False) -> DataFrame:
        """Change rows of versions in (after, upto], filtered by change type.

        Append-only tables and whole-snapshot versions expose their data as
        ``insert`` rows; merges expose the rows of their ``_changes`` folder.
        """
        types = list(change_types)
        info = self.version_info(name)
        if info is None:
            raise FileNotFoundError(f"table {name} has no published version")
        if info.kind == "append":
            # append-only: the feed of (after, upto] is the commits in range
            if "insert" not in types:
                raise FileNotFoundError(f"{name} is append-only: only inserts")
            if not with_meta:
                return self.read_batches(name, after, upto)
            commit = F.regexp_extract(COMMIT_DIR, r"^(-?\d+)-", 1).cast("int")
            return (self._read_commits(name, after, upto).withColumn("_commit_version", commit)
                        .withColumn(CHANGE_TYPE, F.lit("insert")).drop(COMMIT_DIR))
        infos = [r for r in self._entries(name)
                 if (after is None or r["version"] > after) and (upto is None or r["version"] <= upto)]
        frames = []
        for r in infos:
            if r["has_feed"]:
                schema = T.StructType.fromJson(json.loads(r["feed_schema_json"]))
                if not r["feed_parts"]:         # a merge that changed nothing
                    frames.append(self.spark.createDataFrame([], schema).withColumn("_commit_version", F.lit(int(r["version"]))))
                    continue
                frames.append(self.spark.read.schema(schema).parquet(*r["feed_parts"]).select(*schema.fieldNames())
                              .where(F.col(CHANGE_TYPE).isin(types))
                              .withColumn("_commit_version", F.lit(int(r["version"]))))
        if "insert" in types:
            for r in infos:
                if r["feed_parts"] and not r["has_feed"]:
                    # whole-snapshot versions: their data files are the inserts
                    part_df = self._read_parts(name, list(r["feed_parts"]), r["partition_by"],
                                               r["schema_json"])
                    frames.append(part_df.withColumn(CHANGE_TYPE, F.lit("insert"))
                                  .withColumn("_commit_version", F.lit(int(r["version"]))))
        if not frames:
            raise FileNotFoundError(f"no changes for {name} in ({after}, {upto}]")
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out if with_meta else out.drop(CHANGE_TYPE, "_commit_version")

    # ---- job versions (control table) ---------------------------------------
    def _state(self, name: str, version: int) -> dict:
        rows = [r for r in self._entries(name) if int(r["version"]) == int(version)]
        return dict(rows[0]["state"] or {}) if rows else {}

    def job_versions(self) -> dict:
        """job_name -> last processed version (bounded: one entry per job)."""
        v = self.current_version(JOB_VERSIONS)
        return {} if v is None else {k: int(x) for k, x in self._state(JOB_VERSIONS, v).items()}

    def get_last_version(self, job: str) -> int | None:
        """None means: no state (first run or lost control table) -> full load."""
        return self.job_versions().get(job)

    def save_version(self, job: str, version: int) -> int:
        """Record the job's processed-up-to version; call only after the write.

        The whole control table is one small map stored in a new version-log
        row: saving is a single atomic publication.
        """
        state = self.job_versions()
        state[job] = int(version)
        v = (self.current_version(JOB_VERSIONS) or 0) + 1
        self._write_log(JOB_VERSIONS, v, {"operation": "SAVE_VERSION", "kind": "state",
                                          "parts": [], "feed_parts": [], "has_feed": False,
                                          "state": state, "rows_written": len(state)})
        return v

    def register_views(self, views: dict) -> list[str]:
        """Temp views (view name -> table) over the latest published versions,
        so analysts' SQL text runs unchanged with ``spark.sql``."""
        done = []
        for view, table in views.items():
            if self.exists(table):
                self.read_table(table).createOrReplaceTempView(view)
                done.append(view)
        return done

    def run_log(self, name: str | None = None, limit: int = 10) -> DataFrame:
        """Most recent published versions with their row metrics (top-k)."""
        log = self.log()
        if name is not None:
            log = log.where(F.col("table_name") == name)
        return (log.select("table_name", "version", "operation", "rows_written",
                           "rows_inserted", "rows_updated", "rows_deleted", "committed_at")
                   .orderBy(F.col("version").desc(), F.col("table_name"))
                   .limit(limit))
