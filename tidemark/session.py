"""SparkSession construction and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tidemark job relies on. Shuffle partitions are sized for the
# local test machine; on a cluster pass a larger value (AQE coalesces small
# partitions and splits skewed ones at runtime either way).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A union of two hash-partitioned inputs that AQE coalesced to different
    # partition counts fails when Union keeps its children's partitioning
    # ("Can't zip RDDs with unequal numbers of partitions"); keep it off.
    "spark.sql.unionOutputPartitioning": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Runtime SQL settings the library relies on; applied to any session handed
# to a registered query (the caller may have built the session itself).
RUNTIME_CONF = ("spark.sql.adaptive.enabled", "spark.sql.session.timeZone",
                "spark.sql.sources.partitionOverwriteMode", "spark.sql.unionOutputPartitioning")


def configure(spark: SparkSession) -> SparkSession:
    for k in RUNTIME_CONF:
        if spark.conf.get(k, None) != BASE_CONF[k]:
            spark.conf.set(k, BASE_CONF[k])
    return spark


def get_spark(app: str = "tidemark", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system location and is
    used as is. Only where it is unset on a local master (tests) a private
    folder under the local temp dir is created and registered; a cluster
    without the setting is an error, as executors would not share the folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/tidemark/{label}-{uuid.uuid4().hex[:12]}"


# ---- the file system that a path belongs to (local, HDFS, object store) ------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, size, modification time) of the entries of one folder."""
    fs, p = _fs(spark, path)
    return sorted((x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in fs.listStatus(p))


def find_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Paths of the partition folders ``depth`` levels below ``path``, in one listing."""
    fs, _ = _fs(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path + "/*=*" * depth))
    return sorted(f"{path}/" + "/".join(x.getPath().toString().rsplit("/", depth)[1:]) for x in found)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
