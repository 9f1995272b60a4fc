"""Tables written in the shared folder to cut lineage, and helpers for column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import new_work_dir


class Scratch:
    """Tables of one run, in the folder that spark.checkpoint.dir names.

    ``save`` writes a DataFrame once and returns a reader of the written
    files, so that what follows never recomputes it, also after executors
    are lost. ``drop`` deletes a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self._n = spark, new_work_dir(spark, label), 0

    def save(self, df: DataFrame, name: str, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if compression:
            writer = writer.option("compression", compression)
        writer.parquet(path)
        self.release()
        out = self.spark.read.schema(df.schema).parquet(path)
        out._tidemark_path = path
        return out

    def release(self) -> None:
        """Shuffle files of what has just been written go when the driver collects its garbage; without
        a request they would stay on the executors' disks for as long as the driver has heap to spare."""
        self.spark._jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._tidemark_path)
            path.getFileSystem(conf).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def tasks(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(rows: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(hot): the keys that more than one in 4 * tasks of the rows have, so fewer than 4 * tasks of them."""
    most = rows.count() // (4 * tasks(rows.sparkSession))
    return scratch.save(rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most).select(F.col(key).alias("hot")), "hot-keys")


def lookup(rows: DataFrame, key: str, table: DataFrame, on: str, hot: DataFrame) -> DataFrame:
    """``rows`` with their row of ``table``, whose ``on`` is unique, as an inner join, where any key may
    have a large share of the rows. What ``table`` has for the keys in ``hot`` (of ``hot_keys``, so
    few by construction) goes to the rows; all other rows are shuffled by key."""
    few = table.join(F.broadcast(hot), F.col(on) == F.col("hot")).drop("hot")
    rest = rows.join(F.broadcast(hot), F.col(key) == F.col("hot"), "left_anti")
    return rows.join(F.broadcast(few), F.col(key) == F.col(on)).unionByName(rest.join(table, F.col(key) == F.col(on)))


def fingerprint(text: str = "text"):
    """A 32-byte key of a whole text; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def ranked(df: DataFrame, order: list, scratch: Scratch, name: str = "ordered", compression: str | None = None) -> DataFrame:
    """``df`` with ``_rank``, 0 upwards in the given order; equal rows rank in any order.

    A range partitioning by the order, ending in a row number so that even many equal rows are dealt
    over all tasks, then each task's sorted rows are counted on from those before it: the only thing
    that meets in one place is a count per partition.
    """
    placed = scratch.save(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(tasks(df.sparkSession), *order, F.col("_tie")).sortWithinPartitions(*order, "_tie")
        .drop("_tie").withColumn("_at", F.monotonically_increasing_id()), name, compression=compression)
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_part").alias("_p"), F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    # one row per partition written above, so at most tasks(); a shuffle would move all rows again
    return (placed.join(F.broadcast(before), part == F.col("_p"))
            .withColumn("_rank", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_p", "_before"))
