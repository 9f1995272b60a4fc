"""How well a table's files are clustered by a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def clustering_depth(table: DataFrame, partition: str, key: str) -> DataFrame:
    """(partition, n_rows, n_files, depth): the most files of a partition whose key ranges hold one and
    the same key, which is how many a lookup of that key has to open. ``table`` is read from files;
    their ranges (least and greatest key) come from one aggregation by file. Starts and ends of
    ranges are then counted in key order: one row per file and end, not per row."""
    files = table.select(F.col(partition).alias("partition"), F.col(key).alias("key"), F.col("_metadata.file_path").alias("file")).groupBy(
        "partition", "file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"))
    ends = F.explode(F.array(F.struct(F.col("low").alias("at"), F.lit(0).alias("end"), F.lit(1).alias("step")),
                             F.struct(F.col("high").alias("at"), F.lit(1).alias("end"), F.lit(-1).alias("step"))))
    # a range that ends at a key holds it as well: starts come before ends there
    opened = F.sum("e.step").over(Window.partitionBy("partition").orderBy("e.at", "e.end").rowsBetween(Window.unboundedPreceding, 0))
    return files.select("partition", "n", ends.alias("e")).withColumn("open", opened).groupBy("partition").agg(
        F.sum(F.when(F.col("e.end") == 0, F.col("n"))).alias("n_rows"), F.count_if(F.col("e.end") == 0).alias("n_files"),
        F.max("open").alias("depth")).withColumnRenamed("partition", partition)
