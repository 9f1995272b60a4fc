"""tidemark: incremental member analytics as plain Spark DataFrame functions.

Layers:
  sources/    driver-table adapters and the Parquet table convention
              (append batches, published snapshots, change feed, job versions)
  functions/  column expressions shared by operators and queries
  operators/  DataFrame -> DataFrame building blocks (quality, schema,
              dedup, merge, member summary, SCD2, enrichment)
  plans/      analytics queries, pipeline stages and the query registry
  streaming/  Structured Streaming form of the Landing -> Silver step
"""

__version__ = "0.1.0"
