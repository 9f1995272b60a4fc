"""Schema reconciliation of an incoming batch against the target schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CAST_REASON_PREFIX = "cast_failed_"


def reconcile_schema(df: DataFrame, target: StructType | None,
                     keep_new: bool = True) -> tuple[DataFrame, DataFrame]:
    """Align ``df`` with ``target`` in one projection -> (good, quarantine).

    * column only in the batch: kept (``keep_new``), the table gains it on merge;
    * column only in the target: typed NULL, the target schema is kept;
    * type differs: ``try_cast`` to the target type; a row whose non-NULL
      value becomes NULL goes to quarantine with reason
      ``cast_failed_<first failing column>`` and all failing columns listed.

    All casts are checked in the same pass (no per-column action). The
    quarantine keeps the raw source row as JSON, since its types may not fit
    the target.
    """
    if target is None:
        return df, df.limit(0).withColumn("quarantine_reason", F.lit(None).cast("string"))
    src_types = {f.name: f.dataType for f in df.schema.fields}
    target_names = [f.name for f in target.fields]
    exprs, fails = [], []
    for f in target.fields:
        if f.name not in src_types:
            exprs.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif src_types[f.name] == f.dataType:
            exprs.append(F.col(f"`{f.name}`"))
        else:
            casted = F.col(f"`{f.name}`").try_cast(f.dataType)
            exprs.append(casted.alias(f.name))
            fails.append(F.when(F.col(f"`{f.name}`").isNotNull() & casted.isNull(),
                                F.lit(f.name)))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in target_names] if keep_new else []
    failed = (F.filter(F.array(*fails), lambda x: x.isNotNull()) if fails
              else F.array().cast("array<string>"))
    src = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    out = df.select(*exprs, *extra, failed.alias("_failed_cols"), src.alias("_src"))
    good = out.where(F.size("_failed_cols") == 0).drop("_failed_cols", "_src")
    bad = (out.where(F.size("_failed_cols") > 0)
              .withColumn("quarantine_reason",
                          F.concat(F.lit(CAST_REASON_PREFIX),
                                   F.try_element_at("_failed_cols", F.lit(1))))
              .withColumn("raw_row", F.to_json("_src"))
              .withColumnRenamed("_failed_cols", "failed_rules")
              .drop("_src"))
    return good, bad


def schema_diff(df: DataFrame, target: StructType) -> dict:
    """Names of added, missing and retyped columns (for logging/tests)."""
    src = {f.name: f.dataType for f in df.schema.fields}
    tgt = {f.name: f.dataType for f in target.fields}
    return {"added": [c for c in src if c not in tgt],
            "missing": [c for c in tgt if c not in src],
            "retyped": [c for c in tgt if c in src and src[c] != tgt[c]]}
