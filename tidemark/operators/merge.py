"""Keyed upsert with change capture, written as joins.

``target`` is the current state, ``source`` one row per key (already
deduplicated). A small daily source meets the target through its keys: the big
side is only semi- or anti-joined against them, so AQE turns both into broadcast
hash joins and the target is scanned without being shuffled. A source too large
for that meets the target in one full outer join, which moves each side once.
``rows_and_changes`` gives the rows and the changes of that join as one frame, so
both can be written by one pass over it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHANGE_TYPE = "_change_type"


def align(df: DataFrame, columns: list[tuple[str, object]]) -> DataFrame:
    """Project ``df`` onto (name, type) pairs; missing columns become typed NULLs."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{n}`").cast(t).alias(n) if n in have
                       else F.lit(None).cast(t).alias(n) for n, t in columns])


def union_schema(*dfs: DataFrame) -> list[tuple[str, object]]:
    """Columns of the first frame, then new columns of later ones, in order."""
    seen, out = set(), []
    for df in dfs:
        for f in df.schema.fields:
            if f.name not in seen:
                seen.add(f.name)
                out.append((f.name, f.dataType))
    return out


def _newer_or_equal(s: Column, t: Column) -> Column:
    # Struct comparison is lexicographic and orders NULL fields first, which is
    # "descending, nulls last" read as "newer": a NULL stamp is the oldest.
    return s >= t


def one_row_per_key(source: DataFrame, keys: list) -> DataFrame:
    """``source``, failing at run time if a key has several rows: which of them
    should win a merge is undefined. The count runs over the partitioning by
    key that the merge's join needs anyway."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    ok = F.assert_true(F.col("_n") == 1, F.lit(f"merge source has several rows for one key {keys}"))
    return source.withColumn("_n", n).where(ok.isNull()).drop("_n")


def _all_pairs(target: DataFrame, source: DataFrame, keys: list, names: list) -> DataFrame:
    """(_s, _t): every row of either side, next to the one of its key on the other side or null. Columns
    are put in structs after the join, so the shuffles carry a key once."""
    def side(df, letter):
        return df.select(*[F.col(f"`{n}`").alias(f"{letter}_{i}") for i, n in enumerate(names)], F.lit(True).alias(f"{letter}_in"))

    def row(letter):
        columns = [F.col(f"{letter}_{i}").alias(n) for i, n in enumerate(names)]
        return F.when(F.col(f"{letter}_in"), F.struct(*columns)).alias(f"_{letter}")

    at = [names.index(k) for k in keys]
    on = reduce(lambda a, b: a & b, [F.col(f"s_{i}") == F.col(f"t_{i}") for i in at])
    return side(source, "s").join(side(target, "t"), on, "full_outer").select(row("s"), row("t"))


def _wins(version_cols) -> Column:
    """Whether the source row of a pair (_s, _t) replaces what the target has: it is not older, and differs."""
    if version_cols:
        s_ver = F.struct(*[F.col(f"_s.`{c}`") for c in version_cols])
        t_ver = F.struct(*[F.col(f"_t.`{c}`") for c in version_cols])
        wins = F.col("_t").isNull() | _newer_or_equal(s_ver, t_ver)
    else:
        wins = F.lit(True)
    same = F.col("_t").isNotNull() & F.col("_s").eqNullSafe(F.col("_t"))
    return F.col("_s").isNotNull() & wins & ~same


def _typed(row: Column, kind: str) -> Column:
    return F.struct(F.lit(kind).alias("t"), row.alias("r"))


def _change_rows() -> list[Column]:
    """The change rows (t, r) of a pair whose source row wins; null where a pair has no such row."""
    return [F.when(F.col("_t").isNull(), _typed(F.col("_s"), "insert")),
            F.when(F.col("_t").isNotNull(), _typed(F.col("_t"), "update_preimage")),
            F.when(F.col("_t").isNotNull(), _typed(F.col("_s"), "update_postimage"))]


def rows_and_changes(target: DataFrame, source: DataFrame, keys, version_cols=None, place: str | None = None) -> DataFrame:
    """Result and changes of ``upsert_with_changes`` as one frame: rows with a null ``_change_type`` are
    the result's, the others are change rows. Either side is evaluated and shuffled once, and not
    at all where it is partitioned by the keys already.

    ``place``: column telling where a row belongs. Its values that the merge concerns are those in
    ``_from`` (of a source row) and ``_at`` (of the target's copy of a source key), arrays of one value,
    null on other rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = union_schema(target, source)
    names = [n for n, _ in cols]
    pairs = _all_pairs(align(target, cols), one_row_per_key(align(source, cols), keys), keys, names)
    pairs = pairs.withColumn("_w", _wins(version_cols))
    result = F.when(F.col("_w"), F.col("_s")).otherwise(F.col("_t"))
    out = F.array(F.struct(F.lit(None).cast("string").alias("t"), result.alias("r")), *[F.when(F.col("_w"), c) for c in _change_rows()])
    met = []
    if place is not None:
        first, matched = F.col("_c.t").isNull(), F.col("_s").isNotNull() & F.col("_t").isNotNull()
        met = [F.when(first & F.col("_s").isNotNull(), F.array(F.col(f"_s.`{place}`").cast("string"))).alias("_from"),
               F.when(first & matched, F.array(F.col(f"_t.`{place}`").cast("string"))).alias("_at")]
    return (pairs.select("_s", "_t", F.explode(out).alias("_c")).where(F.col("_c").isNotNull())
                 .select("_c.r.*", F.col("_c.t").alias(CHANGE_TYPE), *met))


def upsert_with_changes(target: DataFrame, source: DataFrame, keys,
                        version_cols=None, delete_keys: DataFrame | None = None,
                        materialize=None, by_keys: bool = True) -> tuple[DataFrame, DataFrame]:
    """MERGE (update all when matched, insert all otherwise) -> (result, changes).

    * ``version_cols``: when given, a matched source row replaces the target
      row only if its version tuple is >= the target's (a rerun of an old
      business date never overwrites a newer copy).
    * ``delete_keys``: keys to remove (emitted as ``delete`` changes).
    * New source columns are added; columns missing in the source become NULL.
    * ``changes`` has the result schema plus ``_change_type`` in
      ``insert`` / ``update_preimage`` / ``update_postimage`` / ``delete``;
      a matched row whose values do not change produces no change rows.
    * A key with several source rows is an error.
    * ``materialize``: optional callable used to stage the source-sized
      decision set once (it feeds both the result and the changes).

    ``by_keys``: the target is touched only by a semi-join (rows matching a
    source key) and an anti-join (rows without a source key) against the
    source's keys; where those are small Spark broadcasts them, and the target is
    scanned without being shuffled. Without it both sides meet in one full outer
    join, each evaluated and shuffled once; the decision set then holds the
    target's rows as well. Rows and changes are the same.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = union_schema(target, source)
    names = [n for n, _ in cols]
    tgt = align(target, cols)
    src = align(source, cols)

    src_keys = src.select(*keys)
    if by_keys:
        # target rows whose key appears in the source (bounded by the source size)
        hit = tgt.join(src_keys, keys, "left_semi")
        pairs = (one_row_per_key(src, keys).select(*keys, F.struct(*names).alias("_s"))
                    .join(hit.select(*keys, F.struct(*names).alias("_t")), keys, "left"))
    else:
        pairs = _all_pairs(tgt, one_row_per_key(src, keys), keys, names)
    decided = pairs.withColumn("_wins", _wins(version_cols))
    if materialize is not None:
        decided = materialize(decided)

    winners = decided.where("_wins")
    if by_keys:
        kept = decided.where(~F.col("_wins") & F.col("_t").isNotNull()).select("_t.*")
        result = (tgt.join(src_keys, keys, "left_anti")
                     .unionByName(winners.select("_s.*"))
                     .unionByName(kept))
    else:
        result = decided.select(F.when(F.col("_wins"), F.col("_s")).otherwise(F.col("_t")).alias("_r")).select("_r.*")

    changes = winners.select(F.explode(F.filter(F.array(*_change_rows()), lambda x: x.isNotNull())).alias("_c")).select(
        "_c.r.*", F.col("_c.t").alias(CHANGE_TYPE))

    if delete_keys is not None:
        dk = delete_keys.select(*keys).distinct()
        gone = result.join(dk, keys, "left_semi")
        result = result.join(dk, keys, "left_anti")
        changes = changes.unionByName(gone.withColumn(CHANGE_TYPE, F.lit("delete")))
    return result, changes


def upsert(target: DataFrame, source: DataFrame, keys, version_cols=None) -> DataFrame:
    """The merged rows alone. Nothing is staged here, so either side is used once only."""
    return upsert_with_changes(target, source, keys, version_cols, by_keys=False)[0]


def capture_changes(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Change rows turning ``old`` into ``new`` (full outer join on ``keys``).

    For two whole states; the pipeline emits changes from the merge instead,
    which only touches the source-sized side.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = union_schema(old, new)
    names = [n for n, _ in cols]
    o = align(old, cols).select(*keys, F.struct(*names).alias("_o"))
    n = align(new, cols).select(*keys, F.struct(*names).alias("_n"))
    j = o.join(n, keys, "full_outer").where(~F.col("_o").eqNullSafe(F.col("_n")))
    arr = F.filter(F.array(
        F.when(F.col("_o").isNull(), F.struct(F.lit("insert").alias("t"), F.col("_n").alias("r"))),
        F.when(F.col("_n").isNull(), F.struct(F.lit("delete").alias("t"), F.col("_o").alias("r"))),
        F.when(F.col("_o").isNotNull() & F.col("_n").isNotNull(),
               F.struct(F.lit("update_preimage").alias("t"), F.col("_o").alias("r"))),
        F.when(F.col("_o").isNotNull() & F.col("_n").isNotNull(),
               F.struct(F.lit("update_postimage").alias("t"), F.col("_n").alias("r")))),
        lambda x: x.isNotNull())
    return j.select(F.explode(arr).alias("_c")).select("_c.r.*",
                                                       F.col("_c.t").alias(CHANGE_TYPE))


def apply_changes(state: DataFrame, changes: DataFrame, keys) -> DataFrame:
    """Replay a change feed onto a state: drop touched keys, add post-images
    and inserts. ``apply_changes(old, capture_changes(old, new)) == new``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    touched = changes.select(*keys).distinct()
    add = (changes.where(F.col(CHANGE_TYPE).isin("insert", "update_postimage"))
                  .drop(CHANGE_TYPE))
    cols = union_schema(state, add)
    return reduce(DataFrame.unionByName,
                  [align(state.join(touched, keys, "left_anti"), cols), align(add, cols)])
