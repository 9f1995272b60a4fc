"""Exact top-k search by block-at-a-time pruning.

Vectors are quantised to integers, whose components are the terms. Every
shard orders its vectors by recursive bisection and cuts that order into ranges,
the blocks; a block keeps the minimum and maximum of each term and, as its
forward index, its vectors. For a query the sum over terms of the larger of
q*min and q*max bounds every score in a block. A query goes through blocks by
falling bound and stops at the first bound below its k-th score.

Two rounds share the k-th scores between shards: the first scores one best
block per shard, so that the second starts from a threshold which holds over the
whole table. Batches of queries meet shards of blocks (both of bounded size)
in tasks of their own; no side is broadcast or collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stage import Scratch

BLOCK = 128
SHARD = 16_384
BATCH = 2_048


def quantise(vectors: DataFrame, vec_id: str, vector: str, scale: int = 256) -> DataFrame:
    """(vec_id, q, dim): floor(scale * x) of every component, x as double. Vectors that are null or
    hold a null or non-finite component are left out."""
    v = F.col(vector).cast("array<double>")
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
        .select("vec_id", F.transform("v", lambda x: F.floor(x * scale)).alias("q"), F.size("v").alias("dim")))


def _order(x: np.ndarray) -> np.ndarray:
    """An order in which neighbours are alike: halve at the median of the widest term, again and again."""
    order, todo = np.arange(len(x)), [(0, len(x))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= BLOCK:
            continue
        part = order[lo:hi]
        widest = int(np.argmax(x[part].astype(np.float64).var(axis=0)))
        part = part[np.argsort(x[part, widest], kind="stable")]
        order[lo:hi] = part
        mid = lo + max(BLOCK, (hi - lo) // 2 // BLOCK * BLOCK)
        todo += [(lo, mid), (mid, hi)]
    return order


def _matrix(t: pa.Table, name: str = "q") -> np.ndarray:
    flat = t[name].combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)


def build_blocks(t: pa.Table) -> pa.Table:
    """Blocks of one shard: term minima and maxima, ids and the forward index."""
    x = _matrix(t).astype(np.int64)
    ids, rows = t["vec_id"].to_numpy(), t["row"].to_numpy()
    order = _order(x) if x.shape[1] else np.arange(len(x))
    out = {"block": [], "low": [], "high": [], "ids": [], "rows": [], "forward": []}
    for b, lo in enumerate(range(0, len(order), BLOCK)):
        part = order[lo:lo + BLOCK]
        y = x[part]
        for key, value in (("block", b), ("low", y.min(axis=0).tobytes()), ("high", y.max(axis=0).tobytes()),
                           ("ids", ids[part].tobytes()), ("rows", rows[part].tobytes()), ("forward", y.tobytes())):
            out[key].append(value)
    n = len(out["block"])
    return pa.table({"dim": pa.array([x.shape[1]] * n, pa.int32()), "shard": pa.array([t["shard"][0].as_py()] * n, pa.int64()),
                     "block": pa.array(out["block"], pa.int32()), **{k: pa.array(out[k], pa.binary()) for k in ("low", "high", "ids", "rows", "forward")}})


_BLOCKS = "dim int, shard long, block int, low binary, high binary, ids binary, rows binary, forward binary"


class _Shard:
    def __init__(self, t: pa.Table):
        t = t.sort_by("block")
        read = lambda c: [np.frombuffer(b, np.int64) for b in t[c].to_pylist()]
        self.low, self.high = np.array(read("low")), np.array(read("high"))
        self.ids, self.rows = read("ids"), read("rows")
        dim = self.low.shape[1]
        self.forward = [f.reshape(len(i), dim) for f, i in zip(read("forward"), self.ids)]

    def exact_type(self, q: np.ndarray):
        """float64 where every product and sum of these integers is exact in it, else int64."""
        most = float(max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0))) * float(np.abs(q).max(initial=0))
        return np.float64 if most * max(1, q.shape[1]) < 2.0 ** 52 else np.int64

    def search(self, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int, first_only: bool):
        """(score, id, row) arrays [query, k] of the best candidates with a score of at least floor;
        unused places have row -1. Also the number of blocks scored."""
        kind = self.exact_type(q)
        q = q.astype(kind)
        low, high = self.low.astype(kind), self.high.astype(kind)
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        order = np.argsort(-bounds, axis=1, kind="stable")
        none = np.iinfo(np.int64).min
        score = np.full((len(q), k), none, np.int64)
        ids, rows = np.full((len(q), k), np.iinfo(np.int64).max), np.full((len(q), k), -1, np.int64)
        kth, scored = floor.astype(np.int64).copy(), 0
        active = np.arange(len(q))
        for step in range(1 if first_only else order.shape[1]):
            active = active[bounds[active, order[active, step]] >= kth[active]]
            if not len(active):
                break
            block_of = order[active, step]
            by_block = np.argsort(block_of, kind="stable")
            cuts = np.flatnonzero(np.diff(block_of[by_block])) + 1
            for group in np.split(active[by_block], cuts):
                b = int(order[group[0], step])
                scored += len(group)
                s = (q[group] @ self.forward[b].astype(kind).T).astype(np.int64)
                valid = (self.rows[b][None, :] != own[group][:, None]) & (s >= kth[group][:, None])
                hit = np.flatnonzero(valid.any(axis=1))
                if not len(hit):
                    continue
                g = group[hit]
                s = np.where(valid[hit], s[hit], none)
                all_s = np.concatenate((score[g], s), axis=1)
                all_i = np.concatenate((ids[g], np.where(valid[hit], self.ids[b], np.iinfo(np.int64).max)), axis=1)
                all_r = np.concatenate((rows[g], np.where(valid[hit], self.rows[b], -1)), axis=1)
                best = np.lexsort((all_r, all_i, -all_s.astype(np.float64) if kind is np.float64 else ~all_s), axis=1)[:, :k]
                score[g], ids[g], rows[g] = (np.take_along_axis(a, best, 1) for a in (all_s, all_i, all_r))
                full = rows[g, -1] >= 0
                kth[g] = np.where(full, np.maximum(kth[g], score[g, -1]), kth[g])
        return score, ids, rows, scored


def _search(k: int, first_only: bool):
    def run(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("query_row", "query_id", "vec_id", "row", "score")})
        if not queries.num_rows or not blocks.num_rows:
            return empty
        own, ids = queries["row"].to_numpy(), queries["vec_id"].to_numpy()
        floor = queries["floor"].to_numpy()
        score, found, rows, _ = _Shard(blocks).search(_matrix(queries).astype(np.int64), own, floor, k, first_only)
        at = np.nonzero(rows >= 0)
        return pa.table({"query_row": pa.array(own[at[0]]), "query_id": pa.array(ids[at[0]]), "vec_id": pa.array(found[at]),
                         "row": pa.array(rows[at]), "score": pa.array(score[at])})
    return run


def top_k(vectors: DataFrame, is_query, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5,
          shard_rows: int = SHARD, batch_rows: int = BATCH) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` (a condition on the column
    vec_id) holds, the k other rows with the highest integer inner products, all if there are fewer;
    ties go to the smaller vec_id.

    A row is its own candidate never, an equal row with the same id is one. Vectors that are null or
    hold null or non-finite components take no part; vectors are compared with those of their length
    only; a vector of no components scores 0 with others of its kind. A null id is sorted as the
    smallest and is no query. Empty table: no rows. Other columns are ignored. Scores must fit 64 bits.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    low = -(1 << 63)
    base = scratch.save(quantise(vectors, vec_id, vector).withColumn("vec_id", F.coalesce("vec_id", F.lit(low)))
                        .withColumn("row", F.monotonically_increasing_id()), "vectors")
    n = base.count()
    n_shards, n_batches = -(-n // shard_rows) or 1, -(-base.where(is_query).count() // batch_rows) or 1
    spread = lambda m: F.pmod(F.xxhash64("row"), F.lit(m))
    index = scratch.save(base.withColumn("shard", spread(n_shards)).groupBy("dim", "shard").applyInArrow(build_blocks, _BLOCKS), "blocks")
    wanted = base.where(is_query & (F.col("vec_id") != low)).withColumn("batch", F.pmod(F.xxhash64("row", F.lit(7)), F.lit(n_batches)))
    found = "query_row long, query_id long, vec_id long, row long, score long"

    def against(queries: DataFrame, first_only: bool) -> DataFrame:
        """Every batch of queries against every shard of blocks, as (batch, shard) tasks."""
        q = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))).withColumn("shard", F.col("shard").cast("long"))
        b = index.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(n_batches - 1)))).withColumn("batch", F.col("batch").cast("long"))
        return q.groupBy("dim", "batch", "shard").cogroup(b.groupBy("dim", "batch", "shard")).applyInArrow(_search(k, first_only), found)

    first = against(wanted.withColumn("floor", F.lit(low)), True)
    kth = first.groupBy("query_row").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select(
        "query_row", F.when(F.size("s") >= k, F.element_at("s", k)).alias("floor"))
    second = against(wanted.join(kth, wanted["row"] == kth["query_row"], "left").drop("query_row")
                     .withColumn("floor", F.coalesce("floor", F.lit(low))), False)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return (second.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("vec_id") != low, F.col("vec_id")).alias("vec_id"), "score"))
