"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of every source form a stream of equal blocks. Sources get whole
blocks as seats: seat k of a source with target t has the quotient
t / (2k + 1), and the highest quotients win. A source's seats go to bands of its
shards, and a band's to its shards, by the same rule. Within a shard, blocks are taken in a seeded order until the
shard's words are reached; the last block is cut to size, which settles what
remains below one block.

Everything that is per document stays in Spark: one pass counts words, one
aggregation sums them by (source, shard), one task per bounded shard places
its documents on the shard's stream. A source has as many shards as its words
and documents need, so a hot source is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import kernel
from tidemark.llm.stage import Scratch

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK_WORDS = 64
SHARD_WORDS = 1_000_000
SHARD_DOCS = 20_000
BAND_SHARDS = 4096


def count_words(docs: DataFrame, text: str = "text", out: str = "size") -> DataFrame:
    """Add ``out``: the number of words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0)."""
    fields = [f for f in docs.schema.fields if f.name != text]
    names = [f.name for f in fields]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [kernel.sums(np.ones(len(w.starts), np.int64), w.bounds)
                 for c in kernel.chunks(b.column(len(names))) for w in [kernel.words(c)]]
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(n, pa.int64())], [*names, out])

    schema = docs.select(*names).withColumn(out, F.lit(0).cast("long")).schema
    return docs.select(*names, text).mapInArrow(count, schema)


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray | None = None) -> np.ndarray:
    """Seats by highest quotients votes / (2k + 1), at most ``caps`` each; of equal quotients the
    earlier index wins. Works on the threshold quotient, never on single seats."""
    votes = np.asarray(votes, dtype=np.float64)
    caps = np.full(len(votes), seats, np.int64) if caps is None else np.minimum(np.asarray(caps, np.int64), seats)
    caps = np.where(votes > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(votes), np.int64)
    at = lambda d: np.minimum(np.floor((votes / d + 1) / 2).astype(np.int64), caps)  # noqa: E731  seats with quotient >= d
    lo, hi = votes[votes > 0].min() / (2.0 * seats + 3), votes.max() * 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if at(mid).sum() >= seats:
            lo = mid
        else:
            hi = mid
    got = at(hi)
    left = seats - int(got.sum())
    while left > 0:      # quotients tied at the threshold, or apart by less than a double tells
        quotient = np.where(got < caps, votes / (2 * got + 1), -1)
        best = np.argsort(-quotient, kind="stable")[:left]
        best = best[quotient[best] > 0]
        got[best] += 1
        left -= len(best)
    return got


def fair_targets(sizes: np.ndarray, weights: np.ndarray, cap: int = CAP) -> np.ndarray:
    """Share out sum(sizes) by weight; a target stops at cap * size and its excess goes to the
    others by weight, again and again until none is above."""
    sizes, weights = np.asarray(sizes, np.float64), np.asarray(weights, np.float64)
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), bool), float(sizes.sum())
    while free.any():
        share = left * weights / weights[free].sum()
        over = free & (share > cap * sizes)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = cap * sizes[over]
        left -= out[over].sum()
        free &= ~over
    return out


def mix_sources(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple = WEIGHTS, cap: int = CAP, block_words: int = BLOCK_WORDS,
                shard_words: int = SHARD_WORDS, shard_docs: int = SHARD_DOCS, band_shards: int = BAND_SHARDS, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size (words), source_size, target (of its
    source, in words) and taken (words that the mix takes; a word taken twice counts twice).

    Sources count in code point order, null last, and weigh ``weights`` in turn. The table of sources
    is a bounded input of this operator (``weights`` are given per source): one row each reaches the
    driver. Documents do not.

    Null or empty texts have size 0 and nothing taken; a null source is a source; a null id sorts
    first; repeated rows are documents of their own. A shard is chosen by id and text together, so that many
    rows of one id, null included, are spread, and only rows equal in both share a shard. Of rows equal in
    source, id and text, which one is taken more often is not told apart: the rows of the result are the same.
    Texts may be as long as a string of Spark can be: only their sizes and hashes are shuffled. Empty
    table: no rows. Other columns of ``docs`` are ignored, whatever their names.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(F.col(text)).alias("fp"), F.col(text).alias("text"))
    sized = scratch.save(count_words(base), "sizes")

    by_source = (sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
                 .orderBy(F.col("source").asc_nulls_last()).collect())
    sizes = np.array([r["size"] for r in by_source], np.int64)
    ws = np.array([weights[i % len(weights)] for i in range(len(sizes))], np.float64)
    targets = fair_targets(sizes, ws, cap)
    wanted = np.minimum(np.rint(targets).astype(np.int64), cap * sizes)
    seats = sainte_lague(targets, int(round(targets.sum() / block_words)),
                         -(-(cap * sizes) // block_words)) if len(sizes) else sizes
    plan = [(r["source"], int(sizes[i]), float(targets[i]), int(wanted[i]), int(seats[i]),
             int(max(1, -(-sizes[i] // shard_words), -(-r["n"] // shard_docs)))) for i, r in enumerate(by_source)]
    sources = spark.createDataFrame(plan, "src string, source_size long, target double, wanted long, seats long, n_shards long")

    placed = (sized.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("src"))).drop("src")
              .withColumn("shard", F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("fp"), F.lit(seed)), F.col("n_shards"))))
    # seats and words of each band and shard: a task gets the bands of a source, or the shards of a band
    shards = scratch.save(
        placed.groupBy("source", "shard").agg(F.sum("size").alias("part_size"), F.first("wanted").alias("wanted"), F.first("seats").alias("seats"))
        .withColumn("band", F.floor(F.col("shard") / band_shards)), "shards")
    bands = shards.groupBy("source", "band").agg(F.sum("part_size").alias("part_size"), F.first("wanted").alias("wanted"), F.first("seats").alias("seats"))
    bands = (bands.groupBy("source").applyInArrow(_apportion("band", block_words, cap), "source string, band long, wanted long, seats long")
             .select(F.col("source").alias("src"), F.col("band").alias("bnd"), "wanted", "seats"))
    shares = (shards.drop("wanted", "seats").join(bands, F.col("source").eqNullSafe(F.col("src")) & (F.col("band") == F.col("bnd")))
              .select("source", "band", "shard", "part_size", "wanted", "seats").groupBy("source", "band")
              .applyInArrow(_apportion("shard", block_words, cap), "source string, shard long, wanted long, seats long")
              .select(F.col("source").alias("src"), F.col("shard").alias("shd"), F.col("wanted").alias("shard_wanted")))
    joined = placed.join(shares, F.col("source").eqNullSafe(F.col("src")) & (F.col("shard") == F.col("shd"))).drop("src", "shd", "wanted", "seats", "n_shards")
    joined = joined.select("doc_id", "source", "size", "source_size", "target", "fp", "shard", "shard_wanted")
    schema = joined.select("doc_id", "source", "size", "source_size", "target").withColumn("taken", F.lit(0).cast("long")).schema
    return joined.groupBy("source", "shard").applyInArrow(_take(block_words, seed), schema)


def _apportion(part: str, block: int, cap: int):
    """Blocks and words of every part of a whole: of a source's bands, or of a band's shards."""
    def share(t: pa.Table) -> pa.Table:
        t = t.sort_by(part)
        size = t["part_size"].to_numpy()
        wanted, seats = int(t["wanted"][0].as_py()), int(t["seats"][0].as_py())
        quota = sainte_lague(size, seats, -(-(cap * size) // block))
        words = np.minimum(quota * block, cap * size)
        # what whole blocks leave open goes to the parts in proportion to the room they have
        gap = wanted - int(words.sum())
        room = cap * size - words if gap > 0 else words
        if gap and room.sum():
            more = np.floor(abs(gap) * (room / room.sum())).astype(np.int64)
            rest = abs(gap) - int(more.sum())
            more[np.argsort(more - room, kind="stable")[:rest]] += 1
            more = np.minimum(more, room)
            words = words + np.sign(gap) * more
        return pa.table({"source": t["source"], part: t[part], "wanted": pa.array(words, pa.int64()),
                         "seats": pa.array(quota, pa.int64())})
    return share


def _take(block: int, seed: int):
    """Words taken from each document of one shard."""
    def take(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("size", "ascending"), ("fp", "ascending")])
        size = t["size"].to_numpy()
        total, wanted = int(size.sum()), int(t["shard_wanted"][0].as_py())
        ends = np.cumsum(size)
        taken = np.zeros(len(size), np.int64)
        if total:
            rounds, rest = divmod(wanted, total)
            taken += rounds * size
            n = -(-total // block)
            salt = kernel.mix(np.array([seed, int(t["shard"][0].as_py())], np.uint64)).sum(dtype=np.uint64)
            order = np.argsort(kernel.mix(np.arange(n, dtype=np.uint64) + salt), kind="stable")
            length = np.full(n, block, np.int64)
            length[-1] = total - (n - 1) * block
            before = np.cumsum(length[order]) - length[order]
            got = np.zeros(n, np.int64)          # words taken from the front of each block
            got[order] = np.clip(rest - before, 0, length[order])
            # words taken before place x of the stream, for every document's end
            prefix = np.concatenate(([0], np.cumsum(got)))
            upto = lambda x: prefix[x // block] + np.minimum(x % block, got[np.minimum(x // block, n - 1)] * (x // block < n))
            taken += upto(ends) - upto(ends - size)
        cols = {c: t[c] for c in ("doc_id", "source", "size", "source_size", "target")}
        return pa.table({**cols, "taken": pa.array(taken, pa.int64())})
    return take
