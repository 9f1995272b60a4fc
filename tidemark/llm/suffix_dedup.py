"""Suffix-array deduplication by external induced sorting.

Bytes of a document that belong to a 50-byte string which also starts in an
earlier document are removed. Which strings are equal follows from the sorted
order of suffixes and the common prefixes of neighbours, taken only as deep as
50 bytes and only where it can matter:

1. Sampled suffixes (the anchors of ``repeats``, a set that every window of 50
   bytes meets at a place fixed by its content) are compared by seed; suffixes
   whose seed occurs in no other document leave.
2. Equal contexts settle all their windows at once. What remains are sampled
   suffixes whose seed has several contexts, one tuple for each.
3. These tuples go through external queues: Spark's sorter orders them by seed
   and suffix, spilling to disk as it must, and a task reads them as a stream, so
   a shard may be far larger than memory. Common prefixes of neighbours are
   carried along. The suffixes before the samples are then induced, one byte
   further left per round: a tuple (byte, rank of the suffix that follows) is
   taken out by byte and rank, and its common prefix with its neighbour is one
   more than the least on the way between their followers. A run of neighbours
   that share 50 bytes is one string; all but its first document lose it.

A seed with very many contexts would be one large group; such seeds are found by
an aggregation and their windows are grouped one by one, which is as exact and
spreads them over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel, repeats
from tidemark.llm.repeats import EARLIER, MANY, TIED
from tidemark.llm.stage import Scratch

WINDOW = 50
#: Long enough that a seed in common is seldom chance, short enough that anchors stay 16 bytes apart.
SEED = 20
#: Contexts of one seed up to which they are sorted together in a task.
HOT_CONTEXTS = 20_000
#: Tuples that are induced together: whole groups of seeds until there are so many.
GROUP_ROWS = 1 << 15


class _Cell:
    """Bytes, documents and anchors of a cell."""

    def __init__(self, t: pa.Table, window: int, seed: int):
        self.cell = int(t["_cell"][0].as_py())
        self.ord = t["_ord"].to_numpy()
        _, self.rank = np.unique(self.ord, return_inverse=True)
        parts, shifts, data, offsets, at = [], [], [], [np.zeros(1, np.int64)], 0
        for c in repeats.cell_chunks(t):
            parts.append(repeats.anchors(kernel._CODE[c.data], c.offsets, seed, window))
            shifts.append((at, c.first))
            data.append(c.data)
            offsets.append(c.offsets[1:] + at)
            at += len(c.data)
        self.a = repeats.concat(parts, shifts)
        self.data = np.concatenate(data) if data else np.zeros(0, np.uint8)
        self.offsets = np.concatenate(offsets)
        self.owner = self.rank[self.a.doc].astype(np.int64)


def _later_than_all(codes: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Which contexts an earlier document of another cell has, before the cell's first owner ``lo`` of it."""
    return (codes & EARLIER > 0) | ((codes & TIED > 0) & (lo > 0))


_TUPLE = "seed long, _cell long, place long, ord long, before binary, after binary, least int, most int"


def removed_bytes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED,
                  hot: int = HOT_CONTEXTS, carry: list[str] | None = None, output: str = "digest") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256; with ``output='text'`` instead the columns ``carry`` and ``text`` with the removed
    runs cut out, where a run that cuts a character in two is narrowed to whole characters.

    Documents are ordered by id; a null id comes before all others, and documents of equal id are not
    before each other. A null text counts as empty, a text shorter than ``window`` keeps everything,
    repeated rows count once each, an empty table gives no rows; other columns are ignored. Documents
    of one id may be any share of all: cells split them.
    """
    if window - seed + 1 > 63:
        raise ValueError("a window may be at most 62 bytes longer than a seed")
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    carry = carry or []
    docs = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    cells = repeats.Cells(docs, scratch, "_id", "_t", ["_id", *[f"_c{i}" for i in range(len(carry))]], units_per_key=18)

    bits = cells.bits

    def send_seeds(t, _):
        c = _Cell(t, window, seed)
        return repeats.send(bits, np.unique(c.a.seed), c.cell)

    first = scratch.save(repeats.answer_keys(cells.per_cell(send_seeds, repeats.SENT), 1), "seeds")

    def part(c: _Cell, replies) -> tuple[np.ndarray, repeats.Contexts]:
        """The anchors whose seed another document has, and their contexts."""
        shared, _ = repeats.seen(c.a.seed, c.owner, replies.get(1, np.zeros(0, np.uint8)))
        on = np.flatnonzero(shared)
        return on, repeats.contexts(c.a.seed[on], c.a.context[on], c.owner[on])

    def send_contexts(t, replies):
        c = _Cell(t, window, seed)
        _, x = part(c, replies)
        return repeats.send(bits, x.seed, c.cell, c.ord, contexts=x.context, inside=(x.lo < c.rank.max()).astype(np.uint8))

    second = scratch.save(repeats.answer_contexts(cells.per_cell(send_contexts, repeats.SENT_ORDERED, first), 2), "contexts")
    replies = first.unionByName(second)

    def send_tuples(t, replies):
        rows = {k: [] for k in ("seed", "_cell", "place", "ord", "before", "after", "least", "most")}
        if len(codes := replies.get(2, ())):
            c = _Cell(t, window, seed)
            on, x = part(c, replies)
            for u in np.flatnonzero((codes & MANY > 0) & ~_later_than_all(codes, x.lo)):
                i = on[x.first[u]]
                pos, lo, hi = int(c.a.pos[i]), int(c.a.lo[i]), int(c.a.hi[i])
                for k, v in (("seed", int(x.seed[u].view(np.int64))), ("_cell", c.cell), ("place", int(u)), ("ord", int(c.ord[c.a.doc[i]])),
                             ("before", c.data[lo:pos].tobytes()), ("after", c.data[pos:hi + window].tobytes()),
                             ("least", pos - hi), ("most", pos - lo)):
                    rows[k].append(v)
        kinds = {"before": pa.binary(), "after": pa.binary(), "least": pa.int32(), "most": pa.int32()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()})

    tuples = scratch.save(cells.per_cell(send_tuples, _TUPLE, replies), "tuples")
    lost = scratch.save(_later_windows(tuples, scratch, window, hot), "windows")
    third = lost.groupBy("_cell").applyInArrow(_pack_places, repeats.REPLY)
    replies = replies.unionByName(third)

    digest = output == "digest"
    id_type = docs.schema["_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" if digest else
              ", ".join([*[f"_c{i} {docs.schema[f'_c{i}'].dataType.simpleString()}" for i in range(len(carry))], "_kept string"]))

    def finish(t, replies):
        c = _Cell(t, window, seed)
        step = np.zeros(len(c.data) + 1, np.int32)
        on, x = part(c, replies)
        if len(on):
            codes = replies[2]
            gone = _later_than_all(codes, x.lo)[x.inverse] | (c.owner[on] > x.lo[x.inverse])
            whole = on[gone]
            np.add.at(step, c.a.lo[whole], 1)
            np.add.at(step, c.a.hi[whole] + window, -1)
            if 3 in replies:
                places, masks = replies[3].view(np.int64).reshape(-1, 2).T
                mask = np.zeros(len(x.seed), np.int64)
                mask[places] = masks
                mine = mask[x.inverse]
                mine[gone] = 0
                some = np.flatnonzero(mine)
                for d in range(window - seed + 1):
                    hit = on[some[(mine[some] >> d) & 1 > 0]]
                    np.add.at(step, c.a.pos[hit] - d, 1)
                    np.add.at(step, c.a.pos[hit] - d + window, -1)
        mask = np.cumsum(step[:-1]) > 0
        lo, hi = kernel.runs(mask, c.offsets)
        carried = t["_carry"].combine_chunks()
        carried = carried.chunk(0) if isinstance(carried, pa.ChunkedArray) else carried
        if not digest:
            kept = _kept_texts(c, lo, hi)
            return pa.table({**{f"_c{i}": carried.field(i + 1) for i in range(len(carry))}, "_kept": pa.array(kept, pa.string())})
        per_doc = np.searchsorted(lo, c.offsets)
        sha = [hashlib.sha256(c.data[a:b][~mask[a:b]].tobytes()).hexdigest() for a, b in zip(c.offsets[:-1], c.offsets[1:])]
        return pa.table({"doc_id": carried.field(0), "n_bytes": pa.array(np.diff(c.offsets)), "n_removed": pa.array(kernel.sums(mask, c.offsets)),
                         "n_spans": pa.array(np.diff(per_doc).astype(np.int64)), "kept_sha256": pa.array(sha, pa.string())})

    out = cells.per_cell(finish, schema, replies)
    return out if digest else out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], F.col("_kept").alias(text))


def _kept_texts(c: _Cell, lo: np.ndarray, hi: np.ndarray) -> list[str]:
    """Texts without the runs, each run narrowed so that it begins and ends between characters."""
    inside = lambda i, end: i < end and 0x80 <= c.data[i] < 0xC0  # noqa: E731  within a character
    keep = np.ones(len(c.data), bool)
    ends = c.offsets[np.searchsorted(c.offsets, lo, side="right")]
    for a, b, end in zip(lo.tolist(), hi.tolist(), ends.tolist()):
        while a < b and inside(a, end):
            a += 1
        while b > a and inside(b, end):
            b -= 1
        keep[a:b] = False
    return [c.data[a:b][keep[a:b]].tobytes().decode("utf-8") for a, b in zip(c.offsets[:-1], c.offsets[1:])]


def _pack_places(t: pa.Table) -> pa.Table:
    pairs = np.stack((t["place"].to_numpy(), t["mask"].to_numpy()), axis=1).astype(np.int64)
    return pa.table({"_cell": t["_cell"].slice(0, 1), "_range": pa.array([0], pa.int64()), "kind": pa.array([3], pa.int32()),
                     "reply": pa.array([pairs.tobytes()], pa.binary())})


# -- the sorted suffixes ------------------------------------------------------

def _later_windows(tuples: DataFrame, scratch: Scratch, window: int, hot: int) -> DataFrame:
    """(_cell, place, mask): bit d tells that the window which starts d bytes before the sampled
    suffix also starts in an earlier document."""
    frequent = scratch.save(tuples.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") > hot).select(F.col("seed").alias("hot_seed")), "hot-seeds")
    any_hot = frequent.limit(1).count() > 0
    marked = tuples.join(frequent, F.col("seed") == F.col("hot_seed"), "left") if any_hot else tuples.withColumn("hot_seed", F.lit(None))
    usual = (marked.where(F.col("hot_seed").isNull()).drop("hot_seed").repartition("seed")
             .sortWithinPartitions("seed", "after").mapInArrow(_induce(window), "_cell long, place long, mask long"))
    if not any_hot:
        return usual
    each = marked.where(F.col("hot_seed").isNotNull()).select(
        "_cell", "place", "ord", F.length("before").alias("b"), F.concat("before", "after").alias("c"),
        F.explode(F.sequence("least", "most")).alias("d"))
    each = each.select("_cell", "place", "ord", "d", F.expr(f"substring(c, b - d + 1, {window})").alias("w"))
    first = each.groupBy("w").agg(F.min("ord").alias("first")).withColumnRenamed("w", "fw")
    single = (each.join(first, F.col("w") == F.col("fw")).where(F.col("ord") > F.col("first"))
              .groupBy("_cell", "place").agg(F.expr("bit_or(shiftleft(1L, d))").alias("mask")))
    return usual.unionByName(single)


def _induce(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows < GROUP_ROWS:
                continue
            t = pa.Table.from_batches(held)
            seeds = t["seed"].to_numpy()
            cut = int(np.searchsorted(seeds, seeds[-1]))
            if cut:
                yield from later(t.slice(0, cut), window).to_batches()
                held, rows = t.slice(cut).to_batches(), t.num_rows - cut
        if rows:
            yield from later(pa.Table.from_batches(held), window).to_batches()
    return run


def _range_minimum(values: np.ndarray):
    """min(values[a:b]) for arrays a < b, from minima over powers of two."""
    table = [values]
    while 2 * (1 << (len(table) - 1)) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    def query(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), values.dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(table[k][a[at]], table[k][b[at] - (1 << k)])
        return out
    return query


def later(t: pa.Table, window: int) -> pa.Table:
    """Induce, for tuples sorted by (seed, suffix), the order and common prefixes of the suffixes that
    start 0, 1, 2 ... bytes before, and mark windows that an earlier document has as well."""
    n = t.num_rows
    seed, doc = t["seed"].to_numpy(), t["ord"].to_numpy()
    least, most = t["least"].to_numpy(), t["most"].to_numpy()
    pad = lambda texts, width: np.frombuffer(b"".join(x[:width].ljust(width, b"\0") for x in texts), np.uint8).reshape(n, width)
    after = pad(t["after"].to_pylist(), window)
    deep = int(most.max(initial=0))
    before = pad([x[::-1] for x in t["before"].to_pylist()], max(deep, 1))     # column d-1: the byte d before
    group = np.concatenate(([0], np.cumsum(seed[1:] != seed[:-1]))) if n else np.zeros(0, np.int64)
    # neighbours' common prefixes at the samples; prefix[i] is that of i-1 and i, and 0 between seeds
    same = after[1:] == after[:-1]
    prefix = np.zeros(n, np.int32)
    prefix[1:] = np.where(same.all(axis=1), window, np.argmin(same, axis=1)) * (group[1:] == group[:-1])
    order = np.arange(n)                     # tuples by the rank of their current suffix
    mask = np.zeros(n, np.int64)
    for d in range(deep + 1):
        if d:
            byte = before[order, d - 1].astype(np.int64) + 1
            byte[most[order] < d] = 0        # no such suffix any more: sorted first, alike with none
            out = np.argsort(group[order] * 257 + byte, kind="stable")
            taken = order[out]
            alike = (group[taken[1:]] == group[taken[:-1]]) & (byte[out[1:]] == byte[out[:-1]]) & (byte[out[1:]] > 0)
            now = np.zeros(n, np.int32)
            if alike.any():
                least_on_the_way = _range_minimum(prefix)(out[:-1][alike] + 1, out[1:][alike] + 1)
                now[1:][alike] = np.minimum(least_on_the_way + 1, window)
            prefix, order = now, taken
        begin = np.ones(n, bool)
        begin[1:] = prefix[1:] < window
        valid = (least[order] <= d) & (d <= most[order])
        first = np.minimum.reduceat(np.where(valid, doc[order], np.iinfo(np.int64).max), np.flatnonzero(begin))
        gone = valid & (doc[order] > first[np.cumsum(begin) - 1])
        mask[order[gone]] |= 1 << d
    keep = np.flatnonzero(mask)
    return pa.table({"_cell": t["_cell"].take(pa.array(keep)), "place": t["place"].take(pa.array(keep)), "mask": pa.array(mask[keep])})
