"""What the two exact deduplicators share: cells of documents, sampled anchors
with their contexts, and exchanges of hashes between cells.

Documents are laid out once, by ranges of their order, in cells of a bounded
size; documents that are alike in the order (many null ids, say) are dealt over
as many cells as their bytes need. The table of cells is bucketed by cell, so every later pass reads it
without a shuffle. A pass works on one cell at a time and sends, or is sent,
only hashes: each distinct hash of a cell once, however often it occurs there.

Anchors are sampled so that equal windows are sampled alike: the anchor of a
window of W units is its k-unit seed with the smallest hash (the first of
these). The windows of an anchor are consecutive; what they cover together is
the anchor's context. So two equal windows have equal seeds at equal places,
and where whole contexts are equal, so are all their windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel
from tidemark.llm.stage import Scratch, tasks

CELL_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
#: Hashes that a task of an exchange sorts at once, about.
RANGE_KEYS = 1 << 19
FIRST = -(1 << 63)

#: Bits of a reply: in another cell; in an earlier cell; seed has many contexts; in an earlier cell, but
#: there only with the id that this cell begins with, so not before the documents of that id.
OTHER, EARLIER, MANY, TIED = 1, 2, 4, 8


@dataclass
class Anchors:
    """pos: place of the seed; lo, hi: first and last start of its windows; doc: document in its
    chunk; seed, context: hashes."""

    pos: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    doc: np.ndarray
    seed: np.ndarray
    context: np.ndarray


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values: of 2, 4, 8 ... by doubling, then of two that overlap."""
    size = 1
    while 2 * size <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (w - size)], x[w - size:])


def anchors(codes: np.ndarray, bounds: np.ndarray, k: int, window: int, rolling: kernel.Rolling | None = None) -> Anchors:
    starts = kernel.window_starts(bounds, window)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return Anchors(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    rolling = rolling or kernel.Rolling(codes)
    seeds = rolling.raw(k)
    key = seeds & np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(len(seeds), dtype=np.uint64)
    at = (_sliding_min(key, window - k + 1)[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.flatnonzero(np.diff(at)) + 1
    first, last = np.concatenate(([0], change)), np.concatenate((change - 1, [len(at) - 1]))
    pos, lo, hi = at[first], starts[first], starts[last]
    context = rolling.windows(lo, hi + window) ^ kernel.mix(((hi - lo) * 4096 + (pos - lo)).astype(np.uint64))
    return Anchors(pos, lo, hi, np.searchsorted(bounds, lo, side="right") - 1, kernel.mix(seeds[pos]), kernel.mix(context))


class Cells:
    """The laid-out documents: ``table`` (_cell, _ord, _text, _carry), and how far exchanges spread."""

    def __init__(self, docs: DataFrame, scratch: Scratch, doc_id: str, text: str, carry: list[str], units_per_key: float):
        spark = docs.sparkSession
        self.spark, self.scratch = spark, scratch
        ordered = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST)).alias("_ord"),
                              F.col(text).cast("string").alias("_text"),
                              F.struct(*[F.col(c) for c in carry]).alias("_carry"))
        size = ordered.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
        n_bytes = size["b"] + 64 * size["n"]
        n_cells = max(1, -(-n_bytes // CELL_BYTES))
        n_buckets = max(1, min(n_cells, max(tasks(spark), -(-n_bytes // BUCKET_BYTES))))
        self.bits = max(0, int(np.ceil(np.log2(max(1, n_bytes / units_per_key / RANGE_KEYS)))))
        name, path = f"tidemark_cells_{uuid.uuid4().hex[:12]}", f"{scratch.root}/cells"
        placed = ordered.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n_cells, "_ord", "_tie").drop("_tie")
        (placed.withColumn("_cell", F.spark_partition_id().cast("long"))
         .write.bucketBy(n_buckets, "_cell").sortBy("_cell", "_ord").option("compression", "zstd").option("path", path).saveAsTable(name))
        self.table = spark.table(name)
        self.table.schema                        # resolved: the files stay, the name isn't needed any more
        spark.sql(f"DROP TABLE {name}")
        scratch.release()

    def per_cell(self, work: Callable, schema: str, replies: DataFrame | None = None) -> DataFrame:
        """work(table of a cell, replies by kind) for every cell, beside the replies it was sent."""
        def tidy(out: pa.Table) -> pa.Table:
            pa.default_memory_pool().release_unused()
            return out

        if replies is None:
            return self.table.groupBy("_cell").applyInArrow(lambda t: tidy(work(t, {})), schema)
        return (self.table.groupBy("_cell").cogroup(replies.groupBy("_cell"))
                .applyInArrow(lambda t, r: tidy(work(t, _by_kind(r))), schema))


def send(bits: int, keys: np.ndarray, cell: int, ids: np.ndarray | None = None, **payload: np.ndarray) -> pa.Table:
    """Rows for an exchange: sorted keys and what goes with each, cut into 2**bits ranges of keys; the
    first and last of the cell's ``ids`` go with each row."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(keys)])) if len(keys) else np.zeros(1, np.int64)
    spans = list(zip(cuts[:-1], cuts[1:]))
    cols = {"_range": pa.array([int(part[a]) for a, _ in spans], pa.int64()), "_cell": pa.array([cell] * len(spans), pa.int64()),
            "keys": pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary())}
    if ids is not None:
        cols |= {"first": pa.array([int(ids.min())] * len(spans), pa.int64()), "last": pa.array([int(ids.max())] * len(spans), pa.int64())}
    return pa.table(cols | {k: pa.array([v[a:b].tobytes() for a, b in spans], pa.binary()) for k, v in payload.items()})


REPLY = "_cell long, _range long, kind int, reply binary"


def _by_kind(t: pa.Table) -> dict[int, np.ndarray]:
    """All replies of a kind to a cell, in the order of its sorted keys."""
    t = t.sort_by("_range")
    out: dict[int, list] = {}
    for kind, reply in zip(t["kind"].to_pylist(), t["reply"].to_pylist()):
        out.setdefault(kind, []).append(reply)
    return {k: np.frombuffer(b"".join(v), np.uint8) for k, v in out.items()}


def reply(cells: list[int], key_range: int, kind: int, sizes: list[int], values: np.ndarray) -> pa.Table:
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    return pa.table({"_cell": pa.array(cells, pa.int64()), "_range": pa.array([key_range] * len(cells), pa.int64()),
                     "kind": pa.array([kind] * len(cells), pa.int32()),
                     "reply": pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})


def answer_keys(sent: DataFrame, kind: int) -> DataFrame:
    """To each cell, for each of its distinct keys: a byte with OTHER and EARLIER."""
    def answer(t: pa.Table) -> pa.Table:
        t = t.sort_by("_cell")
        parts = [np.frombuffer(b, np.uint64) for b in t["keys"].to_pylist()]
        keys = np.concatenate(parts)
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        run = np.cumsum(new) - 1
        code = np.where(np.bincount(run)[run] > 1, OTHER, 0) | np.where(new, 0, EARLIER)
        out = np.empty(len(keys), np.uint8)
        out[order] = code
        return reply(t["_cell"].to_pylist(), t["_range"][0].as_py(), kind, [len(p) for p in parts], out)
    return sent.groupBy("_range").applyInArrow(answer, REPLY)


def distinct(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, each key's index among them, and the first and last owner of each."""
    unique, inverse = np.unique(keys, return_inverse=True)
    lo = np.full(len(unique), np.iinfo(np.int64).max)
    hi = np.full(len(unique), -1, np.int64)
    np.minimum.at(lo, inverse, owner)
    np.maximum.at(hi, inverse, owner)
    return unique, inverse, lo, hi


def seen(keys: np.ndarray, owner: np.ndarray, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each occurrence: does its key occur with another owner; with an earlier one."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    _, inverse, lo, hi = distinct(keys, owner)
    code = answers[inverse]
    return (lo != hi)[inverse] | (code & OTHER > 0), (owner > lo[inverse]) | (code & EARLIER > 0)


SENT = "_range long, _cell long, keys binary"
SENT_CONTEXTS = SENT + ", contexts binary"
SENT_PLACES = SENT_CONTEXTS + ", places binary"
SENT_ORDERED = SENT_CONTEXTS + ", first long, last long, inside binary"


@dataclass
class Contexts:
    """The distinct (seed, context) pairs of a cell, sorted, among the anchors that take part."""

    seed: np.ndarray
    context: np.ndarray
    inverse: np.ndarray     # of each anchor that takes part
    lo: np.ndarray          # first and last owner
    hi: np.ndarray
    first: np.ndarray       # the first anchor (index among those that take part) of the first owner


def contexts(seed: np.ndarray, context: np.ndarray, owner: np.ndarray) -> Contexts:
    order = np.lexsort((owner, context, seed))
    s, c = seed[order], context[order]
    new = np.ones(len(order), bool)
    new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
    first = order[new]
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    last = np.append(np.flatnonzero(new)[1:] - 1, len(order) - 1) if len(order) else np.zeros(0, np.int64)
    return Contexts(s[new], c[new], inverse, owner[first], owner[order][last] if len(order) else owner[:0], first)


def answer_contexts(sent: DataFrame, kind: int, with_reference: bool = False) -> DataFrame:
    """To each cell, for each of its distinct (seed, context) pairs: a byte with OTHER, EARLIER and
    MANY (other contexts have this seed as well). With ``with_reference`` also, as kind + 100, cell
    and place (two 64-bit values) of the first other cell that holds the pair, or -1.

    Cells are in the order of ids, and an id may span cells. Where cells sent their ids, and for each
    pair whether a document before their last id has it (``inside``), a pair of an earlier cell that
    only the id at the border has is TIED in place of EARLIER."""
    def answer(t: pa.Table) -> pa.Table:
        t = t.sort_by("_cell")
        read = lambda c, kind: [np.frombuffer(b, kind) for b in t[c].to_pylist()]
        parts = read("keys", np.uint64)
        seed, context = np.concatenate(parts), np.concatenate(read("contexts", np.uint64))
        order = np.lexsort((context, seed))       # stable: cells in order within a pair
        s, c = seed[order], context[order]
        new_seed = np.ones(len(s), bool)
        new_seed[1:] = s[1:] != s[:-1]
        new = new_seed.copy()
        new[1:] |= c[1:] != c[:-1]
        run, seed_run = np.cumsum(new) - 1, np.cumsum(new_seed) - 1
        size = np.bincount(run)
        many = np.bincount(seed_run, weights=new)[seed_run] > 1
        earlier = np.full(len(s), EARLIER)
        if "inside" in t.column_names:
            holder = np.repeat(np.arange(len(parts)), [len(p) for p in parts])[order]
            head = np.flatnonzero(new)[run]                  # the pair's first cell has its least id
            inside = np.concatenate(read("inside", np.uint8))[order][head] > 0
            earlier[~inside & (t["last"].to_numpy()[holder[head]] == t["first"].to_numpy()[holder])] = TIED
        out = np.empty(len(s), np.uint8)
        out[order] = np.where(size[run] > 1, OTHER, 0) | np.where(new, 0, earlier) | np.where(many, MANY, 0)
        cells, r, sizes = t["_cell"].to_pylist(), t["_range"][0].as_py(), [len(p) for p in parts]
        result = reply(cells, r, kind, sizes, out)
        if not with_reference:
            return result
        cell = np.repeat(np.array(cells, np.int64), sizes)[order]
        place = np.concatenate(read("places", np.int64))[order]
        begin = np.flatnonzero(new)[run]
        ref = np.where(new, np.minimum(begin + 1, len(s) - 1), begin)       # the first, or for it the second
        alone = size[run] == 1
        pairs = np.empty((len(s), 2), np.int64)
        pairs[order] = np.stack((np.where(alone, -1, cell[ref]), np.where(alone, -1, place[ref])), axis=1)
        return pa.concat_tables([result, reply(cells, r, kind + 100, [16 * n for n in sizes], pairs.view(np.uint8).ravel())])
    return sent.groupBy("_range").applyInArrow(answer, REPLY)


def cell_chunks(t: pa.Table) -> Iterator[kernel.Chunk]:
    return kernel.chunks(t["_text"])


def concat(parts: list[Anchors], shifts: list[tuple[int, int]]) -> Anchors:
    """Anchors of several chunks of a cell as one: places and documents moved by each chunk's shift."""
    join = lambda f: np.concatenate([f(p, s) for p, s in zip(parts, shifts)]) if parts else np.zeros(0, np.int64)
    return Anchors(join(lambda p, s: p.pos + s[0]), join(lambda p, s: p.lo + s[0]), join(lambda p, s: p.hi + s[0]),
                   join(lambda p, s: p.doc + s[1]), join(lambda p, s: p.seed).astype(np.uint64), join(lambda p, s: p.context).astype(np.uint64))
