"""Substring deduplication by relative Lempel-Ziv parsing, on words.

The corpus itself, in blocks (the cells of ``repeats``), is the reference, and
every block is indexed: the contexts of its anchors, by seed, in an index that
ranges of hashes spread over all tasks. A document is parsed greedily against it:
a phrase that occurs in a reference block opens a factor, and the factor goes on
as long as the next phrase occurs at the next place of the same block. Factors
of at least a window's length are duplicate spans: every window in them starts
elsewhere too.

What factors can't tell is at their boundaries: a phrase without another occurrence
as a whole, whose seed does occur elsewhere. Only there windows are
compared one by one, with those of all distinct phrases of the same seed. So the
result is exact: a window is removed if and only if its words start anywhere else.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel, repeats
from tidemark.llm.repeats import EARLIER, MANY, OTHER
from tidemark.llm.stage import Scratch

WINDOW = 35
SEED = 12
_SALT = np.uint64(0x5851F42D4C957F2D)


class _Block:
    """Words, documents and anchors of a reference block."""

    def __init__(self, t: pa.Table, window: int, seed: int):
        self.block = int(t["_cell"][0].as_py())
        self.chunks, parts, shifts, codes, bounds, at = [], [], [], [], [np.zeros(1, np.int64)], 0
        for c in repeats.cell_chunks(t):
            w = kernel.words(c)
            x = w.codes()
            parts.append(repeats.anchors(x, w.bounds, seed, window))
            shifts.append((at, c.first))
            self.chunks.append((c, w))
            codes.append(x)
            bounds.append(w.bounds[1:] + at)
            at += len(x)
        self.a = repeats.concat(parts, shifts)
        self.codes = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        self.bounds = np.concatenate(bounds)
        self.place = np.arange(len(self.a.pos))


def factors(reference: np.ndarray, place: np.ndarray, doc: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Greedy parse: the number of the factor of each phrase, or -1. ``reference`` has (block, place)
    of the phrase's occurrence; a factor goes on where both documents' next phrases meet again."""
    if not len(found):
        return np.zeros(0, np.int64)
    on = np.zeros(len(found), bool)
    on[1:] = (found[1:] & found[:-1] & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1] + 1)
              & (reference[1:, 0] == reference[:-1, 0]) & (reference[1:, 1] == reference[:-1, 1] + 1))
    return np.where(found, np.cumsum(found & ~on) - 1, -1)


def removed_words(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED,
                  keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (of the kept words, one
    space between), n_factors and longest_factor (in words); with ``keep_text`` also ``kept``, those
    words, and ``spans``, the removed runs of words.

    Null and empty texts have no words; a text of fewer than ``window`` words keeps them all; a
    repeated row occurs elsewhere, so both lose their windows; a null id is an id like others; an
    empty table gives no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "rlz-dedup")
    docs = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"))
    cells = repeats.Cells(docs, scratch, "_id", "_t", ["_id"], units_per_key=70)
    bits = cells.bits

    def send_seeds(t, _):
        return repeats.send(bits, np.unique((b := _Block(t, window, seed)).a.seed), b.block)

    first = scratch.save(repeats.answer_keys(cells.per_cell(send_seeds, repeats.SENT), 1), "seeds")

    def phrases(b: _Block, replies) -> tuple[np.ndarray, repeats.Contexts]:
        """The anchors whose seed occurs elsewhere, and their contexts."""
        elsewhere, _ = repeats.seen(b.a.seed, b.place, replies.get(1, np.zeros(0, np.uint8)))
        on = np.flatnonzero(elsewhere)
        return on, repeats.contexts(b.a.seed[on], b.a.context[on], on)

    def send_phrases(t, replies):
        b = _Block(t, window, seed)
        on, x = phrases(b, replies)
        return repeats.send(bits, x.seed, b.block, contexts=x.context, places=on[x.first])

    second = scratch.save(repeats.answer_contexts(cells.per_cell(send_phrases, repeats.SENT_PLACES, first), 2, with_reference=True), "index")
    replies = first.unionByName(second)

    def boundary(b: _Block, on, x, replies) -> tuple[np.ndarray, repeats.Contexts]:
        """Starts of the windows to compare, and their hashes: those of each distinct phrase, in the
        first block that has it, whose seed has other phrases too. A window is told by two hashes, 128
        bits, as at the size of a large corpus some of 64 would agree by chance."""
        codes = replies.get(2, np.zeros(0, np.uint8))
        held = on[x.first[np.flatnonzero((codes & MANY > 0) & (codes & EARLIER == 0))]]
        size = b.a.hi[held] - b.a.lo[held] + 1
        starts = np.repeat(b.a.lo[held] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum())) if len(held) else np.zeros(0, np.int64)
        again = kernel.Rolling(kernel.mix(b.codes ^ _SALT)).windows(starts, starts + window)
        return starts, repeats.contexts(kernel.Rolling(b.codes).windows(starts, starts + window), again, starts)

    def send_windows(t, replies):
        b = _Block(t, window, seed)
        on, x = phrases(b, replies)
        w = boundary(b, on, x, replies)[1]
        return repeats.send(bits, w.seed, b.block, contexts=w.context)

    third = scratch.save(repeats.answer_contexts(cells.per_cell(send_windows, repeats.SENT_CONTEXTS, replies), 3), "windows")
    replies = replies.unionByName(third)

    id_type = docs.schema["_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_sha256 string, n_factors long, longest_factor long" + (
        ", kept string, spans array<struct<lo:bigint,hi:bigint>>" if keep_text else "")

    def finish(t, replies):
        b = _Block(t, window, seed)
        on, x = phrases(b, replies)
        step = np.zeros(len(b.codes) + 1, np.int32)
        n_docs = t.num_rows
        n_factors, longest = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
        if len(on):
            codes, ref = replies[2], replies[102].view(np.int64).reshape(-1, 2).copy()
            here = (codes & OTHER == 0) & (x.hi > x.lo)          # occurs again in this block only
            ref[here] = np.stack((np.full(int(here.sum()), b.block), x.lo[here]), axis=1)
            reference = ref[x.inverse]
            own = here[x.inverse] & (x.lo[x.inverse] == on)
            reference[own, 1] = x.hi[x.inverse][own]
            found = (codes[x.inverse] & OTHER > 0) | (x.hi > x.lo)[x.inverse]
            factor = factors(reference, on, b.a.doc[on], found)
            if found.any():
                f = factor[found]
                lo = np.full(f.max() + 1, np.iinfo(np.int64).max)
                hi, doc = np.zeros(f.max() + 1, np.int64), np.zeros(f.max() + 1, np.int64)
                np.minimum.at(lo, f, b.a.lo[on[found]])
                np.maximum.at(hi, f, b.a.hi[on[found]] + window)
                doc[f] = b.a.doc[on[found]]
                long = hi - lo >= window
                np.add.at(step, lo[long], 1)
                np.add.at(step, hi[long], -1)
                np.add.at(n_factors, doc, 1)
                np.maximum.at(longest, doc, hi - lo)
            starts, w = boundary(b, on, x, replies)
            again = ((w.hi > w.lo) | (replies.get(3, np.zeros(0, np.uint8)) & OTHER > 0))[w.inverse]
            np.add.at(step, starts[again], 1)
            np.add.at(step, starts[again] + window, -1)
        mask = np.cumsum(step[:-1]) > 0
        kept, at = [], 0
        for c, w in b.chunks:
            stay = ~mask[at:at + len(w.starts)]
            # a kept word brings its bytes and one space; spaces at the ends of documents are dropped
            length = (w.ends - w.starts + 1)[stay]
            stop = np.cumsum(length)
            data = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
            from_ = np.repeat(w.starts[stay] - (stop - length), length) + np.arange(len(data))
            in_word = np.ones(len(data), bool)
            in_word[stop - 1] = False
            data[in_word] = w.data[from_[in_word]]
            n_kept = np.concatenate(([0], np.cumsum(stay)))[w.bounds]
            byte = np.concatenate(([0], stop))[n_kept]
            kept += [data[p:max(p, q - 1)].tobytes() for p, q in zip(byte[:-1], byte[1:])]
            at += len(w.starts)
        carried = t["_carry"].combine_chunks()
        carried = carried.chunk(0) if isinstance(carried, pa.ChunkedArray) else carried
        out = {"doc_id": carried.field(0), "n_words": pa.array(np.diff(b.bounds)), "n_removed": pa.array(kernel.sums(mask, b.bounds)),
               "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
               "n_factors": pa.array(n_factors), "longest_factor": pa.array(longest)}
        if keep_text:
            lo, hi = kernel.runs(mask, b.bounds)
            cut = np.searchsorted(lo, b.bounds)
            out["kept"] = pa.array([k.decode() for k in kept], pa.string())
            out["spans"] = pa.array([[{"lo": int(p - base), "hi": int(q - base)} for p, q in zip(lo[i:j], hi[i:j])]
                                     for i, j, base in zip(cut[:-1], cut[1:], b.bounds[:-1])],
                                    pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))
        return pa.table(out)

    return cells.per_cell(finish, schema, replies)
