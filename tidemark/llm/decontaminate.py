"""Benchmark decontamination with a broadcast set of normalised test n-grams.

The benchmark's windows (13 words, or a whole shorter item) become a hash set
that is broadcast in slices of a checked size: one slice for any usual
benchmark, further slices one at a time beyond that. Every task scans the
windows of its documents against the slice, verifies each hit word by word, and
marks the hit words. A document's words, hits and items never leave its row, so
nothing is shuffled unless there is more than one slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import kernel

WINDOW = 13
#: Windows of a slice: a window takes about 150 bytes with its words, so a slice stays below 40 MB.
SLICE_WINDOWS = 250_000
ONE_IN = 20


def item_windows(items: DataFrame, item_id: str, text: str, n: int = WINDOW) -> DataFrame:
    """Rows (len, hash, phrase, item): every n-word window of an item, or the whole of a shorter
    one; phrase has the normalised words, parted by spaces. Items without words have none."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in kernel.chunks(b.column(1)):
                w = kernel.words(c, "alnum", lower=True)
                rolling = kernel.Rolling(w.codes())
                size = np.diff(w.bounds)
                short = np.flatnonzero((size > 0) & (size < n))
                long = kernel.window_starts(w.bounds, n)
                starts = np.concatenate((long, w.bounds[short]))
                lengths = np.concatenate((np.full(len(long), n), size[short])).astype(np.int64)
                hashes = rolling.windows(starts, starts + lengths)
                rows = c.first + np.searchsorted(w.bounds, starts, side="right") - 1
                phrases = [b" ".join(w.word(j) for j in range(s, s + k)) for s, k in zip(starts, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lengths, pa.int32()), pa.array(hashes.view(np.int64)), pa.array(phrases, pa.binary()),
                     b.column(0).take(pa.array(rows)) if len(rows) else pa.array([], pa.string())],
                    ["len", "hash", "phrase", "item"])

    return (items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
            .mapInArrow(cut, "len int, hash long, phrase binary, item string")
            .groupBy("len", "hash", "phrase").agg(F.array_sort(F.collect_set("item")).alias("items")))


class _Slice:
    """A part of the hash set, as tasks see it: by window length, sorted hashes and phrases."""

    def __init__(self, rows):
        self.by_len: dict[int, tuple[np.ndarray, list, list]] = {}
        for k in sorted({r["len"] for r in rows}):
            part = [(np.uint64(r["hash"] & (1 << 64) - 1), bytes(r["phrase"]), list(r["items"])) for r in rows if r["len"] == k]
            part.sort(key=lambda x: x[0])
            self.by_len[k] = (np.array([x[0] for x in part], np.uint64), [x[1] for x in part], [x[2] for x in part])

    def hits(self, w: kernel.Words) -> Iterator[tuple[int, int, list[str]]]:
        """(start, length, items) of every window of the documents that occurs here, verified."""
        rolling = kernel.Rolling(w.codes())
        for k, (hashes, phrases, items) in self.by_len.items():
            starts = kernel.window_starts(w.bounds, k)
            got = rolling.all(k)[starts] if len(starts) else np.zeros(0, np.uint64)
            lo = np.searchsorted(hashes, got)
            found = np.flatnonzero(hashes[np.minimum(lo, len(hashes) - 1)] == got)
            for i in found:
                s, at = int(starts[i]), int(lo[i])
                phrase = b" ".join(w.word(j) for j in range(s, s + k))
                while at < len(hashes) and hashes[at] == got[i]:
                    if phrases[at] == phrase:
                        yield s, k, items[at]
                    at += 1


def _scan(slices_of_task, fields: list[str]):
    """A row of ``fields`` for every document: its hit spans and items against one slice."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = slices_of_task.value
        for b in batches:
            n_words, spans, found = [], [], []
            for c in kernel.chunks(b.column(len(fields))):
                w = kernel.words(c, "alnum", lower=True)
                starts, lengths, items = [], [], [set() for _ in range(c.n)]
                for s, k, names in windows.hits(w):
                    starts.append(s)
                    lengths.append(k)
                    items[int(np.searchsorted(w.bounds, s, side="right")) - 1].update(names)
                mask = kernel.cover(np.array(starts, np.int64), np.array(lengths, np.int64), len(w.starts))
                lo, hi = kernel.runs(mask, w.bounds)
                doc = np.searchsorted(w.bounds, lo, side="right") - 1
                cut = np.searchsorted(doc, np.arange(c.n + 1))
                n_words.append(np.diff(w.bounds))
                for d in range(c.n):
                    a, z = cut[d], cut[d + 1]
                    base = w.bounds[d]
                    spans.append([{"lo": int(x - base), "hi": int(y - base), "byte_lo": int(w.starts[x] - c.offsets[d]),
                                   "byte_hi": int(w.ends[y - 1] - c.offsets[d])} for x, y in zip(lo[a:z], hi[a:z])])
                    found.append(sorted(items[d]))
            n = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(fields)], pa.array(n, pa.int64()), pa.array(spans, _SPANS_ARROW), pa.array(found, pa.list_(pa.string()))],
                [*fields, "n_words", "spans", "items"])
    return scan


_SPANS_ARROW = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("byte_lo", pa.int64()), ("byte_hi", pa.int64())]))
_SPANS = "array<struct<lo:bigint,hi:bigint,byte_lo:bigint,byte_hi:bigint>>"


def _merged(spans):
    """Spans of several slices, sorted and merged where they overlap or touch."""
    return F.aggregate(
        F.array_sort(spans), F.array().cast(_SPANS),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["hi"] >= x["lo"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["lo"].alias("lo"), F.greatest(F.element_at(acc, -1)["hi"], x["hi"]).alias("hi"),
                                  F.element_at(acc, -1)["byte_lo"].alias("byte_lo"),
                                  F.greatest(F.element_at(acc, -1)["byte_hi"], x["byte_hi"]).alias("byte_hi")))))
        .otherwise(F.concat(acc, F.array(x))))


def scan(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         n: int = WINDOW, slice_windows: int = SLICE_WINDOWS, one_in: int = ONE_IN) -> DataFrame:
    """``docs`` (all columns kept but those of the result's names) with n_words, spans (hit words as
    maximal runs [lo, hi) and their bytes), items (sorted ids of items with a window here), n_hit,
    n_items, contaminated (n_hit > 0 and one_in * n_hit >= n_words).

    A null or empty text, or one without words, has no words and is clean; an item without words has
    no window; items of one id count as one, and an item without id marks words but is not listed.
    Repeated rows give repeated results; empty tables give empty, or clean, results.
    """
    spark: SparkSession = docs.sparkSession
    windows = item_windows(items, item_id, item_text, n)
    made = ("n_words", "spans", "items", "n_hit", "n_items", "contaminated")
    docs = docs.select(*[c for c in docs.columns if c not in made])
    fields = [c for c in docs.columns if c != text] + [text]
    schema = T.StructType([docs.schema[c] for c in fields]).add("n_words", "long").add("spans", T.DataType.fromDDL(_SPANS)).add("items", T.ArrayType(T.StringType()))

    rows = windows.limit(slice_windows + 1).collect()
    if len(rows) <= slice_windows:
        shared = spark.sparkContext.broadcast(_Slice(rows))
        out = docs.select(*fields, F.col(text).alias("_scanned")).mapInArrow(_scan(shared, fields), schema)
    else:
        out = _by_slices(docs, windows, fields, text, schema, slice_windows)
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["hi"] - x["lo"]), F.lit(0))
    return (out.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(one_in) * F.col("n_hit") >= F.col("n_words"))))


def _by_slices(docs: DataFrame, windows: DataFrame, fields, text, schema, limit: int) -> DataFrame:
    """More windows than one broadcast may hold: one scan per slice, of equal documents once, then
    the slices' spans and items are put together by text."""
    from tidemark.llm.stage import Scratch, fingerprint
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    windows = scratch.save(windows, "windows")
    texts = scratch.save(docs.select(fingerprint(text).alias("fp"), F.col(text).alias("t")).groupBy("fp").agg(F.first("t").alias("t")), "texts")
    n_slices = -(-windows.count() * 5 // (4 * limit))      # a fifth to spare for uneven hashing
    parts = []
    for i in range(n_slices):
        rows = windows.where(F.pmod("hash", F.lit(n_slices)) == i).collect()
        shared = spark.sparkContext.broadcast(_Slice(rows))
        found = texts.select("fp", F.col("t").alias("_scanned")).mapInArrow(
            _scan(shared, ["fp"]), f"fp binary, n_words long, spans {_SPANS}, items array<string>")
        parts.append(scratch.save(found, f"slice{i}"))
        shared.unpersist()
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    merged = every.groupBy("fp").agg(
        F.max("n_words").alias("n_words"), _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # the documents' columns and those found here travel apart: any of their names may be equal
    whole = docs.select(F.struct(*fields).alias("_doc"), fingerprint(text).alias("_fp"))
    found = merged.select(F.col("fp").alias("_found_fp"), F.struct("n_words", "spans", "items").alias("_found"))
    return whole.join(found, F.col("_fp") == F.col("_found_fp")).select("_doc.*", "_found.*")


def decontaminate(docs: DataFrame, items: DataFrame, *, text: str = "text", remove: str = "documents", **options) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove='spans'``) with the bytes from the first
    to the last word of every hit run cut out of every text. Same columns as ``docs``, also those
    that have names of the scan's columns; what is clean stays as it is."""
    others = [c for c in docs.columns if c != text]
    carried = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("_doc")] if others else []
    found = scan(docs.select(*carried, F.col(text).alias("_text")), items, text="_text", **options)
    kept = F.col("_text")
    if remove == "documents":
        found = found.where(~F.col("contaminated"))
    else:
        kept = F.when(F.size("spans") > 0, F.udf(_without, "string")(F.col("_text"), F.col("spans"))).otherwise(kept)
    return found.select(*[kept.alias(c) if c == text else F.col("_doc")[c].alias(c) for c in docs.columns])


def _without(text: str, spans) -> str:
    data, out, at = text.encode(), [], 0
    for s in spans:
        out.append(data[at:s["byte_lo"]])
        at = s["byte_hi"]
    return b"".join([*out, data[at:]]).decode()


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The contract's columns of a scan."""
    return found.select(
        F.col(doc_id).alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", F.filter("items", lambda x: x.isNotNull())).cast("binary"), 256).alias("items_sha256"), "contaminated")
