"""Quality by nearest-neighbour voting in a latent semantic space.

Terms are hashed: each word as it stands, its shape (runs of upper, lower, digit
and other signs), and whether it repeats the word before it. Document
frequencies come from the whole corpus in one pass with map-side sums. A
bounded sample of labelled documents fixes the latent axes (truncated SVD of
its weighted term matrix) and supplies the labelled vectors; axes and vectors
are of fixed size and are broadcast. A second pass projects every whole
document and takes its exact cosines with all labelled vectors, block by block;
the nearest vote, weighted by similarity.

Labels are read for the labelled sample only; id, language and source are never
inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import kernel

TERMS = 4096
RANK = 48
NEIGHBOURS = 15
#: Labelled documents that fit the axes and vote: a bound on what is collected and broadcast.
SAMPLE = 4000
CUT = 0.3

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B] = 0x41
_SHAPE[0x61:0x7B] = 0x61
_SHAPE[0x30:0x3A] = 0x39
_SHAPE[0x80:] = 0x61


def counts(chunk: kernel.Chunk, terms: int = TERMS) -> np.ndarray:
    """Counts of hashed terms, [document, term]; a quarter of the terms are words, a quarter pairs of
    a word with its predecessor's equality, the rest shapes and pairs of shapes."""
    w = kernel.words(chunk)
    n = len(w.starts)
    doc = np.repeat(np.arange(chunk.n), np.diff(w.bounds))
    codes = w.codes()
    shape = _SHAPE[w.data]
    begin = np.zeros(len(shape), bool)
    begin[w.starts] = True
    keep = begin.copy()
    keep[1:] |= shape[1:] != shape[:-1]
    kept = np.concatenate(([0], np.cumsum(keep)))
    shapes = kernel.Rolling(kernel._CODE[shape[keep]]).windows(kept[w.starts], kept[w.ends])
    first = np.zeros(n, bool)
    first[w.bounds[:-1][np.diff(w.bounds) > 0]] = True
    same = np.zeros(n, bool)
    same[1:] = codes[1:] == codes[:-1]
    same &= ~first
    pair = np.concatenate((np.zeros(1, np.uint64), shapes[:-1]))[:n]
    pair = kernel.mix(np.where(first, np.uint64(0), pair) * np.uint64(3) + shapes)
    q = np.uint64(terms // 4)
    index = np.concatenate((codes % q, q + shapes % q, 2 * q + pair % q, 3 * q + same.astype(np.uint64))).astype(np.int64)
    return np.bincount(np.tile(doc, 4) * terms + index, minlength=chunk.n * terms).reshape(chunk.n, terms)


def _batches(column: pa.Array) -> Iterator[np.ndarray]:
    """Counts of the documents of a batch, some at a time."""
    for c in kernel.chunks(column):
        for lo in range(0, c.n, 256):
            hi = min(lo + 256, c.n)
            a, z = int(c.offsets[lo]), int(c.offsets[hi])
            yield counts(kernel.Chunk(c.first + lo, c.data[a:z], c.offsets[lo:hi + 1] - a))


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and how many documents there are: of all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(TERMS, np.int64), 0
        for b in batches:
            for x in _batches(b.column(0)):
                df += (x > 0).sum(axis=0)
            n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, TERMS)), pa.array(np.concatenate(([n], df)))], ["term", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(TERMS, np.int64), 0
    for r in rows:
        if r["term"] < 0:
            n = r["n"]
        else:
            df[r["term"]] = r["n"]
    return df, n


@dataclass
class Model:
    """idf, axes [term, rank], labelled unit vectors [sample, rank], their labels, and their mean label."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def weigh(self, x: np.ndarray) -> np.ndarray:
        y = (np.log1p(x) * self.idf).astype(np.float32)
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)

    def project(self, x: np.ndarray) -> np.ndarray:
        z = self.weigh(x) @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """Share of the votes for label 1 among the k most similar, by exact cosines with all."""
        if not len(self.vectors):
            return np.full(len(x), self.prior)
        cosine = self.project(x) @ self.vectors.T
        k = min(k, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1).astype(np.float64), 0) ** 8
        small = 1e-3
        return ((weight * self.labels[near]).sum(axis=1) + small * self.prior) / (weight.sum(axis=1) + small)


def learnable(doc_id):
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) != 0


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE, rank: int = RANK) -> Model:
    """Learn from at most ``sample`` labelled documents (those with the smallest hashed ids) whose
    labels may be learned from; document frequencies are those of all ``docs``."""
    df, n = document_frequencies(docs, text)
    idf = np.log((1 + n) / (1 + df))
    known = (labels.select(F.col(doc_id).alias("label_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("label_id").isNotNull() & F.col("label").isNotNull() & learnable(F.col("label_id")))
             .groupBy("label_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("label_id"), "label_id").limit(sample))

    def term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [pa.array([np.flatnonzero(r).astype(np.int32).tobytes() for r in x], pa.binary()) for x in _batches(b.column(2))]
            values = [pa.array([r[r > 0].astype(np.int32).tobytes() for r in x], pa.binary()) for x in _batches(b.column(2))]
            if packed:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.concat_arrays(packed), pa.concat_arrays(values)],
                                                 ["label_id", "label", "terms", "n"])

    # of repeated ids the first text by order votes, so that the sample stays within its bound
    texts = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), F.col("id") == F.col("label_id"))
             .groupBy("label_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")))
    rows = texts.mapInArrow(term_rows, "label_id long, label int, terms binary, n binary").collect()
    rows.sort(key=lambda r: r["label_id"])
    x = np.zeros((len(rows), TERMS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["terms"], np.int32)] = np.frombuffer(r["n"], np.int32)
    y = np.array([r["label"] for r in rows], np.float64)
    model = Model(idf, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), y, float(y.mean()) if len(y) else 0.5)
    if len(rows):
        model.axes = _axes(model.weigh(x), min(rank, len(rows)))
        model.vectors = model.project(x).astype(np.float32)
    return model


def _axes(x: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors of x, by subspace iteration from a fixed start."""
    q = np.random.default_rng(1).standard_normal((x.shape[1], rank + 8)).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    values, vectors = np.linalg.eigh((x @ q).T.astype(np.float64) @ (x @ q))
    return (q @ vectors[:, ::-1][:, :rank].astype(np.float32)).astype(np.float32)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out`` (0 to 1) for every row; null and empty texts get the share of
    label 1 in the sample."""
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    docs = docs.select(*[c for c in docs.columns if c != out])
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.score(x) for x in _batches(b.column(len(names)))]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())],
                                             [*names, out])

    return docs.select("*", F.col(text).alias("_scored")).mapInArrow(run, docs.withColumn(out, F.lit(0.0)).schema)


def classify(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", cut: float = CUT, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``. Without any usable label all
    scores are 0.5; a null id is not held out; repeated rows get equal rows; an empty table gives none."""
    model = fit(docs, labels, doc_id=doc_id, text=text, **options)
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return score(base.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT, **options) -> DataFrame:
    """``docs`` without the rows that the classifier rejects (score below ``cut``); same columns, which
    travel in one struct, so that no name of theirs meets one of the classifier's."""
    model = fit(docs, labels, **options)
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{options.get('text', 'text')}`").alias("text"))
    return score(rows, model).where(F.col("score") >= cut).select("row.*")
