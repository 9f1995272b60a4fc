"""Toxicity by a factorization machine over hashed terms.

A document's terms are its lower-cased words and their beginnings and ends of a
few bytes, each a 64-bit hash. Which of them matter is counted on a bounded sample
of labelled documents: Spark sums in how many toxic and other documents each
term occurs, and the terms that tell most about the label are kept. A
factorization machine of second order is fitted on what of the sample is then
left, a few dozen term numbers per document: besides a weight per term it has a
vector per term, and the inner product of two vectors is the weight of their pair, so
that an insult together with the mention of a group counts though neither does
alone, which no additive weights can tell.

Terms, weights and vectors are of fixed size and are broadcast; a second pass
scores every whole text. Labels are read for the sample only; id, language and
source are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel
from tidemark.llm.stage import Scratch

#: Labelled documents that fit the model, of either label: the bound on the sample.
SAMPLE_TOXIC, SAMPLE_OTHER = 2_000, 4_000
TERMS = 1_024
RANK = 8
CUT = 0.7
#: A term is kept if this many documents of the sample have it.
LEAST_DOCS = 6

_HEADS, _TAILS = (3, 4, 5, 6, 7), (4, 5, 6)


def terms(chunk: kernel.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(document, term) of every word and of its first and last bytes; repeats included. Whole words
    and parts of equal bytes are different terms."""
    w = kernel.words(chunk, "alnum", lower=True)
    if not len(w.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rolling = kernel.Rolling(kernel._CODE[w.data])
    doc = np.repeat(np.arange(chunk.n), np.diff(w.bounds))
    size = w.ends - w.starts
    docs, codes = [doc], [rolling.windows(w.starts, w.ends)]
    for kind, lengths in ((1, _HEADS), (2, _TAILS)):
        for n in lengths:
            long = size > n
            at = w.starts[long] if kind == 1 else w.ends[long] - n
            docs.append(doc[long])
            codes.append(kernel.mix(rolling.windows(at, at + n) + np.uint64(kind)))
    return np.concatenate(docs), np.concatenate(codes)


def _sampled_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, other): documents of a chunk that have the term, by label."""
    for b in batches:
        label = b.column("label").to_numpy()
        for c in kernel.chunks(b.column("text")):
            doc, code = terms(c)
            pair = np.unique(np.rec.fromarrays((code, doc), names="code,doc"))
            codes, place = np.unique(pair.code, return_inverse=True)
            toxic = np.bincount(place, weights=label[c.first + pair.doc] > 0, minlength=len(codes)).astype(np.int64)
            both = np.bincount(place, minlength=len(codes))
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(toxic), pa.array(both - toxic)], ["term", "toxic", "other"])


class Terms:
    """A dictionary of hashed terms: numbers of those that are in it."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.sort(codes)
        self.maybe = np.zeros(1 << 20, bool)        # most terms of a text fail here
        self.maybe[(self.codes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def found(self, chunk: kernel.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """(document, number) of the terms of every document, each once."""
        doc, code = terms(chunk)
        likely = np.flatnonzero(self.maybe[(code & np.uint64((1 << 20) - 1)).astype(np.int64)])
        doc, code = doc[likely], code[likely]
        at = np.minimum(np.searchsorted(self.codes, code), max(len(self.codes) - 1, 0))
        if not len(self.codes):
            return doc[:0], at[:0]
        hit = self.codes[at] == code
        pairs = np.unique(doc[hit] * len(self.codes) + at[hit])
        return pairs // len(self.codes), pairs % len(self.codes)


@dataclass
class Machine:
    """bias, weights [term] and vectors [term, rank] of a factorization machine over binary terms; a
    document's value is bias + sum of its weights + sum over its pairs of the product of their vectors."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def value(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        linear = np.bincount(doc, weights=self.weights[term], minlength=n)
        total, squares = np.zeros((n, self.vectors.shape[1])), np.zeros((n, self.vectors.shape[1]))
        np.add.at(total, doc, self.vectors[term])
        np.add.at(squares, doc, self.vectors[term] ** 2)
        return self.bias + linear + 0.5 * (total ** 2 - squares).sum(axis=1)

    def score(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.value(doc, term, n), -30, 30)))


def train(docs: list[np.ndarray], labels: np.ndarray, n_terms: int, *, rank: int = RANK, rounds: int = 30, batch: int = 64,
          step: float = 0.1, decay: float = 3e-4, seed: int = 1) -> Machine:
    """Fit a machine to documents given as arrays of different term numbers, by AdaGrad on the logistic
    loss over shuffled batches; equal arguments give equal machines. Without documents, or with labels of
    one kind, only the bias is set."""
    rng = np.random.default_rng(seed)
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
    m = Machine(float(np.log(share / (1 - share))), np.zeros(n_terms), rng.normal(0, 0.05, (n_terms, rank)))
    if not len(docs) or labels.min() == labels.max():
        m.vectors[:] = 0
        return m
    seen_b, seen_w, seen_v = 1e-8, np.full(n_terms, 1e-8), np.full((n_terms, rank), 1e-8)
    sizes = np.array([len(d) for d in docs])
    flat, starts = np.concatenate(docs), np.concatenate(([0], np.cumsum(sizes)))
    for _ in range(rounds):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), batch):
            part = order[lo:lo + batch]
            term = np.concatenate([flat[starts[i]:starts[i + 1]] for i in part])
            doc = np.repeat(np.arange(len(part)), sizes[part])
            error = m.score(doc, term, len(part)) - labels[part]
            total = np.zeros((len(part), rank))
            np.add.at(total, doc, m.vectors[term])
            used, place = np.unique(term, return_inverse=True)
            g_w = np.bincount(place, weights=error[doc], minlength=len(used)) / len(part) + decay * m.weights[used]
            g_v = np.zeros((len(used), rank))
            np.add.at(g_v, place, error[doc][:, None] * (total[doc] - m.vectors[term]))
            g_v = g_v / len(part) + decay * m.vectors[used]
            g_b = error.mean()
            seen_b += g_b * g_b
            seen_w[used] += g_w * g_w
            seen_v[used] += g_v * g_v
            m.bias -= step * g_b / np.sqrt(seen_b)
            m.weights[used] -= step * g_w / np.sqrt(seen_w[used])
            m.vectors[used] -= step * g_v / np.sqrt(seen_v[used])
    return m


def learnable(doc_id):
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) != 1


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        toxic: int = SAMPLE_TOXIC, other: int = SAMPLE_OTHER, n_terms: int = TERMS, least: int = LEAST_DOCS, **training) -> tuple[Terms, Machine]:
    """Learn from at most ``toxic`` documents of label 1 and ``other`` of label 0, those with the smallest
    hashed ids among the labels that may be learned from. Of several texts of one id the least is
    taken, of several labels the highest."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = (labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isNotNull() & learnable(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label")))
    few = [known.where(which).orderBy(F.xxhash64("id"), "id").limit(n) for which, n in (("label > 0", toxic), ("label <= 0", other))]
    sample = scratch.save(
        docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .join(F.broadcast(few[0].unionByName(few[1])), "id").groupBy("id", "label").agg(F.min("text").alias("text")), "sample")
    counted = (sample.select("label", "text").mapInArrow(_sampled_terms, "term long, toxic long, other long")
               .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b")).where(F.col("a") + F.col("b") >= least))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("label") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    # how far the shares of toxic and other documents with the term lie apart, in standard deviations
    p = (F.col("a") + F.col("b")) / F.lit(float(max(1, n1 + n0)))
    apart = (F.col("a") / F.lit(float(max(1, n1))) - F.col("b") / F.lit(float(max(1, n0)))) ** 2 / F.greatest(p * (1 - p), F.lit(1e-9))
    chosen = counted.orderBy(F.desc(apart), "term").limit(n_terms).select("term").collect()
    dictionary = Terms(np.array([r["term"] for r in chosen], np.int64).view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in kernel.chunks(b.column("text")):
                doc, term = shared.value.found(c)
                cuts = np.searchsorted(doc, np.arange(c.n + 1))
                packed = [term[cuts[i]:cuts[i + 1]].astype(np.int16).tobytes() for i in range(c.n)]
                yield pa.RecordBatch.from_arrays([b.column("id").slice(c.first, c.n), b.column("label").slice(c.first, c.n), pa.array(packed, pa.binary())],
                                                 ["id", "label", "terms"])

    # of at most toxic + other documents, each at most n_terms numbers of two bytes
    rows = sorted(sample.select("id", "label", "text").mapInArrow(numbers, "id long, label int, terms binary").collect(), key=lambda r: r["id"])
    machine = train([np.frombuffer(r["terms"], np.int16).astype(np.int64) for r in rows], np.array([float(r["label"] > 0) for r in rows]),
                    len(dictionary.codes), **training)
    return dictionary, machine


def classify(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", cut: float = CUT, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; ``score`` between 0 and 1.

    Null and empty texts, and those without any known term, get the score of the bias alone. Texts of any
    length are read whole. Without usable labels, or with labels of one kind, all scores are the share
    of label 1, smoothed. A null id is not held out. Repeated rows get equal rows; an empty table gives
    none. Columns other than the id and the text, whatever their names, are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id=doc_id, text=text, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in kernel.chunks(b.column("text")):
                dictionary, machine = model.value
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(c.first, c.n), pa.array(machine.score(*dictionary.found(c), c.n))],
                                                 ["doc_id", "score"])

    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
