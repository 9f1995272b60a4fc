"""N-gram Jaccard self-join with an R-tree over count vectors.

A document's set of word shingles is hashed into groups; its point is the number
of shingles in each group. Whatever two sets share, they share within groups, so
the sum of coordinate minima bounds their overlap, and for two boxes of points
the best that any pair in them could reach follows from the boxes' corners.

1. One scan turns texts into sets. Equal sets become one point with a count.
2. The root of the tree bounds a set by the shingles that any other set has: in a
   sample of a quarter of all hashes, a set with more than 15 % of its size
   in shingles of its own can't link at all. Hashes are exchanged between
   batches, each distinct one once.
3. The remaining points are ordered and cut into nodes, nodes into leaves. Nodes
   are joined by size classes and boxes; within a pair of nodes leaves, then
   points, are compared by the same bound. Only points in surviving pairs are
   sent their sets, and a task verifies them exactly.
4. A task keeps counts of links and a spanning forest of them, never the pairs of
   a group; components follow from the forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernel
from tidemark.llm.stage import Scratch, fingerprint, hot_keys, lookup, ranked

SHINGLE = 4
PERCENT = 85            # a link: 100 * intersection >= PERCENT * union
GROUPS = 64
NODE = 1024
#: Shingles of a node's sets: nodes of long documents have fewer points, so that a task's memory is bounded.
NODE_SHINGLES = 1 << 22
LEAF = 32
COARSE = 4              # groups that are added up for the first, cheaper bound of two points
SAMPLE = 4              # of so many hashes one takes part in the root's bound
RANGE_KEYS = 1 << 19


# -- texts to sets ------------------------------------------------------------

def shingles(chunk: kernel.Chunk, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document: k words, or all if there are fewer."""
    w = kernel.words(chunk, lower=True)
    rolling = kernel.Rolling(w.codes())
    every = rolling.all(k)
    for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        if b - a >= k:
            h = np.sort(every[a:b - k + 1])
            yield h[np.concatenate(([True], h[1:] != h[:-1]))]
        elif b > a:
            yield rolling.windows(np.array([a]), np.array([b])) ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def signature(h: np.ndarray) -> bytes | None:
    """128 bits that stand for a whole set; none for the empty set."""
    if not len(h):
        return None
    n = np.array([len(h)])
    zero = np.array([0])
    return b"".join(kernel.Rolling(kernel.mix(h ^ np.uint64(salt))).windows(zero, n).tobytes() for salt in (1, 2))


def _sets(docs: DataFrame, k: int, sample: int) -> DataFrame:
    """(doc_id, fp, n, sig, sample) of every document of ``docs`` (doc_id, text, fp)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sig, some = [], [], []
            for c in kernel.chunks(b.column(1)):
                for h in shingles(c, k):
                    n.append(len(h))
                    sig.append(signature(h))
                    some.append(h[h % np.uint64(sample) == 0].tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(some, pa.binary())],
                                             ["doc_id", "fp", "n", "sig", "sample"])
    return docs.mapInArrow(run, f"doc_id {id_type}, fp binary, n long, sig binary, sample binary")


# -- the root's bound ---------------------------------------------------------

def _send_samples(bits: int, percent: int):
    """Hashes of a batch of sets by range: those that one set of the batch has, with its place, and
    those that several have (place -1), once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            uid = b.column(0).to_numpy()
            allowed = b.column(1).to_numpy() * (100 - percent) // 100
            parts = [np.frombuffer(x, np.uint64) for x in b.column(2).to_pylist()]
            keys = np.concatenate(parts)
            place = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
            order = np.argsort(keys, kind="stable")
            keys, place = keys[order], place[order]
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            begin = np.flatnonzero(new)
            single = np.diff(np.append(begin, len(keys))) == 1
            keys, place = keys[begin], np.where(single, place[begin], -1).astype(np.int32)
            part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
            cuts = np.searchsorted(part, np.arange((1 << bits) + 1))
            rows = [r for r in range(1 << bits) if r == 0 or cuts[r + 1] > cuts[r]]     # range 0 tells of every set
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array([int(uid[0])] * len(rows), pa.int64()),
                 pa.array([uid.tobytes()] * len(rows), pa.binary()), pa.array([allowed.astype(np.int64).tobytes()] * len(rows), pa.binary()),
                 pa.array([keys[cuts[r]:cuts[r + 1]].tobytes() for r in rows], pa.binary()),
                 pa.array([place[cuts[r]:cuts[r + 1]].tobytes() for r in rows], pa.binary())],
                ["range", "batch", "uids", "allowed", "keys", "places"])
    return run


def _own_shingles(t: pa.Table) -> pa.Table:
    """For each batch: how many of each set's hashes in this range no other set has."""
    parts = [np.frombuffer(x, np.uint64) for x in t["keys"].to_pylist()]
    places = [np.frombuffer(x, np.int32) for x in t["places"].to_pylist()]
    keys = np.concatenate(parts)
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    own = np.split(count[inverse] == 1, np.cumsum([len(p) for p in parts])[:-1])
    counts = [np.bincount(p[o & (p >= 0)], minlength=len(u) // 8).astype(np.int32).tobytes()
              for p, o, u in zip(places, own, t["uids"].to_pylist())]
    return pa.table({"batch": t["batch"], "uids": t["uids"], "allowed": t["allowed"], "counts": pa.array(counts, pa.binary())})


def _within(t: pa.Table) -> pa.Table:
    """The sets of a batch that have no more shingles of their own than a link allows."""
    total = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in t["counts"].to_pylist())
    uid, allowed = (np.frombuffer(t[c][0].as_py(), np.int64) for c in ("uids", "allowed"))
    return pa.table({"uid": pa.array(uid[total <= allowed])})


# -- points and boxes ---------------------------------------------------------

def vector(h: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    return np.bincount(((h >> np.uint64(24)) % np.uint64(groups)).astype(np.int64), minlength=groups)


def best_excess(alo, ahi, blo, bhi, percent: int = PERCENT) -> np.ndarray:
    """100 + percent times the most that sum(min(a, b)) can exceed the overlap which a link needs,
    percent / (100 + percent) * (sum(a) + sum(b)), for a and b in boxes. Negative: no link between them."""
    m = np.minimum(ahi, bhi)
    a, b = np.maximum(alo, m), np.maximum(blo, m)
    return ((100 + percent) * np.minimum(a, b) - percent * (a + b)).sum(axis=-1)


def _points(percent: int, k: int):
    """(uid, n, rep, copies, v, set) of the documents that stand for their set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid, want = b.column(1), b.column(2).to_pylist()
            keep, v, sets, at = [], [], [], 0
            for c in kernel.chunks(b.column(0)):
                for h in shingles(c, k):
                    if signature(h) == want[at]:
                        keep.append(at)
                        v.append(vector(h).astype(np.int32).tobytes())
                        sets.append(h.tobytes())
                    at += 1
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([uid.take(keep), b.column(3).take(keep), b.column(4).take(keep), pa.array(v, pa.binary()), pa.array(sets, pa.binary())],
                                             ["uid", "n", "copies", "v", "set"])
    return run


def _matrix(t: pa.Table, column: str = "v") -> np.ndarray:
    return np.frombuffer(b"".join(t[column].to_pylist()), np.int32).reshape(t.num_rows, -1).astype(np.int64)


def _box(t: pa.Table) -> pa.Table:
    v, n = _matrix(t), t["n"].to_numpy()
    return pa.table({"node": t["node"].slice(0, 1), "least": pa.array([int(n.min())]), "most": pa.array([int(n.max())]),
                     "lo": pa.array([v.min(axis=0).tolist()], pa.list_(pa.int64())), "hi": pa.array([v.max(axis=0).tolist()], pa.list_(pa.int64()))})


def _leaves(v: np.ndarray) -> list[np.ndarray]:
    """Points cut into leaves: halved at the median of the widest coordinate until they are small."""
    out, todo = [], [np.arange(len(v))]
    while todo:
        part = todo.pop()
        if len(part) <= LEAF:
            out.append(part)
            continue
        widest = int(np.argmax(v[part].max(axis=0) - v[part].min(axis=0)))
        part = part[np.argsort(v[part, widest], kind="stable")]
        todo += [part[:len(part) // 2], part[len(part) // 2:]]
    return out


class _Bound:
    """The bound of the points of a leaf against many others: over sums of ``COARSE`` groups first, which is
    never below that over the groups, then over the groups of what is left. Sums of minima are at
    most the larger size, so they are kept in integers that just hold it, a group in a row."""

    def __init__(self, a: np.ndarray, b: np.ndarray, percent: int):
        self.percent, self.size_a, self.size_b = percent, a.sum(axis=1), b.sum(axis=1)
        most = max(int(self.size_a.max(initial=0)), int(self.size_b.max(initial=0)))
        self.kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
        fold = lambda v: np.add.reduceat(v, np.arange(0, v.shape[1], COARSE), axis=1)
        self.a, self.b, self.coarse_a, self.coarse_b = (v.astype(self.kind) for v in (a, b, fold(a), fold(b)))

    def pairs(self, part: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``part`` and ``other`` of the pairs that can link."""
        def shared(x, y):
            return np.minimum(x[:, None], y).sum(axis=0, dtype=self.kind)

        coarse, fine = np.ascontiguousarray(self.coarse_b[other].T), np.ascontiguousarray(self.b[other].T)
        # the least overlap of a link: percent / (100 + percent) of both sizes, rounded up
        need = -(-self.percent * (self.size_a[part][:, None] + self.size_b[other]) // (100 + self.percent))
        need, found = need.astype(self.kind), []
        for p, least in zip(part, need):
            at = np.flatnonzero(shared(self.coarse_a[p], coarse) >= least)
            if 2 * len(at) > len(other):
                at = np.flatnonzero(shared(self.a[p], fine) >= least)
            elif len(at):
                at = at[shared(self.a[p], fine[:, at]) >= least[at]]
            found.append(at)
        return np.repeat(np.arange(len(part)), [len(x) for x in found]), np.concatenate(found)


def candidates(a: np.ndarray, b: np.ndarray, percent: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of points whose bound allows a link, some at a time; with ``same`` (a is b) only i < j."""
    bound = _Bound(a, b, percent)
    la, lb = _leaves(a), None
    lb = la if same else _leaves(b)
    boxes = lambda x, leaves: (np.array([x[p].min(axis=0) for p in leaves]), np.array([x[p].max(axis=0) for p in leaves]))
    (alo, ahi), (blo, bhi) = boxes(a, la), boxes(b, lb)
    for i, part in enumerate(la):
        meet = np.flatnonzero(best_excess(alo[i], ahi[i], blo, bhi, percent) >= 0)
        if same:
            meet = meet[meet >= i]
        if not len(meet):
            continue
        other = np.concatenate([lb[j] for j in meet])
        leaf = np.repeat(meet, [len(lb[j]) for j in meet])
        p, q = bound.pairs(part, other)
        if same:        # within one leaf each pair once; pairs of leaves come once as j > i
            once = (leaf[q] > i) | (part[p] < other[q])
            p, q = p[once], q[once]
        if len(p):
            yield part[p], other[q]


def _candidate_points(percent: int):
    """Points of two nodes that are in any candidate pair."""
    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        same = not b.num_rows
        va, ua = _matrix(a), a["uid"].to_numpy()
        vb, ub = (va, ua) if same else (_matrix(b), b["uid"].to_numpy())
        left, right = np.zeros(len(ua), bool), np.zeros(len(ub), bool)
        for p, q in candidates(va, vb, percent, same):
            left[p] = True
            right[q] = True
        if same:
            left |= right
            right[:] = False
        uid = np.concatenate((ua[left], ub[right]))
        return pa.table({"x": pa.array([a["x"][0].as_py()] * len(uid), pa.int64()), "y": pa.array([a["y"][0].as_py()] * len(uid), pa.int64()),
                         "side": pa.array(np.repeat([0, 1], [int(left.sum()), int(right.sum())]).astype(np.int32)), "uid": pa.array(uid)})
    return run


def overlaps(sets_a: list[np.ndarray], sets_b: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs (p, q). Few pairs are merged one by one; many between few
    sets, as among near copies, are counted together as a product of incidence matrices."""
    rows, cols = np.unique(p), np.unique(q)
    if len(p) < 4 * (len(rows) + len(cols)):
        return np.array([np.isin(sets_a[i], sets_b[j], assume_unique=True).sum() if len(sets_a[i]) < 64 else
                         len(sets_a[i]) + len(sets_b[j]) - len(np.union1d(sets_a[i], sets_b[j])) for i, j in zip(p, q)], np.int64)
    vocabulary = np.unique(np.concatenate([sets_a[i] for i in rows]))
    total = np.zeros((len(rows), len(cols)), np.float32)
    places = lambda sets, keys: [np.searchsorted(vocabulary, sets[k]) for k in keys]
    at_a, at_b = places(sets_a, rows), places(sets_b, cols)
    for i, j in enumerate(cols):
        ok = at_b[i] < len(vocabulary)
        at_b[i] = at_b[i][ok][vocabulary[at_b[i][ok]] == sets_b[j][ok]]
    step = 4096
    for lo in range(0, len(vocabulary), step):
        def incidence(at):
            m = np.zeros((len(at), step), np.float32)
            for r, x in enumerate(at):
                m[r, x[np.searchsorted(x, lo):np.searchsorted(x, lo + step)] - lo] = 1
            return m
        total += incidence(at_a) @ incidence(at_b).T
    return np.rint(total[np.searchsorted(rows, p), np.searchsorted(cols, q)]).astype(np.int64)


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return int(i)


def _verify(percent: int):
    """Links of the points of two nodes: for each point how many documents it links to, and a spanning
    forest (rows with ``to``) of what is linked."""
    def run(t: pa.Table) -> pa.Table:
        side, uid, copies = t["side"].to_numpy(), t["uid"].to_numpy(), t["copies"].to_numpy()
        sets, v, n = [np.frombuffer(x, np.uint64) for x in t["set"].to_pylist()], _matrix(t), t["n"].to_numpy()
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = bool(t["x"][0].as_py() == t["y"][0].as_py())
        if same:
            b = a
        links, parent, edges = np.zeros(len(uid), np.int64), np.arange(len(uid)), []
        for p, q in candidates(v[a], v[b], percent, same):
            shared = overlaps([sets[i] for i in a], [sets[j] for j in b], p, q)
            i, j = a[p], b[q]
            on = 100 * shared >= percent * (n[i] + n[j] - shared)
            i, j = i[on], j[on]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            for x, y in zip(i.tolist(), j.tolist()):
                rx, ry = _find(parent, x), _find(parent, y)
                if rx != ry:
                    parent[ry] = rx
                    edges.append((x, y))
        some = np.flatnonzero(links)
        return pa.table({"uid": pa.array(np.concatenate((uid[some], uid[[x for x, _ in edges]]))),
                         "links": pa.array(np.concatenate((links[some], np.zeros(len(edges), np.int64)))),
                         "to": pa.array([None] * len(some) + [int(uid[y]) for _, y in edges], pa.int64())})
    return run


# -- components ---------------------------------------------------------------

def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the smallest node that is reachable, for every node of ``edges`` (a, b).

    Each round takes the least label of a node's neighbours, then that label's own label, and is
    written to the shared folder; paths shorten at least by half a round. A node with very many
    neighbours, or a label that very many nodes have, is looked up without gathering these.
    """
    both = scratch.save(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = scratch.save(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).withColumnRenamed("a", "node"), "labels")
    hubs = hot_keys(both, "b", scratch)
    while True:
        near = lookup(both, "b", labels, "node", hubs).groupBy("a").agg(F.min("root").alias("near"))
        stepped = labels.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "near").alias("stepped"))
        stepped = scratch.save(stepped, "stepped")
        up = stepped.select(F.col("node").alias("up"), F.col("stepped").alias("above"))
        common = hot_keys(stepped, "stepped", scratch)
        jumped = scratch.save(lookup(stepped, "stepped", up, "up", common).select("node", "root", F.col("above").alias("new")), "jumped")
        changed = jumped.where(F.col("new") < F.col("root")).limit(1).count()
        scratch.drop(labels, stepped)
        labels = scratch.save(jumped.select("node", F.col("new").alias("root")), "labels")
        scratch.drop(jumped)
        if not changed:
            return labels


# -- the join -----------------------------------------------------------------

def jaccard_join(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT,
                 sample: int = SAMPLE, node_points: int = NODE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles (size of its set), component_id (the smallest
    doc_id reachable over links) and n_links (other rows it links to).

    Two sets link when 100 * intersection >= percent * union. A text without words, or null, has the
    empty set: it links with nothing and is its own component. Repeated rows link with each other. A
    null doc_id takes part, but is the smallest of a component only if there is no other id in it
    (then component_id is null). An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), fingerprint(text).alias("fp"))
    sampled = scratch.save(_sets(docs, k, sample), "sets")
    distinct = scratch.save(
        sampled.where(F.col("sig").isNotNull()).groupBy("sig").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp")).alias("least"), F.count("*").alias("copies"),
            F.first("n").alias("n"), F.first("sample").alias("sample"))
        .withColumn("rep", F.col("least.doc_id")).withColumn("rep_fp", F.col("least.fp")).drop("least").withColumn("uid", F.monotonically_increasing_id()), "distinct")
    # the samples are large and serve the root's bound only
    sets = scratch.save(sampled.drop("sample", "fp"), "sets-without-samples")
    scratch.drop(sampled)

    n_hashes = distinct.agg(F.coalesce(F.sum(F.length("sample")), F.lit(0))).first()[0] // 8
    bits = max(0, int(np.ceil(np.log2(max(1, n_hashes / RANGE_KEYS)))))
    sent = distinct.select("uid", "n", "sample").mapInArrow(
        _send_samples(bits, percent), "range long, batch long, uids binary, allowed binary, keys binary, places binary")
    own = sent.groupBy("range").applyInArrow(_own_shingles, "batch long, uids binary, allowed binary, counts binary")
    chosen = scratch.save(own.groupBy("batch").applyInArrow(_within, "uid long"), "within-bound")
    reps = scratch.save(distinct.drop("sample"), "distinct-without-samples")
    scratch.drop(distinct)

    who = chosen.join(reps.select("uid", "sig", "rep", "rep_fp", "n", "copies"), "uid")
    # the texts again, of the documents that stand for these sets; a text has one set, so a row meets
    # one of them at most, however many rows have its id or none
    points = (docs.join(who, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("fp") == F.col("rep_fp"))).select("text", "uid", "sig", "n", "copies")
              .mapInArrow(_points(percent, k), "uid long, n long, copies long, v binary, set binary").dropDuplicates(["uid"]))
    points = scratch.save(points, "points")

    placed = ranked(points.select("uid", "n", "v"), [F.col("n"), F.col("v"), F.col("uid")], scratch)
    # sets of a node have sizes of as many binary digits
    digits = F.length(F.bin("n"))
    points_of_node = F.greatest(F.lit(1), F.least(F.lit(node_points), F.floor(F.lit(NODE_SHINGLES) / F.pow(F.lit(2), digits))))
    placed = scratch.save(placed.withColumn("node", digits.cast("long") * (1 << 48) + F.floor(F.col("_rank") / points_of_node)).drop("_rank"), "tree")
    nodes = scratch.save(placed.groupBy("node").applyInArrow(_box, "node long, least long, most long, lo array<bigint>, hi array<bigint>"), "nodes")
    # sizes of linked sets differ by a factor of percent/100 at most: by one class at most
    ratio = float(np.log(100 / percent)) * 1.0001
    klass = lambda c: F.floor(F.log(c) / ratio)
    left = nodes.select(F.col("node").alias("x"), "least", "most", F.col("lo").alias("xlo"), F.col("hi").alias("xhi"),
                        F.explode(F.sequence(klass(F.col("least")), klass(F.col("most")))).alias("class"))
    right = nodes.select(F.col("node").alias("y"), F.col("lo").alias("ylo"), F.col("hi").alias("yhi"),
                         F.explode(F.sequence(klass(F.col("least")) - 1, klass(F.col("most")) + 1)).alias("class"))
    m = F.zip_with("xhi", "yhi", lambda p, q: F.least(p, q))
    reach = F.zip_with(F.zip_with("xlo", m, lambda p, q: F.greatest(p, q)), F.zip_with("ylo", m, lambda p, q: F.greatest(p, q)),
                       lambda a, b: (100 + percent) * F.least(a, b) - percent * (a + b))
    pairs = scratch.save(left.join(right, "class").where(F.col("x") <= F.col("y"))
                         .where((F.col("x") == F.col("y")) | (F.aggregate(reach, F.lit(0).cast("long"), lambda s, e: s + e) >= 0))
                         .select("x", "y").distinct(), "node-pairs")
    of = lambda side: placed.select("uid", "v", F.col("node").alias(f"n{side}")).join(pairs, F.col(f"n{side}") == F.col(side)).select("x", "y", "uid", "v")
    involved = (of("x").groupBy("x", "y").cogroup(of("y").where(F.col("x") != F.col("y")).toDF("x", "y", "uid", "v").groupBy("x", "y"))
                .applyInArrow(_candidate_points(percent), "x long, y long, side int, uid long"))
    involved = scratch.save(involved, "candidates")
    found = scratch.save(involved.join(points, "uid").groupBy("x", "y").applyInArrow(_verify(percent), "uid long, links long, to long"), "links")

    root = components(found.where(F.col("to").isNotNull()).select(F.col("uid").alias("a"), F.col("to").alias("b")), scratch)
    members = scratch.save(root.join(reps.select("uid", "rep"), F.col("node") == F.col("uid")).select("node", "root", "rep"), "members")
    smallest = members.groupBy("root").agg(F.min("rep").alias("component")).withColumnRenamed("root", "r")
    members = lookup(members, "root", smallest, "r", hot_keys(members, "root", scratch)).select("node", "component", F.lit(True).alias("in_one"))
    linked = found.groupBy("uid").agg(F.sum("links").alias("links")).withColumnRenamed("uid", "lu")
    answer = (reps.select("uid", F.col("sig").alias("s"), "rep", "copies")
              .join(members, F.col("uid") == F.col("node"), "left").join(linked, F.col("uid") == F.col("lu"), "left")
              .select("s", F.when(F.col("in_one"), F.col("component")).otherwise(F.col("rep")).alias("component"),
                      (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    answer = scratch.save(answer, "answer")
    with_words = sets.where(F.col("sig").isNotNull())
    some = lookup(with_words, "sig", answer, "s", hot_keys(with_words, "sig", scratch)).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "n_links")
    none = sets.where(F.col("sig").isNull()).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return some.unionByName(none)


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; same columns, which travel
    in one struct, so that no name of theirs meets one used here. Rows of this id that repeat the same
    text become one; rows without an id are not judged and stay."""
    joined = jaccard_join(docs, doc_id=doc_id, text=text, **options)
    keep = joined.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), fingerprint(f"`{text}`").alias("fp"))
    once = rows.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id", "fp"])
    return once.unionByName(rows.where(F.col("doc_id").isNull())).select("row.*")
