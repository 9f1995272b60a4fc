"""Hard-negative mining with cover trees over norm-augmented candidates.

Vectors are quantised to integers. A component sqrt(M^2 - |x|^2), M the largest
norm of a tree, puts all its candidates on one sphere; for an anchor, whose
added component is 0, the inner product with a candidate is then |q| M times the
cosine of an angle, and by the triangle inequality all candidates within the
angle w of a node's centre have scores between |q| M cos(a + w) and
|q| M cos(a - w), where a is the angle of the centre itself.

A level of a cover tree is a net: centres chosen farthest first, the parent's
centre before all others, until the covering radius has halved or FAN centres
are chosen. So centres are at least as far apart as any candidate is from its
centre, whatever the level's radius is. Nodes of up to LEAF candidates, or of equal
ones, are leaves.

Candidates are dealt by hash to shards of bounded size, which hold one tree per
label. Batches of anchors meet shards in tasks of their own. An anchor goes through
a shard's nodes by falling bound, skips nodes outside all of its score windows
and those that can't reach its k-th score, and takes exact integer products
at the leaves. A first round over one shard per anchor gives the k-th scores that
all other shards start from. No side is broadcast or collected.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stage import Scratch
from tidemark.llm.topk import quantise

LEAF = 128
FAN = 16
SHARD = 8_192
SHARD_BYTES = 1 << 25
BATCH = 2_048
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _augmented(x: np.ndarray) -> tuple[np.ndarray, float]:
    norm = np.sqrt((x * x).sum(axis=1))
    most = float(norm.max(initial=0.0))
    return np.column_stack((x, np.sqrt(np.maximum(most * most - norm * norm, 0)))), most


def _net(y: np.ndarray, first: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres among the points y, farthest first from y[first] on, until the covering radius has
    halved or there are FAN of them; the centre (its number) and distance of every point."""
    centres, owner = [first], np.zeros(len(y), np.int64)
    away = np.sqrt(((y - y[first]) ** 2).sum(axis=1))
    stop = away.max() / 2
    while len(centres) < FAN and away.max() > stop:
        c = int(np.argmax(away))
        d = np.sqrt(((y - y[c]) ** 2).sum(axis=1))
        nearer = d < away
        owner[nearer], away[nearer] = len(centres), d[nearer]
        centres.append(c)
    return centres, owner, away


@dataclass
class Tree:
    """Nodes in the order of their levels; those of one parent stand together. Node i covers the
    candidates low[i] .. high[i]-1 of the tree's order; its children are child[i] .. end[i]-1."""

    centre: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray


def build_tree(x: np.ndarray) -> tuple[np.ndarray, Tree]:
    """The order of the candidates x (integers, one per row) and their cover tree; radii are angles."""
    y, most = _augmented(x.astype(np.float64))
    angle = lambda chord: 2 * np.arcsin(np.minimum(chord / (2 * most), 1.0)) if most else chord
    start = int(np.argmin(((y - y.mean(axis=0)) ** 2).sum(axis=1)))
    reach = float(np.sqrt(((y - y[start]) ** 2).sum(axis=1)).max())
    order, nodes, at = np.arange(len(x)), [[start, reach, 0, 0, 0, len(x)]], 0
    while at < len(nodes):
        centre, chord, _, _, lo, hi = nodes[at]
        if hi - lo > LEAF and chord > 0:
            own = order[lo:hi].copy()
            centres, owner, away = _net(y[own], int(np.flatnonzero(own == centre)[0]))
            by_owner = np.argsort(owner, kind="stable")
            sizes = np.bincount(owner, minlength=len(centres))
            order[lo:hi] = own[by_owner]
            nodes[at][2:4] = len(nodes), len(nodes) + len(centres)
            begin = lo
            for k, (c, n) in enumerate(zip(centres, sizes)):
                nodes.append([int(own[c]), float(away[owner == k].max()), 0, 0, begin, begin + int(n)])
                begin += int(n)
        at += 1
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    cols = list(zip(*nodes))
    ints = lambda c: np.array(c, np.int64)
    return order, Tree(place[ints(cols[0])], angle(np.array(cols[1])), *map(ints, cols[2:]))


def build_forest(t: pa.Table) -> pa.Table:
    """One row for a shard: candidates in tree order and the nodes of its trees, one tree per label."""
    flat = pa.concat_arrays([c.flatten() for c in t["q"].chunks]) if t.num_rows else pa.array([], pa.int64())
    x = flat.to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
    ids, rows, labels = (t[c].to_numpy() for c in ("vec_id", "row", "label"))
    parts: dict[str, list] = {k: [] for k in ("x", "ids", "rows", "centre", "radius", "child", "end", "low", "high")}
    roots, first_node, first_row = [], 0, 0
    for label in np.unique(labels):
        own = np.flatnonzero(labels == label)
        order, tree = build_tree(x[own])
        own = own[order]
        roots.append((int(label), first_node, first_row, first_row + len(own)))
        for k, v in (("x", x[own]), ("ids", ids[own]), ("rows", rows[own]), ("centre", tree.centre + first_row), ("radius", tree.radius),
                     ("child", tree.child + first_node * (tree.end > 0)), ("end", tree.end + first_node * (tree.end > 0)),
                     ("low", tree.low + first_row), ("high", tree.high + first_row)):
            parts[k].append(v)
        first_node, first_row = first_node + len(tree.centre), first_row + len(own)
    packed = {k: pa.array([np.concatenate(v).tobytes()], pa.binary()) for k, v in parts.items()}
    return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "shard": pa.array([t["shard"][0].as_py()], pa.int64()),
                     "roots": pa.array([np.array(roots, np.int64).tobytes()], pa.binary()), **packed})


_FOREST = "dim int, shard long, roots binary, " + ", ".join(
    f"{c} binary" for c in ("x", "ids", "rows", "centre", "radius", "child", "end", "low", "high"))


class Forest:
    """A shard's trees, to be searched; ``verified`` counts exact products taken so far."""

    def __init__(self, t: pa.Table):
        read = lambda c, kind=np.int64: np.frombuffer(t[c][0].as_py(), kind)
        self.ids, self.rows = read("ids"), read("rows")
        self.x = read("x").reshape(len(self.ids), -1)
        self.roots = read("roots").reshape(-1, 4)
        self.centre, self.radius = read("centre"), read("radius", np.float64)
        self.child, self.end, self.low, self.high = (read(c) for c in ("child", "end", "low", "high"))
        x = self.x.astype(np.float64)
        self.most = {int(r[0]): float(np.sqrt((x[r[2]:r[3]] ** 2).sum(axis=1)).max()) for r in self.roots}
        self.tree_most = np.zeros(len(self.centre))
        ends = [*self.roots[1:, 1], len(self.centre)]
        for (label, lo, _, _), hi in zip(self.roots, ends):
            self.tree_most[lo:hi] = self.most[int(label)]
        self.largest = float(np.abs(x).max(initial=0.0))
        self.as_float = x
        self.centres = x[self.centre]
        self.cos, self.sin = np.cos(self.radius), np.sin(self.radius)
        self.verified = 0

    def bounds(self, nodes, q: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score that a candidate below each node can have, some rounding allowed for."""
        scale = norm * self.tree_most[nodes]
        c = np.clip((self.centres[nodes] @ q) / np.maximum(scale, 1e-300), -1, 1)
        s, cw, sw = np.sqrt(1 - c * c), self.cos[nodes], self.sin[nodes]
        slack = 1e-6 + 1e-7 * scale
        # cos(a + w) and cos(a - w), where these angles stay between 0 and pi
        low, high = np.where(c <= -cw, -1.0, c * cw - s * sw), np.where(c >= cw, 1.0, c * cw + s * sw)
        return scale * low - slack, scale * high + slack

    def search(self, q: np.ndarray, roots: np.ndarray, own: int, windows: np.ndarray, k: int) -> list[list[tuple]]:
        """For each window (least, largest score) the k best (-score, vec_id, row) within it, best first;
        ties at the k-th place are kept by vec_id."""
        qf = q.astype(np.float64)
        norm = float(np.sqrt(qf @ qf))
        exact = self.largest * float(np.abs(qf).max(initial=0.0)) * max(1, len(q)) < 2.0 ** 52
        points, qe = (self.as_float, qf) if exact else (self.x, q)
        need, high = windows[:, 0].copy(), windows[:, 1]    # a score below need can't come in any more
        found: list[list[tuple]] = [[] for _ in windows]
        heap: list[tuple[float, int]] = []
        top, bottom = high.max(initial=_LOW), need.min(initial=_HIGH)

        def push(nodes: np.ndarray) -> None:
            least, most = self.bounds(nodes, qf, norm)
            upto = high.astype(np.float64)
            reach = np.minimum(most[:, None], upto)
            fits = (reach >= need.astype(np.float64)) & (least[:, None] <= upto)
            ahead = np.where(fits, reach, -np.inf).max(axis=1, initial=-np.inf)
            for i in np.flatnonzero(ahead > -np.inf):
                heapq.heappush(heap, (-float(ahead[i]), int(nodes[i])))

        if len(roots):
            push(roots)
        while heap:
            best, node = heapq.heappop(heap)
            if -best < float(bottom):
                break
            if self.end[node]:
                push(np.arange(self.child[node], self.end[node]))
                continue
            lo, hi = int(self.low[node]), int(self.high[node])
            self.verified += hi - lo
            scores = points[lo:hi] @ qe
            if not len(windows) or not ((scores >= bottom) & (scores <= top)).any():
                continue
            for w in range(len(windows)):
                hit = np.flatnonzero((scores >= need[w]) & (scores <= high[w]) & (self.rows[lo:hi] != own))
                if len(hit):
                    both = found[w] + [(-int(scores[i]), int(self.ids[lo + i]), int(self.rows[lo + i])) for i in hit]
                    found[w] = heapq.nsmallest(k, both)
                    if len(found[w]) == k:
                        need[w] = max(need[w], -found[w][-1][0])
            bottom = need.min()
        return found


def _mine(k: int, same_label: bool):
    def run(queries: pa.Table, forest: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and forest.num_rows:
            trees = Forest(forest)
            for q in queries.to_pylist():
                wanted = trees.roots[(trees.roots[:, 0] == q["label"]) == same_label][:, 1]
                windows = np.array([(w["low"], w["high"]) for w in q["windows"]], np.int64).reshape(-1, 2)
                found = trees.search(np.array(q["q"], np.int64), wanted, q["row"], windows, k)
                out += [(q["row"], q["vec_id"], w["tag"], w["tag_id"], i, r, -s) for w, best in zip(q["windows"], found) for s, i, r in best]
        cols = list(zip(*out)) or [()] * 7
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("anchor", "anchor_id", "tag", "tag_id", "vec_id", "row", "score"), cols)})
    return run


_FOUND = "anchor long, anchor_id long, tag long, tag_id long, vec_id long, row long, score long"


def mine(vectors: DataFrame, is_anchor: Column, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100, scale: int = 256,
         shard_rows: int = SHARD, batch_rows: int = BATCH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row where
    ``is_anchor`` (a condition on the column vec_id) holds and each of its positives, the
    ``negatives`` best rows of another label (all, if fewer) whose score is between ``least`` and
    ``most`` percent of the positive's. Positives are the anchor's ``positives`` best other rows of its
    own label. Scores are inner products of floor(scale * x), higher first, ties by smaller vec_id.

    Rows with a null label, a null vector or a null or non-finite component take no part; vectors are
    compared with those of their length only; one of no components scores 0 with others of its kind.
    Rows of equal vec_id are rows of their own, tied in any order. A null vec_id is sorted as the smallest
    and is no anchor. Long vectors make shards of fewer rows. Labels are integers. An empty table, or
    one without negatives in any window, gives no rows. Other columns are ignored, whatever their
    names. A hundred times a score must fit 64 bits.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    plain = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").cast("long").alias("label"))
    told = plain.where("label IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    base = scratch.save(told, "rows")
    numbers = quantise(base, "row", "vector", scale).withColumnRenamed("vec_id", "row")
    base = scratch.save(numbers.join(base.select("row", F.coalesce("vec_id", F.lit(_LOW)).alias("vec_id"), "label"), "row"), "vectors")
    facts = base.agg(F.count("*").alias("n"), F.max("dim").alias("dim"), F.count_if(is_anchor).alias("anchors")).first()
    per_shard = max(LEAF, min(shard_rows, SHARD_BYTES // (8 * max(1, facts["dim"] or 1))))
    n_shards, n_batches = -(-facts["n"] // per_shard) or 1, -(-facts["anchors"] // batch_rows) or 1
    deal = lambda m, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(m).cast("long"))
    index = scratch.save(base.withColumn("shard", deal(n_shards, 1)).groupBy("dim", "shard").applyInArrow(build_forest, _FOREST), "forest")
    anchors = base.where(is_anchor & (F.col("vec_id") != _LOW)).withColumn("batch", deal(n_batches, 7)).withColumn("home", deal(n_shards, 9))

    def against(queries: DataFrame, k: int, same_label: bool, home: bool) -> DataFrame:
        """Batches of anchors against shards, as (batch, shard) tasks: each anchor's home shard only, or all."""
        every = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
        q = queries.withColumn("shard", F.explode(F.array("home") if home else every(n_shards)))
        b = index.withColumn("batch", F.explode(every(n_batches)))
        return q.groupBy("dim", "batch", "shard").cogroup(b.groupBy("dim", "batch", "shard")).applyInArrow(_mine(k, same_label), _FOUND)

    def best(queries: DataFrame, k: int, same_label: bool, name: str) -> DataFrame:
        """The k best candidates of every window of every anchor, over all shards."""
        first = against(queries, k, same_label, True).groupBy("anchor", "tag").agg(
            F.sort_array(F.collect_list("score"), asc=False).alias("s")).where(F.size("s") >= k).select(
            "anchor", "tag", F.element_at("s", k).alias("kth"))
        raised = queries.select("row", F.explode("windows").alias("w")).select("row", "w.*").join(
            first.withColumnRenamed("anchor", "row"), ["row", "tag"], "left")
        again = raised.groupBy("row").agg(F.collect_list(F.struct("tag", "tag_id", F.greatest("low", "kth").alias("low"), "high")).alias("windows"))
        found = against(queries.drop("windows").join(again, "row"), k, same_label, False)
        rank = F.row_number().over(Window.partitionBy("anchor", "tag").orderBy(F.desc("score"), "vec_id", "row"))
        return scratch.save(found.withColumn("rank", rank).where(F.col("rank") <= k), name)

    whole = F.array(F.struct(F.lit(0).cast("long").alias("tag"), F.lit(0).cast("long").alias("tag_id"),
                             F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high")))
    chosen = best(anchors.withColumn("windows", whole), positives, True, "positives")
    whole_percent = lambda x: F.expr(f"({x} - pmod({x}, 100L)) div 100")
    window = F.struct(F.col("row").alias("tag"), F.col("vec_id").alias("tag_id"),
                      (-whole_percent(f"(-score * {least}L)")).alias("low"), whole_percent(f"(score * {most}L)").alias("high"))
    windows = chosen.select("anchor", window.alias("w")).groupBy("anchor").agg(F.collect_list("w").alias("windows"))
    hard = best(anchors.join(windows, anchors["row"] == windows["anchor"]).drop("anchor"), negatives, False, "negatives")
    of = chosen.select(F.col("anchor"), F.col("row").alias("tag"), F.col("score").alias("positive_score"))
    shown = lambda c: F.when(F.col(c) != _LOW, F.col(c))
    return hard.join(of, ["anchor", "tag"]).select(
        "anchor_id", shown("tag_id").alias("positive_id"), "rank", shown("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
