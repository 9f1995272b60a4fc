"""Structure repair, hard negatives and toxicity against brute force, with nulls, empty and long texts,
ties, repeated rows, empty tables and extra columns of clashing names."""

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives, kernel, structure_repair, toxicity
from tidemark.llm.stage import read

SF = "/root/testdata/sf0.001"
LEGAL = re.compile(r"(s?(ua)+)?")


# -- conversation structure repair ----------------------------------------------

def faults(rows):
    """First fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare.strip(" \t\n\x0b\x0c\r") else "duplicate" if (role, text) in seen else "none" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying all edits, with at most two insertions in any gap."""
    found = faults(rows)
    choices = []
    for (role, text), fault in zip(rows, found):
        more = 5 if fault == "truncated" else 0
        keep = [] if fault in ("blank", "duplicate") else [(more, "K", role, text), (more + 1, "R", "user", text), (more + 1, "R", "assistant", text)]
        choices.append([(2, "D", None, None), *keep])
    gaps = [[(5, "I", r, "") for r in g] for n in range(3) for g in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for picked in itertools.product(*choices):
        for between in itertools.product(gaps, repeat=len(rows) + 1):
            steps = list(between[0])
            for x, g in zip(picked, between[1:]):
                steps += [x, *g]
            if LEGAL.fullmatch("".join((r or "-")[:1] or "-" for _, e, r, _ in steps if e != "D")):
                key = (sum(c for c, *_ in steps), "".join(e for _, e, *_ in steps))
                if best is None or key < best[:2]:
                    best = (*key, [(r, t) for _, e, r, t in steps if e != "D"])
    return best


def code(role, fault):
    return chr(97 + 4 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + ["none", "blank", "duplicate", "truncated"].index(fault))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool"]), st.sampled_from(["", "a.", "b", "c!"])), max_size=3))
def test_chart_is_the_cheapest_repair(rows):
    codes = "".join(code(r, f) for (r, _), f in zip(rows, faults(rows)))
    assert structure_repair.verdict(structure_repair.chart(codes)) == cheapest(rows)[:2]


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abcdefghijklmnop", min_size=1, max_size=14), st.lists(st.integers(1, 13), max_size=3))
def test_any_cut_into_blocks_gives_the_same_chart(codes, cuts):
    at = sorted({0, len(codes), *[c for c in cuts if c < len(codes)]})
    pieces = [structure_repair.chart(codes[a:b]) for a, b in zip(at, at[1:])]
    assert structure_repair.combine(pieces) == structure_repair.chart(codes)


CONVERSATIONS = [
    (1, 0, "system", "be brief."), (1, 1, "user", "hi?"), (1, 2, "assistant", "yes."),
    (2, None, "user", "first!"), (2, 5, "assistant", "cut of"), (2, 9, "user", "last?"),
    (3, 1, None, "who."), (3, 2, "user", None), (4, 0, "", "no role."), (5, 0, "user", "  \n"),
    (None, 1, "user", "null conversation."), (None, 1, "user", "null conversation."), (None, 1, "user", "tie first."),
    (6, 3, "assistant", "end. \n"), (6, 3, "assistant", "a tie."), (7, None, "tool", "x."), (7, None, "tool", "x."),
]


def expected(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    out = {}
    for c, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, *_ in own if t is not None]
        bare = [(r, x) for _, r, x in own]
        found = faults(bare)
        initials = [r[:1] for r, _ in bare]
        cost, audit, repaired = cheapest(bare)
        out[c] = ((max(turns) - min(turns) + 1 - len(set(turns))) if turns else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"),
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, "\n".join(f"{r}:{x}" for r, x in repaired))
    return out


def conversations(spark, rows):
    # names that the operator uses itself must not disturb it
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], "conv_id long, turn long, role string, text string, rank long, codes string, _rank long, conv string")


def test_repair_matches_brute_force(spark):
    done = structure_repair.repair(conversations(spark, CONVERSATIONS))
    turns = {}
    for r in done.turns.orderBy("conv_id", "place").collect():
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, "\n".join(turns.get(r.conv_id, []))) for r in done.conversations.collect()}
    assert got == expected(CONVERSATIONS)


def test_repair_of_a_very_long_conversation_and_text(spark):
    n = 700
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(n) if i % 50 != 49]
    rows += [(2, 0, "user", "é" * 3_000_000 + "."), (2, 1, "assistant", "ok.")]
    done = structure_repair.repair(conversations(spark, rows))
    by = {r.conv_id: r for r in done.conversations.collect()}
    # every missing assistant turn is made up for in the cheapest way: one of two users' turns goes
    assert by[1].gaps == 13 and by[1].illegal == 13 and by[1].cost == 28 and len(by[1].audit.replace("I", "")) == len(rows) - 2
    assert (by[2].cost, by[2].audit) == (0, "KK")
    assert done.turns.where("conv_id = 2").select(F.max(F.length("text"))).first()[0] == 3_000_001


def test_repair_without_rows(spark):
    none = conversations(spark, [])
    assert structure_repair.digest(structure_repair.repair(none)).count() == 0
    ids = spark.createDataFrame([(4,), (4,), (None,)], "conv_id long")
    rows = structure_repair.digest(structure_repair.repair(none, conversations=ids)).collect()
    assert sorted(str(r.conv_id) for r in rows) == ["4", "None"]
    assert all(tuple(r)[1:8] == (0, 0, 0, 0, 0, 0, "") and r.repaired_sha256.startswith("e3b0c442") for r in rows)


# -- hard negatives ---------------------------------------------------------------

def brute_negatives(rows, is_anchor, k=5):
    ok = [(i, v, y, n) for n, (i, v, y) in enumerate(rows) if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ok = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64), y, n) for i, v, y, n in ok]
    out = []
    for i, q, y, n in ok:
        if i is None or not is_anchor(i):
            continue
        scored = sorted((-int(q @ v), -(1 << 63) if j is None else j, m, j, z) for j, v, z, m in ok if m != n and len(v) == len(q))
        for p in [s for s in scored if s[4] == y][:k]:
            hard = [s for s in scored if s[4] != y and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:k]
            out += [(i, p[3], rank, s[3], -p[0], -s[0]) for rank, s in enumerate(hard, 1)]
    return sorted(out, key=str)


def vectors(seed, n, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    out = [(i, [float(np.float32(x)) for x in centres[i % 8] + rng.normal(size=dim) * 0.3], int(rng.integers(0, 4))) for i in range(n)]
    out += [(None, out[3][1], 1), (7, None, 1), (8, [1.0] * (dim - 1) + [None], 2), (10, [float("nan")] * dim, 2), (20, out[5][1], None),
            (30, [], 1), (40, [], 1), (50, [0.0] * dim, 0), (60, [1.0, 2.0], 1), (70, [1.0, 2.0], 2), (80, [2.0, 1.0], 1)]
    out += [(1000 + i, out[5][1], i % 3) for i in range(90)] + [(5, out[5][1], 1)] * 2
    return out


def test_hard_negatives_match_brute_force(spark):
    rows = vectors(3, 500)
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<double>, label int, row long, shard long, q string")
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    for options in ({}, {"shard_rows": 64, "batch_rows": 16}):
        got = sorted((tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **options).collect()), key=str)
        assert got == want


def test_hard_negatives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(df, F.col("vec_id") % 10 == 0).count() == 0


def test_tree_covers_and_separates():
    x = np.random.default_rng(1).integers(-200, 200, (900, 8))
    x[:60] = x[0]
    order, tree = hard_negatives.build_tree(x)
    y, most = hard_negatives._augmented(x[order].astype(np.float64))
    assert sorted(order) == list(range(900))
    for i in range(len(tree.centre)):
        own = y[tree.low[i]:tree.high[i]]
        chord = np.sqrt(((own - y[tree.centre[i]]) ** 2).sum(axis=1))
        assert (2 * np.arcsin(np.minimum(chord / (2 * most), 1)) <= tree.radius[i] + 1e-9).all()
        kids = np.arange(tree.child[i], tree.end[i])
        if len(kids):
            assert tree.low[kids[0]] == tree.low[i] and tree.high[kids[-1]] == tree.high[i] and (tree.high[kids[:-1]] == tree.low[kids[1:]]).all()
            c = y[tree.centre[kids]]
            apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2))[np.triu_indices(len(kids), 1)]
            assert apart.min() + 1e-9 >= 2 * most * np.sin(tree.radius[kids].max() / 2)


def test_large_components_are_exact(spark):
    big = [(10, [1e6, 3.0], 0), (1, [1e6, 5.0], 0), (2, [1e6, 4.0], 1), (3, [1e6, 4.5], 1), (4, [-1e6, 1.0], 1)]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>, label int")
    assert sorted((tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") == 10).collect()), key=str) == brute_negatives(big, lambda i: i == 10)


@pytest.mark.parametrize("clusters,most", [(20, 0.5), (0, 1.0)])
def test_share_of_candidates_verified(clusters, most):
    """With clusters the tree leaves out most candidates; without, it may verify all (README)."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 32))
    if clusters:
        x = rng.normal(size=(clusters, 32))[rng.integers(0, clusters, 4000)] + 0.05 * x
    x = np.floor(256 * x).astype(np.int64)
    n = len(x)
    table = pa.table({"q": pa.array(list(x), pa.list_(pa.int64())), "vec_id": pa.array(range(n), pa.int64()), "row": pa.array(range(n), pa.int64()),
                      "label": pa.array(rng.integers(0, 3, n), pa.int64()), "shard": pa.array([0] * n, pa.int64())})
    forest = hard_negatives.Forest(hard_negatives.build_forest(table))
    for i in range(0, n, 200):
        forest.search(x[i], forest.roots[:, 1], i, np.array([[-(1 << 63), (1 << 63) - 1]]), 5)
    assert forest.verified <= most * n * len(range(0, n, 200))


# -- toxicity -----------------------------------------------------------------------

def test_machine_learns_pairs_that_weights_cannot():
    """Toxic only if an insult and a group occur together; either alone is as likely clean or toxic by weights."""
    rng = np.random.default_rng(5)
    kinds = rng.integers(0, 2, (1200, 2))
    docs = [np.unique(np.concatenate(([0] if a else [1], [2] if b else [3], rng.integers(4, 40, 5)))) for a, b in kinds]
    labels = (kinds[:, 0] == kinds[:, 1]).astype(float)
    right = {}
    for rank in (0, 4):
        m = toxicity.train(docs[:900], labels[:900], 40, rank=rank)
        flat, doc = np.concatenate(docs[900:]), np.repeat(np.arange(300), [len(d) for d in docs[900:]])
        right[rank] = ((m.score(doc, flat, 300) >= 0.5) == labels[900:]).mean()
    assert right[4] > 0.95 and right[0] < 0.65


def test_machine_value_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(0.3, rng.normal(size=9), rng.normal(size=(9, 3)))
    docs = [np.array([], int), np.array([4]), np.array([0, 3, 8]), np.arange(9)]
    got = m.value(np.repeat(np.arange(4), [len(d) for d in docs]), np.concatenate(docs).astype(int), 4)
    want = [0.3 + m.weights[d].sum() + sum(m.vectors[i] @ m.vectors[j] for i, j in itertools.combinations(d, 2)) for d in docs]
    assert np.allclose(got, want)


def test_dictionary_finds_each_documents_terms():
    texts = ["Scum of the earth", None, "", "the  SCUMé scum", "x" * 50]
    chunk = next(kernel.chunks(pa.array(texts, pa.string())))
    doc, code_of = toxicity.terms(chunk)
    wanted = toxicity.Terms(np.unique(code_of[doc == 0])[::2])
    d, t = wanted.found(chunk)
    for i in range(len(texts)):
        assert set(wanted.codes[t[d == i]]) == set(code_of[doc == i]) & set(wanted.codes)
    assert len(toxicity.Terms(np.zeros(0, np.uint64)).found(chunk)[0]) == 0


def test_toxicity_on_labelled_documents(spark):
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    found = toxicity.classify(docs.join(labels, "doc_id", "left_semi"), labels).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in found if r.toxic == 1], [r for r in found if r.toxic == 0]
    assert sum(r.predicted for r in toxic) > 0.7 * len(toxic) and sum(r.predicted for r in clean) < 0.01 * len(clean)


def test_toxicity_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 0.5, "a"), (2, "", 0.1, "b"), (None, "you scum", 0.2, "c"), (3, "you scum", 0.2, "c"), (3, "you scum", 0.2, "c"),
                                  (4, "word " * 600_000, 0.2, "d")], "doc_id long, text string, score double, label string")
    few = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0), (77, 1)], "doc_id long, toxic int")
    for labels in (few, few.limit(0)):
        rows = toxicity.classify(docs, labels).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1 and not any(r.held_out for r in rows if r.doc_id is None)
    assert toxicity.classify(docs.limit(0), few).count() == 0
    # nothing of a held-out label reaches the model
    ids = [i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 3 == 1]
    held = spark.createDataFrame([(i, f"text {i} " + ("scum" if i % 2 else "fine")) for i in ids], "doc_id long, text string")
    told = held.selectExpr("doc_id", "cast(doc_id % 2 as int) toxic")
    assert {r.score for r in toxicity.classify(held, told).collect()} == {0.5}
