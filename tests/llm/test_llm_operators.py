"""The training-data operators against brute force on small tables, with nulls, empty and long
texts, ties, repeated rows, empty tables and extra columns of clashing names."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import (chat, decontaminate, jaccard_join, kernel, mixing, quality, repeats, rlz_dedup, suffix_dedup,
                          token_counts, topk, warc)
from tidemark.llm.stage import Scratch, hot_keys, lookup

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, _cell string, shard long, n string"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{int(x)}é" if x % 7 == 0 else f"w{int(x)}" for x in rng.integers(0, 5000, n))


PASSAGE = prose(1, 90)
TEXTS = [
    (1, prose(2, 300)), (2, prose(3, 60) + " " + PASSAGE + " " + prose(4, 80)), (3, None), (4, ""), (5, "  \n\t "),
    (6, prose(5, 40) + "\n" + PASSAGE), (7, prose(2, 300)), (7, prose(2, 300)), (None, PASSAGE + " tail"),
    (None, prose(2, 300)), (8, "one two"), (9, "One TWO"), (10, "a " * 400), (11, prose(2, 300) + " more words here"),
    (12, prose(9, 30000)), (13, "é" * 120), (14, "xé" + "é" * 119), (15, prose(9, 30000)[500:90000]), (16, "x" * 49), (17, "x" * 50), (18, "x" * 50),
]


def documents(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "en", None if i is None else f"s{i % 3}" if i % 4 else None, len(t or ""), 5, "c", 1, "z") for i, t in rows], SCHEMA)


def table(df, *key):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple(str(x) for x in r))


# -- kernels ------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\nZ09-", max_size=30)), max_size=8))
def test_words_and_hashes(texts):
    seen = {}
    for c in kernel.chunks(pa.array(texts, pa.string()), 20):
        w = kernel.words(c)
        codes = w.codes()
        for d in range(c.n):
            want = SPACE.findall(texts[c.first + d] or "")
            got = [w.word(i).decode() for i in range(w.bounds[d], w.bounds[d + 1])]
            assert got == want
            for word, code in zip(got, codes[w.bounds[d]:w.bounds[d + 1]]):
                assert seen.setdefault(word, code) == code
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=6), st.integers(1, 5))
def test_window_starts_stay_in_documents(sizes, k):
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    want = [i for a, b in zip(bounds[:-1], bounds[1:]) for i in range(a, b - k + 1)]
    assert kernel.window_starts(bounds, k).tolist() == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=80))
def test_equal_windows_have_equal_anchors(values):
    codes = kernel.mix(np.array(values, np.uint64) + np.uint64(9))
    a = repeats.anchors(codes, np.array([0, len(codes)]), 3, 8)
    place = {p: int(x) - p for x, lo, hi in zip(a.pos, a.lo, a.hi) for p in range(lo, hi + 1)}
    assert sorted(place) == list(range(max(0, len(values) - 7)))
    by_window = defaultdict(set)
    for p, at in place.items():
        by_window[tuple(values[p:p + 8])].add(at)
    assert all(len(x) == 1 for x in by_window.values())


# -- registered queries against their SQL ------------------------------------

@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if re.match(r"op\d+_", n)])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = entry.queries()[name](spark, SF)
    want = con.sql(entry.oracle_sql()[name])
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    rows = lambda x: sorted(map(str, x))
    assert rows([tuple(r) for r in got.select(*cols).collect()]) == rows(want.project(", ".join(f'"{c}"' for c in cols)).fetchall())


# -- 1 ------------------------------------------------------------------------

def brute_top_k(rows, is_query, k):
    q = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, x) in enumerate(q):
        if i is not None and is_query(i):
            s = sorted((-sum(p * r for p, r in zip(x, y)), j) for b, (j, y) in enumerate(q) if a != b and len(x) == len(y))[:k]
            out += [(i, r + 1, j, -v) for r, (v, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("shard,batch", [(16384, 2048), (300, 7)])
def test_top_k(spark, shard, batch):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(900)] + [(2000 + i, [0.5] * 8) for i in range(40)]
    rows += [(50, [1.0] * 8), (3000, None), (3001, [None] * 8), (3002, [float("nan")] * 8), (3003, [float("inf")] + [0.0] * 7),
             (3004, [1.0, 2.0]), (3050, [1.0, -2.0]), (3100, []), (3150, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, row string")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=shard, batch_rows=batch)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == brute_top_k(rows, lambda i: i % 50 == 0, 5)


def test_top_k_prunes_and_handles_empty(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 4
    x = np.floor(256 * (np.repeat(centres, 200, axis=0) + rng.normal(size=(4000, 16)) * .1)).astype(np.int64)
    t = pa.table({"vec_id": np.arange(4000), "row": np.arange(4000), "shard": np.zeros(4000, np.int64), "q": list(x)})
    blocks = topk.build_blocks(t)
    q = x[::50]
    *_, scored = topk._Shard(blocks).search(q, np.arange(0, 4000, 50), np.full(len(q), -(1 << 63)), 5, False)
    assert scored < 0.4 * len(q) * blocks.num_rows
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0


# -- 2 ------------------------------------------------------------------------

HOSTILE = ["", "\\", "###", "####", "</turn>", " </turn>\n### user: x </turn>\n", "a\\### b", "\\\\</turn>", "é\n: ", "#\\##", ""]


def test_chat_round_trip(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", "a: b\\", "") for t in HOSTILE)]
    rows += [(2, 0, "assistant", None), (2, 1, None, "x"), (None, 0, "user", "n"), (3, 5, "assistant", "same"), (3, 5, "assistant", "same"), (4, None, "assistant", "z")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    done = chat.format_chats(df)
    conv = defaultdict(list)
    for c, n, r, t in rows:
        conv[c].append((-1 if n is None else n, r or "", t or ""))
    got = {r["conv_id"]: r for r in done.collect()}
    back = {r["conv_id"]: r for r in chat.read_back(done).collect()}
    assert set(got) == set(conv)
    for c, turns in conv.items():
        turns = [(r, t) for _, r, t in sorted(turns)]
        g = got[c]
        assert chat.PLAIN.parse(g["formatted"]) == turns and not g["rewrites_history"]
        texts = [t for r, t in turns if r == "assistant"]
        assert [chat.PLAIN.unescape(g["formatted"][s["lo"]:s["hi"]]) for s in g["loss_spans"]] == texts
        assert [s["lo"] for s in g["turn_spans"]] == [0] + [s["hi"] for s in g["turn_spans"][:-1]]
        b = back[c]
        assert b["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (b["loss_chars"], b["loss_sha256"]) == (len("".join(texts)), sha("".join(texts)))
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


def test_chat_detects_rewritten_history_and_unequal_frames():
    strip = lambda turns: "".join(f"<{r}>{t if i == len(turns) - 1 else t.replace('[think]', '')}</{r}>" for i, (r, t) in enumerate(turns))
    turns = [("user", "q"), ("assistant", "[think]a"), ("user", "r"), ("assistant", "b")]
    r = chat.render_incrementally(turns, strip)
    assert r.rewrites_history and [r.output[a:b] for a, b in r.texts] == ["q", "a", "r", "b"]
    first = lambda turns: "".join(f"{'BOS ' if i == 0 else ''}[{i}|{r}] {t}\n" for i, (r, t) in enumerate(turns))
    r = chat.render_incrementally(turns * 6, first)
    assert not r.rewrites_history and [r.output[a:b] for a, b in r.texts] == [t for _, t in turns * 6]


# -- 3 ------------------------------------------------------------------------

def brute_join(rows, k=4, percent=85):
    sets = []
    for i, t in rows:
        w = SPACE.findall(lower(t))
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent, links = list(range(len(rows))), [0] * len(rows)
    find = lambda i: i if parent[i] == i else find(parent[i])
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    group = defaultdict(list)
    for a in range(len(rows)):
        group[find(a)].append(rows[a][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in group.items()}
    return sorted(((rows[a][0], len(sets[a]), least[find(a)], links[a]) for a in range(len(rows))), key=str)


@pytest.mark.parametrize("node,sample,shingles", [(1024, 4, 1 << 22), (5, 1, 1 << 22), (1024, 4, 1 << 9)])
def test_jaccard_join(spark, monkeypatch, node, sample, shingles):
    monkeypatch.setattr(jaccard_join, "NODE_SHINGLES", shingles)
    rng = np.random.default_rng(5)
    rows = list(TEXTS)
    base = prose(77, 200).split()
    for i in range(40):     # a chain of near copies, each a little farther from the first
        w = list(base)
        for j in rng.integers(0, 200, 1 + i // 4):
            w[j] = f"x{int(rng.integers(0, 99999))}"
        rows.append((100 + i, " ".join(w)))
    got = jaccard_join.jaccard_join(documents(spark, rows), node_points=node, sample=sample)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=str) == brute_join(rows)


def test_lookup_of_hot_keys_is_an_inner_join(spark):
    scratch = Scratch(spark, "lookup-test")
    rows = scratch.save(spark.range(3000).select(
        F.col("id").alias("r"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).otherwise(F.lit(None)).cast("long").alias("k")), "rows")
    entries = spark.range(0, 2000, 2).select(F.col("id").alias("on"), (F.col("id") * 10).alias("v")).union(spark.createDataFrame([(7, 70)], "on long, v long"))
    hot = hot_keys(rows, "k", scratch)
    assert 7 in {r["hot"] for r in hot.collect()} and hot.count() < 4 * 8
    got = lookup(rows, "k", entries, "on", hot)
    want = rows.join(entries, F.col("k") == F.col("on"))
    assert table(got) == table(want) and got.columns == want.columns
    assert lookup(rows.limit(0), "k", entries, "on", hot_keys(rows.limit(0), "k", scratch)).count() == 0


def test_components_of_hubs_and_chains(spark):
    hub = [(500, 1000 + i) for i in range(400)]
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = spark.createDataFrame([*hub, *chain, (160, 1399), (3, 3000), (3, 3000)], "a long, b long")
    got = {r["node"]: r["root"] for r in jaccard_join.components(edges, Scratch(spark, "components-test")).collect()}
    assert got == {**{n: 100 for e in [*hub, *chain] for n in e}, 3: 3, 3000: 3}


def test_jaccard_bounds_hold():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 40, int(rng.integers(1, 300)), dtype=np.uint64) << np.uint64(20))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < .95], rng.integers(0, 1 << 60, int(rng.integers(0, 30)), dtype=np.uint64))))
        shared = len(np.intersect1d(a, b))
        va, vb = jaccard_join.vector(a), jaccard_join.vector(b)
        assert np.minimum(va, vb).sum() >= shared
        if 100 * shared >= 85 * (len(a) + len(b) - shared):
            assert jaccard_join.best_excess(va, va, vb, vb) >= 0
            assert jaccard_join.best_excess(np.minimum(va, vb), np.maximum(va, vb), vb, vb) >= 0
    sets = [np.unique(rng.integers(0, 400, 120)).astype(np.uint64) for _ in range(30)]
    p, q = np.nonzero(np.ones((30, 30), bool))
    assert jaccard_join.overlaps(sets, sets, p, q).tolist() == [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(p, q)]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_jaccard_texts_of_one_id_meet_one_set_each(spark, monkeypatch, doc_id):
    seen, real = spark.sparkContext.accumulator(0), jaccard_join._points

    def counted(*args):
        run = real(*args)

        def rows(batches):
            def tell():
                for b in batches:
                    seen.add(b.num_rows)
                    yield b
            return run(tell())
        return rows

    monkeypatch.setattr(jaccard_join, "_points", counted)
    word = lambda i, j: f"w{i * 1000 + j}"
    texts = [" ".join(word(i, j) for j in range(60 + more)) for i in range(20) for more in (0, 1)]
    got = jaccard_join.jaccard_join(documents(spark, [(doc_id, t) for t in texts]), sample=1).collect()
    assert Counter((r["component_id"], r["n_shingles"], r["n_links"]) for r in got) == {(doc_id, 57, 1): 20, (doc_id, 58, 1): 20}
    assert 0 < seen.value <= len(texts)


def test_jaccard_empty_and_keep_one(spark):
    assert jaccard_join.jaccard_join(documents(spark).limit(0)).count() == 0
    rows = [(3, prose(1, 50)), (1, prose(1, 50)), (1, prose(1, 50)), (2, prose(8, 50)), (None, prose(8, 50)), (5, None), (6, "")]
    kept = jaccard_join.keep_one(documents(spark, rows), k=5, percent=80)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 2, 5, 6, None]
    assert kept.columns == documents(spark).columns


# -- 4 ------------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=8), st.integers(0, 300))
def test_sainte_lague_is_highest_quotients(votes, seats):
    got = mixing.sainte_lague(np.array(votes), seats)
    want = np.zeros(len(votes), int)
    for _ in range(seats if any(votes) else 0):
        want[max(range(len(votes)), key=lambda i: (votes[i] / (2 * want[i] + 1), -i))] += 1
    assert got.sum() == want.sum()
    quotient = lambda s: sorted(v / (2 * j + 1) for v, n in zip(votes, s) for j in range(n))
    assert np.allclose(quotient(got), quotient(want))


@pytest.mark.parametrize("shard,band", [(1_000_000, 4096), (120, 4096), (120, 2)])
def test_mixing(spark, shard, band):
    rows = [(i, prose(i, n)) for i, n in enumerate([5, 900, 0, 33, 64, 65, 1, 128, 700, 2, 300, 41, 77, 8])] + [(None, "a b"), (4, "again twice"), (4, "again twice")]
    df = documents(spark, rows)
    got = mixing.mix_sources(df, shard_words=shard, shard_docs=3, band_shards=band)
    out = got.collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    sources = sorted(by, key=lambda s: (s is None, s))
    sizes = np.array([sum(r["size"] for r in by[s]) for s in sources])
    targets = mixing.fair_targets(sizes, [1 + i % 3 for i in range(len(sources))])
    assert (targets <= 3 * sizes + 1e-6).all() and abs(targets.sum() - sizes.sum()) < 1e-6
    for s, n, t in zip(sources, sizes, targets):
        assert all(r["source_size"] == n and abs(r["target"] - t) < 1e-6 for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - t) <= 1
    assert table(got) == table(mixing.mix_sources(df.repartition(3), shard_words=shard, shard_docs=3, band_shards=band))
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_fair_targets_reshare():
    t = mixing.fair_targets(np.array([1, 10, 100, 1000]), np.array([1, 2, 3, 1]))
    assert t[0] == 3 and t[1] == 30 and t[2] == 300 and abs(t[3] - (1111 - 333)) < 1e-9


# -- 5 ------------------------------------------------------------------------

def brute_hits(docs, items, n=13):
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        for j in range(max(1, len(w) - n + 1) if w else 0):
            windows[tuple(w[j:j + n])].add(i)
    out = []
    for i, t in docs:
        w, hit, ids = ALNUM.findall(lower(t)), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in windows:
                    hit |= set(range(j, j + k))
                    ids |= windows[tuple(w[j:j + k])]
        named = sorted(str(x) for x in ids if x is not None)
        out.append((i, len(w), len(hit), sha(",".join(named)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEMS = [(1, PASSAGE), (2, "One; two"), (3, None), (4, "!!"), (5, prose(2, 300)), (5, prose(5, 20)), (10, "w1 w2"), (None, "xé"), (7, PASSAGE)]


@pytest.mark.parametrize("limit", [250_000, 60])
def test_decontaminate(spark, limit):
    items = spark.createDataFrame([(i, t, "q") for i, t in ITEMS], "item_id long, text string, hash string")
    found = decontaminate.scan(documents(spark), items, slice_windows=limit)
    got = decontaminate.digest(found).select("doc_id", "n_words", "n_hit", "items_sha256", "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_hits(TEXTS, ITEMS)
    clean = decontaminate.decontaminate(documents(spark), items, slice_windows=limit)
    bad = Counter(r[0] for r in brute_hits(TEXTS, ITEMS) if r[4])
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(i for i, _ in TEXTS) - bad and clean.columns == documents(spark).columns


def test_decontaminate_spans_and_empty(spark):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    rows = [(1, "before, " + PASSAGE.upper().replace("É", "é") + "; after"), (2, "clean é")]
    got = decontaminate.decontaminate(documents(spark, rows), items, remove="spans")
    assert sorted(r["text"] for r in got.collect()) == ["before, ; after", "clean é"]
    assert decontaminate.scan(documents(spark).limit(0), items).count() == 0
    none = decontaminate.scan(documents(spark), items.limit(0))
    assert none.where("contaminated or n_hit > 0").count() == 0 and none.count() == len(TEXTS)


@pytest.mark.parametrize("limit", [250_000, 20])
@pytest.mark.parametrize("remove", ["documents", "spans"])
def test_decontaminate_keeps_columns_of_the_scans_names(spark, limit, remove):
    items = spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    names = ("n_words", "spans", "items", "n_hit", "n_items", "contaminated", "fp", "_fp", "t")
    plain = documents(spark).where("text is not null")
    clashing = plain.select("*", *[F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in names])
    want = decontaminate.decontaminate(plain, items, remove=remove, slice_windows=limit)
    got = decontaminate.decontaminate(clashing, items, remove=remove, slice_windows=limit)
    assert got.columns == clashing.columns
    rows = got.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(map(tuple, want.select("doc_id", "text").collect()))
    assert all(r[n] == f"{n}{'-' if r['doc_id'] is None else r['doc_id']}" for r in rows for n in names)
    digest = lambda docs: Counter(map(tuple, decontaminate.digest(decontaminate.scan(docs, items, slice_windows=limit)).collect()))
    assert digest(clashing) == digest(plain)


# -- 6 ------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, file long, place long, record string, side string, hash string, kids string"


def test_warc_audit_descends_to_the_damage(spark):
    rows = [(i if i % 9 else None, None if i % 5 == 0 else f"http://h/{i}", None if i % 7 == 0 else "" if i % 8 == 0 else "é" * i) for i in range(1, 197)]
    rows += [(3, "http://h/3", "ééé")] * 3 + [(500, "http://h/500", "long " * 800_000), (3, "http://h/3", "other")]
    pages = spark.createDataFrame([(*r, 1, 2, "x", "b", "y", "z") for r in rows], PAGES)
    scratch = Scratch(spark, "test")
    first = scratch.save(warc.archive(pages, scratch, 16), "first")
    table = sorted(map(tuple, first.collect()))
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r[:2] for r in table] == [(i // 16, i % 16) for i in range(len(rows))] and [r[2] for r in table] == [r[0] for r in want]
    assert all(r[3].startswith("WARC/1.0") for r in table)

    def damage(r):
        f, place, page, record = r
        if f == 6:
            return [(6, place, page, "")] if place == 13 else [] if place == 7 else [r]
        if f == 7:
            return [(99, place, page, record)]              # a file under another name
        if f == 5 and place == 15:
            return [r, (5, 15.5, 10_000, "new")]            # more records than planned
        if place == 7:
            return {1: [(1, 7, page, "X" + record[1:])], 2: [(2, 7, page, record + "longer")], 3: [], 4: [(4, 7, page, None)]}.get(f, [r])
        return [r]

    other = [(x[0], float(x[1]), *x[2:], "clash") for r in table for x in damage(r)]
    second = spark.createDataFrame(other, "file long, place double, page_id long, record string, side string")
    got = {r["file"]: r for r in warc.audit(first, second, 16, 4).collect()}
    at = lambda f, p: sum(len(r[3].encode()) for r in table if r[0] == f and r[1] < p)
    assert sorted(got) == [*range(13), 99]
    for f in (0, 8, 9, 10, 11, 12):
        assert got[f]["root_a"] == got[f]["root_b"] and got[f]["n_damaged"] == got[f]["n_moved"] == 0
        assert got[f]["n_compared"] == 1 and got[f]["damaged"] == "" and got[f]["n_records"] == (16 if f < 12 else 9)
    for f in (1, 2):        # one path; what lies behind a longer record has other offsets, but isn't compared
        assert got[f]["damaged"] == f"{at(f, 7)}:changed" and got[f]["n_compared"] == 1 + 4 + 4 and got[f]["n_moved"] == 0
    assert got[2]["n_bytes_b"] == got[2]["n_bytes"] + 6
    for f in (3, 4):        # all behind a lost record have another number in their file
        assert got[f]["damaged"] == f"{at(f, 7)}:missing" and got[f]["n_moved"] == 8 and got[f]["n_records_b"] == 15
        assert got[f]["n_compared"] == 1 + 4 + 3 * 4
    assert got[5]["damaged"] == f"{got[5]['n_bytes']}:added" and got[5]["n_records_b"] == 17 and got[5]["n_compared"] == 1 + 5 + 1
    assert got[6]["damaged"] == f"{at(6, 7)}:missing,{at(6, 13)}:changed" and got[6]["n_damaged"] == 2 and got[6]["n_moved"] == 7
    assert got[7]["root_b"] is None and got[7]["n_damaged"] == 16 and got[7]["n_records_b"] == 0 and "added" not in got[7]["damaged"]
    assert got[99]["root_a"] is None and got[99]["n_records"] == 0 and got[99]["n_damaged"] == 16 and got[99]["root_b"] == got[7]["root_a"]

    assert warc.fixity_audit(pages.limit(0)).count() == 0
    found = warc.fixity_audit(pages.drop("file", "place")).collect()
    rules = [zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 200 for r in want]
    assert sum(r["n_damaged"] for r in found) == sum(k < 4 for k in rules) > 0


# -- 7 ------------------------------------------------------------------------

def test_token_counts(spark):
    import base64
    import tiktoken
    with open(token_counts.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    lengths = [len(enc.encode_ordinary(t or "")) for _, t in TEXTS]
    got = {r["n_tokens"]: r for r in token_counts.token_counts(documents(spark)).collect()}
    assert {n: r["n_docs"] for n, r in got.items()} == Counter(lengths)
    for n, r in got.items():
        assert r["truncated_total"] == sum(min(n, x) for x in lengths) and r["docs_over"] == sum(x > n for x in lengths)
        assert r["tokens_over"] == sum(x for x in lengths if x > n) and r["lost_tokens"] == sum(max(0, x - n) for x in lengths)
        assert r["quantile"] == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    sums = token_counts.token_counts(documents(spark))
    for limit in (0, 3, 1000, 10 ** 9):
        r = token_counts.at_limit(sums, limit).first()
        assert (r["truncated_total"], r["docs_that_fit"], r["total_tokens"]) == (sum(min(limit, x) for x in lengths), sum(x <= limit for x in lengths), sum(lengths))
    assert token_counts.token_counts(documents(spark).limit(0)).count() == 0


# -- 8 and 9 ------------------------------------------------------------------

def brute_bytes(rows, window=50):
    key = lambda i: -1 if i is None else i
    first = {}
    for i, t in sorted(rows, key=lambda r: key(r[0])):
        b = (t or "").encode()
        for j in range(len(b) - window + 1):
            first.setdefault(b[j:j + window], key(i))
    out, texts = [], []
    for i, t in rows:
        b = (t or "").encode()
        m = bytearray(len(b))
        for j in range(len(b) - window + 1):
            if first[b[j:j + window]] < key(i):
                m[j:j + window] = b"\1" * window
        out.append((i, len(b), sum(m), len(re.findall(b"\1+", bytes(m))), sha(bytes(c for c, x in zip(b, m) if not x))))
        for r in re.finditer(b"\1+", bytes(m)):
            lo, hi = r.span()
            while lo < hi and b[lo] & 0xC0 == 0x80:
                m[lo] = 0
                lo += 1
            while hi > lo and hi < len(b) and b[hi] & 0xC0 == 0x80:
                hi -= 1
                m[hi] = 0
        texts.append((i, bytes(c for c, x in zip(b, m) if not x).decode()))
    return sorted(out, key=str), sorted(texts, key=str)


@pytest.fixture(params=[(2 << 20, 20_000), (3000, 20_000), (3000, 1)], ids=["one cell", "many cells", "hot seeds"])
def layout(request, monkeypatch):
    monkeypatch.setattr(repeats, "CELL_BYTES", request.param[0])
    return request.param[1]


MIXED = [r for r in TEXTS if r[0] not in (12, 15)] + [(12, prose(9, 3000)), (15, prose(9, 3000)[500:9000]), (20, "ab" * 90 + PASSAGE[7:200] + "ab" * 40),
         (21, PASSAGE[3:180] + "é" * 30), (22, "é" * 29 + PASSAGE[3:180]), (23, "\x00" * 130), (24, "q" + "\x00" * 80 + PASSAGE[50:99]), (2, PASSAGE)]


def test_suffix_dedup(spark, layout):
    want, texts = brute_bytes(MIXED)
    got = suffix_dedup.removed_bytes(documents(spark, MIXED), hot=layout)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = suffix_dedup.removed_bytes(documents(spark, MIXED), hot=layout, output="text", carry=["doc_id", "lang", "n"])
    assert kept.columns == ["doc_id", "lang", "n", "text"]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == texts


TIED_IDS = [(None if i % 3 == 0 else 9 if i % 3 == 1 else i, t) for i, t in enumerate(
    [PASSAGE + f" tail {i % 7}" if i % 4 else prose(i % 5, 120) + PASSAGE[i:100 + i] for i in range(90)])]


def test_rows_of_one_id_span_cells(spark, monkeypatch):
    """A third of the ids null and a third alike: cells keep their bound, results stay."""
    monkeypatch.setattr(repeats, "CELL_BYTES", 3000)
    kept, real = [], repeats.Cells.__init__

    def note(self, *a, **k):
        real(self, *a, **k)
        kept.append(self.table)
    monkeypatch.setattr(repeats.Cells, "__init__", note)
    got = suffix_dedup.removed_bytes(documents(spark, TIED_IDS))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_bytes(TIED_IDS)[0]
    got = suffix_dedup.removed_bytes(documents(spark, TIED_IDS), hot=1)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_bytes(TIED_IDS)[0]
    got = rlz_dedup.removed_words(documents(spark, TIED_IDS)).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_words(TIED_IDS)
    nulls = sum(len(t) for i, t in TIED_IDS if i is None)
    for table in kept:
        size = table.groupBy("_cell").agg(F.sum(F.octet_length("_text")).alias("b"), F.count_if(F.col("_ord") == repeats.FIRST).alias("n"))
        cells = size.collect()
        assert nulls > 8000 and sum(r["n"] > 0 for r in cells) >= 4
        assert max(r["b"] for r in cells) < 3 * 3000


def brute_words(rows, window=35):
    ws = [SPACE.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[j:j + window]) for w in ws for j in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, ws):
        gone = {x for j in range(len(w) - window + 1) if count[tuple(w[j:j + window])] > 1 for x in range(j, j + window)}
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return sorted(out, key=str)


def test_rlz_dedup(spark, layout):
    rows = MIXED + [(30, PASSAGE + " " + PASSAGE), (31, " ".join(PASSAGE.split()[20:70])), (32, "p q r " + " ".join(PASSAGE.split()[40:80]) + " a b"), (33, "u v " * 60)]
    got = rlz_dedup.removed_words(documents(spark, rows), keep_text=True)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str) == brute_words(rows)
    for r in got.collect():
        assert sha(r["kept"]) == r["kept_sha256"] and sum(s["hi"] - s["lo"] for s in r["spans"]) == r["n_removed"]


def test_dedup_of_nothing(spark):
    assert suffix_dedup.removed_bytes(documents(spark).limit(0)).count() == 0
    assert rlz_dedup.removed_words(documents(spark).limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(min_size=0, max_size=6), st.binary(min_size=8, max_size=10), st.integers(0, 4)), min_size=1, max_size=12))
def test_induced_order_finds_equal_windows(rows):
    window = 8
    squeeze = lambda b: bytes(x % 2 for x in b)
    rows = sorted({(s, squeeze(b), squeeze(a), o) for s, b, a, o in rows}, key=lambda r: (r[0], r[2]))
    t = pa.table({"seed": [r[0] for r in rows], "_cell": [0] * len(rows), "place": list(range(len(rows))), "ord": [r[3] for r in rows],
                  "before": pa.array([r[1] for r in rows], pa.binary()), "after": pa.array([r[2] for r in rows], pa.binary()),
                  "least": pa.array([0] * len(rows), pa.int32()), "most": pa.array([len(r[1]) for r in rows], pa.int32())})
    first = {}
    text = lambda r, d: (r[0], d, (r[1][len(r[1]) - d:] + r[2])[:window])
    for r in rows:
        for d in range(len(r[1]) + 1):
            first[text(r, d)] = min(first.get(text(r, d), 99), r[3])
    want = {i: m for i, r in enumerate(rows) if (m := sum(1 << d for d in range(len(r[1]) + 1) if first[text(r, d)] < r[3]))}
    got = suffix_dedup.later(t, window)
    assert dict(zip(got["place"].to_pylist(), got["mask"].to_pylist())) == want


# -- 10 -----------------------------------------------------------------------

def test_quality_on_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    for label in (0, 1):
        part = [r for r in held if r["quality"] == label]
        assert sum(r["predicted"] == label for r in part) >= 0.97 * len(part)


def test_quality_edge_cases(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(20)] + [(None, 1, "x"), (3, None, "x"), (1, 1, "x")], "doc_id long, quality int, score string")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_scores_do_not_depend_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.learnable(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    assert table(quality.classify(docs, labels)) == table(quality.classify(docs.withColumn("lang", F.lit("x")), flipped))


# -- the pipeline -------------------------------------------------------------

def test_pipeline_stage_by_stage(spark):
    scratch = Scratch(spark, "test-pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        kept.append(docs)
        docs = scratch.save(stage(spark, docs, SF), "x")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = [sorted(r["doc_id"] for r in k.select("doc_id").collect()) for k in kept]
    texts = [[(r["doc_id"], r["text"]) for r in k.collect()] for k in kept]
    model = quality.fit(kept[0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids[1] == sorted(r["doc_id"] for r in quality.score(kept[0], model).where("score >= 0.3").collect())
    assert ids[2] == sorted(r[0] for r in brute_join(texts[1], 5, 80) if r[0] == r[2])
    assert sorted(texts[3]) == sorted(brute_bytes(texts[2])[1])
    assert all(r["n_chars"] == len(r["text"]) for r in kept[3].collect())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids[4] == sorted(r[0] for r in brute_hits(texts[3], items) if not r[4])
    assert docs.columns[0] == "doc_id" and sorted(r["doc_id"] for r in docs.collect()) == ids[4]
    assert len(ids[0]) > len(ids[1]) > len(ids[2]) >= len(ids[4])
