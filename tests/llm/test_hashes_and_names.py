"""Words that a rolling sum can't tell apart, one pass over texts, and columns of clashing names."""

import corpus_pipeline
import pytest
from tests.llm.test_llm_operators import SF, documents, prose
from tidemark.llm import decontaminate, jaccard_join, kernel, quality, rlz_dedup, suffix_dedup, token_counts
from tidemark.llm.stage import read


def twins(n=2048):
    """A word of a and b in the order of Thue and Morse, and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [64, 1024, 2048])
def test_twins_have_different_codes(n):
    import pyarrow as pa
    w = kernel.words(next(kernel.chunks(pa.array([" ".join(twins(n))]))))
    assert len(set(w.codes().tolist())) == 2


def test_twins_are_not_taken_for_each_other(spark):
    x, y = twins()
    lead = prose(5, 34)
    docs = documents(spark, [(1, f"{lead} {x}"), (2, f"{lead} {y}"), (3, f"x y {x}"), (4, f"x y {y}")])
    assert {r.doc_id: r.n_removed for r in rlz_dedup.removed_words(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    # the first two share 31 of 32 shingles, which links them; the others share none
    assert {r.doc_id: (r.component_id, r.n_links) for r in jaccard_join.jaccard_join(docs).collect()} == {1: (1, 1), 2: (1, 1), 3: (3, 0), 4: (4, 0)}
    items = spark.createDataFrame([(1, f"x y {x}")], "item_id long, text string")
    hits = {r.doc_id: r.n_hit for r in decontaminate.digest(decontaminate.scan(docs, items)).collect()}
    assert hits == {1: 0, 2: 0, 3: 3, 4: 0}
    # as bytes all four share passages of 50
    removed = {r.doc_id: r.n_removed for r in suffix_dedup.removed_bytes(docs).collect()}
    first = [f"{lead} {x}".encode(), f"{lead} {y}".encode()]
    seen = {first[0][i:i + 50] for i in range(len(first[0]) - 49)}
    gone = set()
    for i in range(len(first[1]) - 49):
        if first[1][i:i + 50] in seen:
            gone |= set(range(i, i + 50))
    assert removed[1] == 0 and removed[2] == len(gone)


def test_texts_are_encoded_once(spark):
    plan = token_counts.token_counts(read(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


def test_stages_keep_columns_of_clashing_names(spark):
    names = ["_score", "score", "_text", "_kept", "row", "fp", "component_id", "n_links"]
    docs = documents(spark, [(i, prose(i % 7, 60)) for i in range(12)] + [(None, "no id"), (None, "no id")])
    docs = docs.selectExpr("*", *[f"{i} AS {n}" for i, n in enumerate(names)])
    labels = read(spark, SF, "labels")
    good = quality.keep_good(docs, labels, cut=0.0)
    one = jaccard_join.keep_one(docs, k=5, percent=80)
    for out, n in ((good, 14), (one, 9)):
        rows = out.collect()
        assert out.columns == docs.columns and len(rows) == n
        assert all(r[name] == i for r in rows for i, name in enumerate(names))
    assert [c for c, _ in corpus_pipeline.STAGES][:2] == ["quality classifier", "n-gram Jaccard join"]
