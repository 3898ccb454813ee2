"""Winnowing, Jaccard join, components and the pipeline."""

import hashlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from panelops.llm import components, jaccard_join, winnowing
from panelops.llm.queries import QUERIES

from . import brute
from .conftest import SMALL, rows_of
from .test_files import check_packing


def fp_text(pairs):
    return " ".join(f"{h:X}:{p}" for h, p in pairs)


def near(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def check_fingerprints(rows, docs):
    assert len(rows) == len(docs)
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0], d[1] or ""))
    by_key = {}
    for k, (i, text) in enumerate(order):
        t, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        f, e, n = brute.winnow(t), brute.winnow(edited), brute.winnow(nxt)
        by_key.setdefault(i, []).append(
            (len(t), hashlib.sha256(edited.encode()).hexdigest(), fp_text(f), fp_text(e),
             round(near(f, e), 9), round(near(f, n), 9))
        )
    for r in rows:
        got = (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
               round(r["near_edited"], 9), round(r["near_next"], 9))
        assert got in by_key[r["doc_id"]]


def test_fingerprints(spark, odd, empty, small_docs):
    check_fingerprints(
        rows_of(QUERIES["op8_winnowing"](spark, SMALL)), [(i, t) for i, t, _ in small_docs]
    )
    for per_bucket in (1000, 3):
        rows = winnowing.compare_with_next(odd, docs_per_bucket=per_bucket).select(
            "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
            winnowing.to_text(F.col("fingerprint")).alias("fingerprint"),
            winnowing.to_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
            "near_edited", "near_next",
        )
        check_fingerprints(rows_of(rows), [(r["doc_id"], r["text"]) for r in rows_of(odd)])
    assert winnowing.compare_with_next(empty).count() == 0


def test_match_guarantee(spark):
    shared = " ".join(f"s{k}" for k in range(11))
    a = " ".join(f"a{k}" for k in range(40)) + " " + shared + " " + " ".join(f"b{k}" for k in range(9))
    b = shared + " " + " ".join(f"c{k}" for k in range(60))
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        winnowing.hashes(winnowing.fingerprint(F.col("a"))).alias("a"),
        winnowing.hashes(winnowing.fingerprint(F.col("b"))).alias("b"),
    )
    row = df.first()
    assert set(row["a"]) & set(row["b"])


def linked(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(df)}


def test_join_against_brute_force(spark, odd, empty, small_docs):
    for docs, df in (
        ([(i, t) for i, t, _ in small_docs], spark.read.parquet(f"{SMALL}/documents.parquet")),
        ([(r["doc_id"], r["text"]) for r in rows_of(odd)], odd),
    ):
        comp = brute.components(docs)
        expected = {(i, len(brute.shingles(t)), comp.get(i)) for i, t in docs}
        got = jaccard_join.link_documents(df)
        assert linked(got) == expected and got.count() == len(docs)
    assert jaccard_join.link_documents(empty).count() == 0


@pytest.fixture()
def tight(monkeypatch):
    """Small limits, so long lists, stars, many flushes and block pairs occur."""
    for name, value in (("MIN_HEAVY", 4), ("MAX_PAIRS", 3), ("BLOCK_DOCS", 7), ("FLUSH", 300)):
        monkeypatch.setattr(jaccard_join, name, value)


def copies_with_a_passage(groups=6, size=40):
    """Groups of near copies, all with one passage that is too short to link
    them: each shingle of a group is in 40 documents, each of the passage in 240."""
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(0, 10**9)}"
    passage = [word() for _ in range(30)]
    docs = []
    for _ in range(groups):
        base = [word() for _ in range(60)] + passage
        docs += [[word(), *base] for _ in range(size)]
    return [(k, " ".join(d)) for k, d in enumerate(docs)]


@pytest.fixture()
def clusters_of(monkeypatch):
    """Sizes of the clusters that a call of ``run`` searches."""

    def sizes(run):
        seen, links = [], jaccard_join._links

        def kept(docs, clusters, named):
            seen.extend(r["count"] for r in rows_of(clusters.groupBy("component").count()))
            return links(docs, clusters, named)

        with monkeypatch.context() as m:
            m.setattr(jaccard_join, "_links", kept)
            run()
        return sorted(seen)

    return sizes


def test_frequent_passage_does_not_glue_clusters(spark, clusters_of):
    docs = copies_with_a_passage()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).cache()
    got = []
    assert clusters_of(lambda: got.append(linked(jaccard_join.link_documents(df)))) == [40] * 6
    assert got == [{(i, 87, i // 40 * 40) for i, _ in docs}]


def test_pipeline_keeps_one_of_each_group_with_a_passage(spark, clusters_of):
    docs = [(i, t, "en", "src", len(t)) for i, t in copies_with_a_passage(groups=3)]
    df = spark.createDataFrame(docs, ", ".join(
        f"{c} {'long' if c in ('doc_id', 'n_chars') else 'string'}" for c in corpus_pipeline.COLUMNS
    )).repartition(3).cache()
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    kept = []
    assert clusters_of(lambda: kept.extend(rows_of(stage(spark, df, SMALL)))) == [40] * 3
    assert sorted(r["doc_id"] for r in kept) == [0, 40, 80]


def test_equal_sets_are_one_member_of_a_list():
    tokens, sets = np.arange(5, dtype=np.uint32), np.array([7, 7, 7, 7, 9], np.int64)
    row = lambda ids: (0, jaccard_join._planes(np.diff(tokens, prepend=tokens[:1] * 0)),
                       jaccard_join._planes(ids))
    pdf = pd.DataFrame([row(np.full(5, 7)), row(sets)] * 30, columns=["n", "tokens", "members"])
    edges = jaccard_join._list_edges(pdf, 2)
    assert edges.to_numpy().tolist() == [[7, 9, 1]]


def test_join_where_short_ids_collide(spark, tight, monkeypatch):
    """Few bits for a set's id, and a table for a few of the frequent shingles."""
    for name, value in (("SPARE_BITS", -6), ("MAX_HEAVY", 40), ("MAX_CELL_BITS", 8)):
        monkeypatch.setattr(jaccard_join, name, value)
    docs = near_copies()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    comp = brute.components(docs)
    assert linked(jaccard_join.link_documents(df)) == {
        (i, len(brute.shingles(t)), comp[i]) for i, t in docs
    }


def near_copies(seed=3):
    """Groups of near copies around the threshold, a passage in many documents
    and a chain of documents that link only one to the next."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(0, 5000)}"
    passage = [word() for _ in range(25)]
    docs = []
    for size in (2, 5, 40):
        base = [word() for _ in range(60)]
        for _ in range(size):
            copy = list(base)
            for at in rng.choice(60, rng.integers(0, 4), replace=False):
                copy[at] = word()
            docs.append(copy)
    for _ in range(60):
        docs.append([word() for _ in range(rng.integers(3, 30))] + passage)
    chain = [word() for _ in range(100)]
    for k in range(8):
        docs.append(chain[4 * k : 4 * k + 60])
    docs += [docs[0]] * 6
    order = rng.permutation(len(docs))
    return [(int(order[k]) - 20, " ".join(d)) for k, d in enumerate(docs)]


def test_join_with_tight_limits(spark, tight):
    docs = near_copies()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    comp = brute.components(docs)
    assert linked(jaccard_join.link_documents(df)) == {
        (i, len(brute.shingles(t)), comp[i]) for i, t in docs
    }
    assert len(set(comp.values())) < len(docs) - 30


def test_rows_of_one_id_are_one_node(spark):
    a, b = "a b c d e f g h", "p q r s t u v w x"
    df = spark.createDataFrame([(3, a), (5, a), (5, b), (4, b), (9, "z")], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in rows_of(jaccard_join.link_documents(df))} == {
        (3, 3), (5, 3), (4, 3), (9, 9)
    }


def test_repeated_ids_with_tight_limits(spark, tight):
    """Ids that hold several texts join what their texts link to."""
    docs = [(i % 60, t) for i, t in near_copies(seed=4)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    comp = brute.components(docs)
    got = linked(jaccard_join.link_documents(df))
    assert got == {(i, len(brute.shingles(t)), comp[i]) for i, t in docs}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=12), min_size=2, max_size=30))
def test_divide_skip_finds_every_component(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    root = list(range(len(sets)))

    def find(r, x):
        while r[x] != x:
            x = r[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(root, i)] = find(root, j)
    mine = list(range(len(sets)))
    for i, j in jaccard_join.link_forest(arrays):
        assert 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
        mine[find(mine, i)] = find(mine, j)
    same = lambda r: [[find(r, i) == find(r, j) for j in range(len(r))] for i in range(len(r))]
    assert same(mine) == same(root)


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (-3, 500)]
    got = {r["node"]: r["component"] for r in rows_of(components.components(
        spark.createDataFrame(edges, "a long, b long")))}
    assert got == {**{k: 0 for k in range(51)}, **{k: 100 for k in range(100, 160)}, -3: -3, 500: -3}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stage_by_stage(spark):
    sf = SMALL
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = corpus_pipeline.COLUMNS
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality classifier"](spark, docs, sf).cache()
    assert kept.columns == columns
    good = {r[0] for r in duckdb.sql(
        f"select doc_id from read_parquet('{sf}/labels.parquet') where quality = 1").fetchall()}
    assert len(good & {r["doc_id"] for r in kept.collect()}) >= 0.95 * len(good)

    before = [(r["doc_id"], r["text"]) for r in kept.collect()]
    comp = brute.components(before)
    single = stages["n-gram Jaccard join"](spark, kept, sf).cache()
    assert single.columns == columns
    assert {r["doc_id"] for r in single.collect()} == {i for i, c in comp.items() if i == c}

    private = stages["PII"](spark, single, sf).cache()
    assert private.columns == columns
    for r in private.collect():
        assert not brute.pii(r["text"]) and r["n_chars"] == len(r["text"])

    mixed = stages["mixing"](spark, private, sf).cache()
    assert mixed.columns == columns
    sizes = {}
    for r in private.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.WORD.findall(r["text"]))
    goal = brute.targets(sizes)
    taken = dict.fromkeys(goal, 0)
    for r in mixed.collect():
        taken[r["source"]] += len(brute.WORD.findall(r["text"]))
    assert abs(sum(taken.values()) - sum(goal.values())) < 0.15 * sum(goal.values())
    per_doc = [r["count"] for r in mixed.groupBy("doc_id").count().collect()]
    assert max(per_doc) <= 2

    packed = stages["best-fit packing"](spark, mixed, sf)
    check_packing(rows_of(packed), [(r["doc_id"], r["text"]) for r in mixed.collect()])


def test_pipeline_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        out = docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, SMALL)
            assert name == "best-fit packing" or out.columns == corpus_pipeline.COLUMNS
        assert (out.count() > 0) == (docs is odd)
