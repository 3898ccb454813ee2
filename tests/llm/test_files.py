"""Token files, packing, mixing and formatting."""

import hashlib
from collections import defaultdict
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelops.llm import best_fit, chat_trees, elias_fano, pivotal_mix
from panelops.llm.queries import QUERIES

from . import brute
from .conftest import SMALL, rows_of


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano_returns_its_values(steps):
    values = np.cumsum(steps, dtype=np.int64)
    ef = elias_fano.EliasFano.encode(values, int(values[-1]) if len(values) else 0)
    assert ef.all().tolist() == values.tolist()
    assert [ef[i] for i in range(len(values))] == values.tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.full(10_000, 700), dtype=np.int64)
    ef = elias_fano.EliasFano.encode(values, int(values[-1]))
    assert 8 * (len(ef.low) + len(ef.high)) / 10_000 < 13  # 64 plain


def test_segment_round_trip():
    arrays = [np.array(x, np.uint32) for x in ([1], [70000, 2, 1], [], [5, 1])]
    for docs in ([-5, 0, 0, 9], [None, None, -(2**63), 2**63 - 1], [None, -(2**62), 0, 2**62]):
        seg = elias_fano.Segment(elias_fano.encode_segment(docs, arrays))
        assert seg.doc_ids == docs
        assert [seg[i].tolist() for i in (3, 0, 2, 1)] == [arrays[i].tolist() for i in (3, 0, 2, 1)]
    empty = elias_fano.Segment(elias_fano.encode_segment([], []))
    assert len(empty) == 0 and empty.doc_ids == []


def test_bounds_come_from_the_stored_directory():
    arrays = [np.full(n, 7, np.uint32) for n in np.random.default_rng(1).integers(1, 900, 3000)]
    raw = elias_fano.encode_segment(list(range(3000)), arrays)
    seg = elias_fano.Segment(raw)
    ends = np.cumsum([len(a) for a in arrays])
    assert [seg.bounds(i) for i in (2999, 0, 1500, 1501)] == [
        (0 if i == 0 else ends[i - 1], ends[i]) for i in (2999, 0, 1500, 1501)]
    assert len(seg.ends.before) == -(-8 * len(seg.ends.high) // 512)
    broken = elias_fano.EliasFano(
        3000, seg.ends.low_bits, seg.ends.low, seg.ends.high, seg.ends.before[::-1].copy())
    with pytest.raises(IndexError):  # nothing else is looked at
        broken[1500]


def test_token_files(spark, odd, empty, small_docs):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    got = {r["doc_id"]: r for r in rows_of(QUERIES["op2_elias_fano"](spark, SMALL))}
    at = 0
    for i, text, _ in small_docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), crc32(ids))
        at += len(ids)
    path = elias_fano.new_path(spark, "odd")
    elias_fano.write_token_files(odd, path, public_tokenizers.path("word_bpe_49k.json"), max_ids=50)
    rows = sorted(rows_of(elias_fano.read_token_files(spark, path)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 9, 10, 11]
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist()
    assert rows[1]["n_tokens"] == rows[2]["n_tokens"] == rows[3]["n_tokens"] == 1
    many = spark.createDataFrame(
        [(k if k % 3 else None, f"t{k % 50}") for k in range(600)], "doc_id long, text string")
    path = elias_fano.new_path(spark, "hot")
    elias_fano.write_token_files(many, path, public_tokenizers.path("word_bpe_49k.json"), max_ids=64)
    hot = sorted(rows_of(elias_fano.read_token_files(spark, path)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in hot] == [None] * 200 + [k for k in range(600) if k % 3]
    files = spark.read.parquet(path)
    assert files.select("part").distinct().count() > 1
    path = elias_fano.new_path(spark, "empty")
    elias_fano.write_token_files(empty, path, public_tokenizers.path("word_bpe_49k.json"))
    assert elias_fano.read_token_files(spark, path).count() == 0


def check_packing(rows, docs, size=1024, end=2):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    by_doc = defaultdict(list)
    places = defaultdict(list)
    for r in rows:
        by_doc[(r["doc_id"], r["copy"])].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = sorted(
        ([*tok.encode(t or "", add_special_tokens=False).ids, end] for _, t in docs), key=len
    )
    assert len(by_doc) == len(expected)
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(np.array([*tok.encode(t or "", add_special_tokens=False).ids, end], "<u4"))
    for (i, _), pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        n = sum(p["length"] for p in pieces)
        ids = next(x for x in texts[i] if len(x) == n)
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        at = 0
        for k, p in enumerate(pieces):
            assert p["start"] == at and p["ids_crc32"] == crc32(ids[at : at + p["length"]])
            assert p["length"] == size or (k == 0 and p["length"] <= size)
            at += p["length"]
    for placed in places.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def test_packing(spark, odd, empty, small_docs):
    rows = rows_of(QUERIES["op6_best_fit"](spark, SMALL))
    n = check_packing(rows, [(i, t) for i, t, _ in small_docs])
    # Online: the last bins stay part-filled, which shows on 200 documents.
    assert n <= 1.03 * sum(r["length"] for r in rows) / 1024
    larger = QUERIES["op6_best_fit"](spark, "/root/testdata/sf0.01")
    filled = larger.agg(F.count_distinct("sequence_id").alias("n"), F.sum("length").alias("t")).first()
    assert filled["n"] <= 1.02 * filled["t"] / 1024
    tok = public_tokenizers.path("byte_bpe_50k.json")
    odd_docs = [(r["doc_id"], r["text"]) for r in rows_of(odd)]
    check_packing(rows_of(best_fit.pack(odd, tok, group_docs=4)), odd_docs)
    assert best_fit.pack(empty, tok).count() == 0


def test_full_groups_close_bins():
    """With the query's own bound and a full group the fullest bins close."""
    g = np.random.default_rng(2)
    bins = best_fit.OpenBins(best_fit.SEQUENCE_TOKENS, best_fit.OPEN_BINS)
    sizes = [n for d in g.exponential(500, best_fit.GROUP_DOCS) for _, n in best_fit.cut_pieces(int(d) + 1, 1024)]
    for n in sizes:
        bins.place(n)
    assert bins.n_closed > 100
    assert bins.n_bins <= 1.03 * sum(sizes) / 1024


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=80), st.integers(1, 6))
def test_open_bins_are_bounded_and_tightest(sizes, limit):
    bins = best_fit.OpenBins(32, limit)
    used, open_free = defaultdict(int), {}
    for n in sizes:
        fits = [f for f in open_free.values() if f >= n]
        b, offset = bins.place(n)
        assert offset == used[b]
        if fits:
            assert 32 - offset == min(fits)
        elif len(open_free) >= limit:
            fullest = min(open_free.values())
            del open_free[next(k for k, f in open_free.items() if f == fullest and k not in
                               [x for y in bins.by_free for x in y])]
        used[b] += n
        open_free[b] = 32 - used[b]
        if not open_free[b]:
            del open_free[b]
        assert used[b] <= 32 and bins.n_open == len(open_free) <= limit


def check_mix(rows, docs):
    sizes = defaultdict(int)
    source = {}
    for i, t, s in docs:
        sizes[s] += len(brute.WORD.findall(t or ""))
        source[i] = s
    goal = brute.targets(sizes)
    taken = defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        s = r["source"] if "source" in r else source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(goal[s])
        assert 0 <= r["copies"] <= 2
        taken[s] += r["size"] * r["copies"]
    return taken, goal


def test_mixing(spark, odd, empty, small_docs):
    for sf in (SMALL, "/root/testdata/sf0.01"):
        q = f"select doc_id, text, source from read_parquet('{sf}/documents.parquet')"
        rows = rows_of(QUERIES["op7_pivotal_mix"](spark, sf))
        taken, goal = check_mix(rows, duckdb.sql(q).fetchall())
        assert all(r["taken"] == r["size"] * r["copies"] for r in rows)
    # sf0.01: about 50 documents a source, so one document may be off.
    assert np.mean([abs(taken[s] - goal[s]) / goal[s] for s in goal]) < 0.02
    odd_rows = rows_of(pivotal_mix.mix(odd))
    check_mix(odd_rows, [(r["doc_id"], r["text"], r["source"]) for r in rows_of(odd)])
    again = rows_of(pivotal_mix.mix(odd.repartition(5)))
    key = lambda r: (str(r["doc_id"]), r["size"], r["copies"])
    assert sorted(map(key, again)) == sorted(map(key, odd_rows))
    assert pivotal_mix.mix(empty).count() == 0


def test_rounding_tree_keeps_the_words(spark):
    """Many levels (small blocks, no reserve) and one source with most units."""
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("source"),
        F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 97 + 1).cast("int")), " ").alias("text"),
    )
    old = pivotal_mix.BLOCK, pivotal_mix.RESERVE
    pivotal_mix.BLOCK, pivotal_mix.RESERVE = 4, 0
    try:
        rows = rows_of(pivotal_mix.mix(docs, weights=(1.0, 1.0), total_share=0.7))
    finally:
        pivotal_mix.BLOCK, pivotal_mix.RESERVE = old
    for s in "ab":
        mine = [r for r in rows if r["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= 97


def test_conversations(spark):
    q = f"select conv_id, role, text from read_parquet('{SMALL}/conversations.parquet') order by conv_id, turn, role, text"
    said = "</s>[INST] ok [/INST]"
    turns = defaultdict(list)
    for c, role, text in [*duckdb.sql(q).fetchall(), (-7, "user", said), (-7, "assistant", said)]:
        turns[c].append((role or "", text or ""))
    got = {r["conv_id"]: r for r in rows_of(QUERIES["op4_reply_trees"](spark, SMALL))}
    assert set(got) == set(turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, ts in turns.items():
        learned = "".join(t for role, t in ts if role == "assistant")
        r = got[c]
        assert r["n_turns"] == len(ts) and r["loss_chars"] == len(learned)
        assert r["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for a, b in ts))
        assert r["loss_sha256"] == sha(learned)


def test_reply_tree_paths(spark):
    """      1           a cycle 20 <-> 21 with a tail 22-23, an orphan 30
           2   3(deep chain 3-4-...-12)
    """
    nodes = [(1, None, 1.0), (2, 1, 5.0), *[(k, k - 1 if k > 3 else 1, 0.1) for k in range(3, 13)],
             (20, 21, 9.0), (21, 20, 9.0), (22, 20, 1.0), (23, 22, 1.0), (30, 99, 0.0)]
    rows = [("t", n, p, ["user", "assistant"][n % 2], f"<|im_end|>\n<\\|s {n} é", s) for n, p, s in nodes]
    rows += [("u", 1, None, None, None, None), ("\0", 7, None, "user", "zero", 0.0), (None, 1, None, "user", "x", 0.0),
             (None, 2, 1, "assistant", "y", 0.0), ("t", None, 1, "user", "lost", 0.0)]
    msgs = spark.createDataFrame(
        rows, "tree string, node long, parent long, role string, text string, score double"
    ).withColumn("up", F.lit("clash"))
    out = rows_of(chat_trees.format_conversations(msgs).select(
        "*", chat_trees.parse_turns(F.col("formatted")).alias("back"),
        chat_trees.masked_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    ))
    best = rows_of(chat_trees.format_conversations(msgs, branches=1))
    assert len(out) == 6
    got = {(r["tree"], r["leaf"]): r for r in out}
    assert set(got) == {("t", 2), ("t", 12), ("t", 30), ("u", 1), ("\0", 7), (None, 2)}
    assert got[None, 2]["n_turns"] == 2 and got[None, 2]["learned"] == "y"
    assert got["t", 2]["branch_rank"] == 1 and got["t", 12]["branch_rank"] == 2
    chain = [1, *range(3, 13)]
    assert [t["text"] for t in got["t", 12]["back"]] == [f"<|im_end|>\n<\\|s {n} é" for n in chain]
    assert got["t", 12]["learned"] == "".join(f"<|im_end|>\n<\\|s {n} é" for n in chain if n % 2)
    assert [t["role"] for t in got["u", 1]["back"]] == [""]
    assert {(r["tree"], r["leaf"]) for r in best} == {("t", 2), ("u", 1), ("\0", 7), (None, 2)}
    assert chat_trees.format_conversations(msgs.limit(0)).count() == 0


def test_ties_and_long_texts_of_branches(spark):
    """Equal scores: the longer branch, then the smaller leaf id."""
    long = "x" * 300_000
    rows = [(1, None, "r"), (2, 1, long), (3, 1, "c"), (4, 1, "d"), (5, 4, "e")]
    msgs = spark.createDataFrame(
        [("t", n, p, "assistant", t, 0.0) for n, p, t in rows],
        "tree string, node long, parent long, role string, text string, score double",
    )
    out = rows_of(chat_trees.format_conversations(msgs))
    assert [r["leaf"] for r in sorted(out, key=lambda r: r["branch_rank"])] == [5, 2, 3]
    assert max(len(r["formatted"]) for r in out) > 300_000


def test_odd_turns(spark, odd):
    turns = odd.select(F.col("doc_id").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.col("source").alias("role"), "*")
    rows = rows_of(chat_trees.format_conversations(chat_trees.linear_tree(turns)))
    assert sorted(r["n_turns"] for r in rows) == [1] * 10 + [2]


def test_repeated_rows_are_mixed_one_by_one(spark):
    rows = [(7, "a", "w " * 10)] * 1000 + [(100 + k, "a", "w " * 10) for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = rows_of(pivotal_mix.mix(docs, weights=(1.0,), total_share=0.75))
    assert len(mixed) == 2000
    taken = sum(r["size"] * r["copies"] for r in mixed)
    assert abs(taken - 15_000) <= 10
    assert 300 < sum(r["copies"] for r in mixed if r["doc_id"] == 7) < 1000


CONTROL = ["<|", "<\\|", "<s>", "</s>", "[INST]", "[/INST]", "[\\INST]", "<<SYS>>", "\\", "<", "|", "%0A",
           "%", "\n", "é", "[", "INST]"]


@pytest.fixture(scope="module")
def control_texts(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(CONTROL, rng.integers(0, 9))) for _ in range(2000)]
    return spark.createDataFrame([(t,) for t in texts], "t string")


def test_escaping_is_reversible(control_texts):
    t = F.col("t")
    bad = control_texts.where(
        (chat_trees.unescape(chat_trees.escape(t)) != t)
        | (chat_trees.unescape_role(chat_trees.escape_role(t)) != t)
        | chat_trees.escape(t).rlike(r"<\||</?s>|\[/?INST\]|<<SYS>>|<</SYS>>")
        | F.contains(chat_trees.escape_role(t), F.lit("\n"))
    )
    assert bad.count() == 0
