"""Quality classifier, LLR rules, PII and URL reputation."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelops.llm import llr_rules, pii_anchors, quality_fm, url_reputation
from panelops.llm.queries import QUERIES

from . import brute
from .conftest import SMALL, rows_of


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    model = quality_fm.Model(
        0.3, rng.normal(size=quality_fm.WIDTH), rng.normal(size=(quality_fm.WIDTH, 8))
    )
    index, values = np.array([3, 90, 2000]), np.array([0.5, 1.0, 2.0])
    pairs = sum(
        model.v[index[i]] @ model.v[index[j]] * values[i] * values[j]
        for i in range(3) for j in range(i + 1, 3)
    )
    expected = 0.3 + model.w[index] @ values + pairs
    assert model.margins(index, values, np.array([0]))[0] == pytest.approx(expected)


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op1_quality_fm"](spark, sf).toPandas().set_index("doc_id")
    for i, held in got["held_out"].items():
        assert held == (zlib.crc32(str(i).encode()) % 4 == 2)
    marks = duckdb.sql(f"select doc_id, quality from read_parquet('{sf}/labels.parquet')").df()
    got["y"] = marks.set_index("doc_id")["quality"]
    held = got[got["held_out"] & got["y"].notna()]
    assert ((held["score"] >= 0.7) == (held["y"] == 1)).mean() >= 0.93
    assert (held["score"][held["y"] == 1] >= 0.7).mean() >= 0.97
    assert got["score"].between(0, 1).all()


def test_classifier_odd_rows(spark, odd, empty):
    assert quality_fm.fit(odd, empty.select("doc_id", F.lit(1).alias("label"))) is None
    model = quality_fm.fit(
        odd, spark.createDataFrame([(5, 1), (5, 0), (9, 0), (4, 1), (99, 1), (None, 1), (7, None)],
                                   "doc_id long, label int")
    )
    got = quality_fm.score_documents(odd, model, "score")
    assert set(odd.columns) == set(got.columns)
    scores = [r["score"] for r in rows_of(got)]
    assert len(scores) == 12 and all(0 <= s <= 1 for s in scores)
    by_id = {r["doc_id"]: r["score"] for r in rows_of(got)}
    assert by_id[10] == by_id[11]  # equal texts
    assert got.where("doc_id = 5").select("score").distinct().count() == 1
    assert quality_fm.score_documents(empty, model).count() == 0
    assert {r["score"] for r in rows_of(quality_fm.score_documents(odd, None))} == {1.0}


def test_base_rules(spark, odd, empty, small_docs):
    trusted = spark.createDataFrame([(4,), (4,), (None,)], "doc_id long")
    for r in rows_of(llr_rules.judge(odd, trusted)):
        text = next(x["text"] for x in rows_of(odd) if x["doc_id"] == r["doc_id"])
        stats = brute.base_stats(text)
        assert stats == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                         r["n_repeat_words"])
        assert r["base_failed"] == (stats[0] < 10 or 100 * stats[4] > 20 * stats[0])
        assert not (r["base_failed"] and r["kept"])
    assert llr_rules.judge(odd, trusted).count() == odd.count()
    assert llr_rules.judge(empty, trusted).count() == 0
    untrusted = rows_of(llr_rules.judge(odd, trusted.limit(0)))
    assert all(r["kept"] != r["base_failed"] for r in untrusted)
    got = QUERIES["op3_llr_rules"](spark, SMALL).toPandas().set_index("doc_id")
    for i, text, _ in small_docs:
        r = got.loc[i]
        assert brute.base_stats(text) == tuple(
            r[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]
        )


def test_ratio_scores_by_definition(spark):
    docs = [(1, "a b c a b"), (2, "a b d"), (3, "z z q"), (4, "a")]
    trusted = {1, 4}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    buckets = 1 << 20
    xx = lambda *ws: _chain(ws) % buckets
    cells = {}
    for i, text in docs:
        w = text.split()
        cells[i] = [xx(x) for x in w] + [xx(a, b) for a, b in zip(w, w[1:], strict=False)]
    raw = pd.Series([c for x in cells.values() for c in x]).value_counts()
    tgt = pd.Series([c for i in trusted for c in cells[i]]).value_counts()
    pseudo = llr_rules.PSEUDO * buckets
    got = {r["doc_id"]: r["score"] for r in rows_of(llr_rules.judge(
        df, spark.createDataFrame([(i,) for i in trusted], "doc_id long"), buckets=buckets))}
    for i, own in cells.items():
        ratios = []
        for c in own:
            r, t = raw[c] - 1, max(0, tgt.get(c, 0) - (i in trusted))
            share = r / raw.sum()
            ratios.append(np.log((t + pseudo * share) / (tgt.sum() + pseudo) / share) if r else 0.0)
        assert got[i] == pytest.approx(np.mean(ratios), abs=2e-6)


def _chain(words):
    """Spark's xxhash64 of several strings: each result seeds the next."""
    seed = 42
    for w in words:
        seed = brute.xx(w, seed % (1 << 64))
    return seed


def spans_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_personal_data_matches_the_patterns(spark, odd, empty, small_docs):
    got = QUERIES["op5_pii_anchors"](spark, SMALL).toPandas().set_index("doc_id")
    for i, text, _ in small_docs:
        expected = spans_text(brute.pii(text))
        assert got["base_sha256"][i] == hashlib.sha256(expected.encode()).hexdigest()
        assert set(filter(None, expected.split(","))) <= set(got["spans"][i].split(","))
    found = {r["doc_id"]: r["spans"] for r in rows_of(pii_anchors.find_spans(odd))}
    assert [s["kind"] for s in found[7]] == ["email"] * 6
    assert found[1] == found[2] == []
    assert pii_anchors.find_spans(empty).count() == 0
    cleaned = {r["doc_id"]: r["text"] for r in rows_of(pii_anchors.redact(odd))}
    assert cleaned[1] is None and cleaned[7].startswith("mail [EMAIL] or [EMAIL],")
    assert cleaned[6] == "One  two\nthree"


PIECES = ["a@b.c", "@", ".", "1.2.3.4", "255", "256", "+1", " 555-", "(22)", "4111 1111 1111 1111",
          "-", " ", "x", "é", "1", "00", "12345678", "+", "a.b-c@", "%", "..", "\n"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans_equal_leftmost_matches(text):
    got = [s for s in pii_anchors.Expander().spans(text) if s[0] in pii_anchors.BASE_KINDS]
    assert got == brute.pii(text)


def test_added_spans():
    text = 'see https://bob:pw@host.org/x token = "24be64439e3e49cf46b2" IBAN GB82 WEST 1234 5698 7654 32.'
    found = {(k, text[a:b]) for k, a, b in pii_anchors.Expander().spans(text)}
    assert ("login", "https://bob:pw@host.org") in found
    assert ("account", "24be64439e3e49cf46b2") in found
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in found


def plain_features(text, n_chars):
    """index -> value, from the text alone, word by word."""
    text = text or ""
    words, out = text.split(), {}
    if words:
        counts = {}
        for w in words:
            b = zlib.crc32(w.encode()) % quality_fm.BUCKETS
            counts[b] = counts.get(b, 0) + 1
        norm = math.sqrt(sum(math.log1p(c) ** 2 for c in counts.values()))
        out = {b: math.log1p(c) / norm for b, c in counts.items()}
        raw, n, lines = text.encode(), len(words), text.split("\n")
        share = lambda chars: sum(c in chars.encode() for c in raw) / len(raw)
        other = sum(c < 32 and c not in b"\t\n\x0b\x0c\r" or c == 127 for c in raw) / len(raw)
        stats = [
            math.log1p(n) / 10, min(len(text) / n / 20, 2), share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            share("0123456789") * 5, share(".,;:?'\"()-") * 3, share("#*$%&<>@~^_=+/\\{}[]`") * 3,
            share("|") * 3, share("!") * 3, share(" \t\n\x0b\x0c\r"), len(set(words)) / n,
            max(counts.values()) / n, 1 - len(set(lines)) / len(lines), min(n / len(lines) / 100, 1),
            len(re.findall(r"[^\s.,;:?!'\"()\w]{2,}(?=\s|\Z)", text)) / n, other * 10,
        ]
        out.update({quality_fm.BUCKETS + k: s for k, s in enumerate(stats) if s})
    size = len(text) if n_chars is None else n_chars
    klass = min(size.bit_length(), quality_fm.SIZES - 1)
    out[quality_fm.BUCKETS + len(quality_fm.STATS) + klass] = 0.5
    return out


def test_scores_equal_the_pairwise_sum(spark):
    """Every pair of features, summed one by one, for all documents."""
    q = f"select doc_id, text, n_chars from read_parquet('{SMALL}/documents.parquet')"
    rng = np.random.default_rng(9)
    v = rng.normal(0, 0.05, (quality_fm.WIDTH, quality_fm.FACTORS))
    w = rng.normal(0, 0.3, quality_fm.WIDTH)
    model = quality_fm.Model(0.2, w, v)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r["score"] for r in quality_fm.score_documents(docs, model).collect()}
    assert len(got) == 200
    for i, text, n_chars in duckdb.sql(q).fetchall():
        x = plain_features(text, n_chars)
        at, value = np.array(sorted(x)), np.array([x[k] for k in sorted(x)])
        # <v_i, v_j> x_i x_j of every pair i < j.
        products = (v[at] @ v[at].T) * np.outer(value, value)
        z = 0.2 + (w[at] * value).sum() + np.triu(products, 1).sum()
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5)


def test_repeated_rows_are_one_training_row(spark):
    rows = [(1, f"good words here {k}", 9) for k in range(3000)] + [(2, "bad", 3), (3, "bad", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0)], "doc_id long, label int")
    seen = []
    real = quality_fm.train
    quality_fm.train = lambda data, y, *a: seen.append((len(data), y.tolist())) or real(data, y, *a)
    try:
        a = quality_fm.fit(docs, labels)
        b = quality_fm.fit(docs.repartition(7), labels)
    finally:
        quality_fm.train = real
    assert seen == [(3, [1.0, 0.0, 0.0])] * 2
    assert (a.w == b.w).all() and (a.v == b.v).all()


def test_long_secrets_schemes_and_cues_in_any_case():
    spans = lambda t: {(k, t[a:b]) for k, a, b in pii_anchors.Expander().spans(t)}
    secret = "aB3" * 300
    assert ("account", secret) in spans(f'password = "{secret}"')
    scheme = "averyveryverylongscheme+more" * 5
    assert ("login", f"{scheme}://bob:pw@host.org") in spans(f"\u0130 9{scheme}://bob:pw@host.org")
    for cue in ("ApiKey", "Api_Key", "PassWord", "TOKEN", "Secret"):
        assert ("account", "abc123") in spans(f"\u0130\u212a {cue}=abc123")


URLS = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x?q#f"), (5, "x://net/"),
    (6, "http://b.example.com/de/1"), (7, "http://example.com/DE/1"), (8, "http://a.org/fr/"),
    (9, "http://a.org?x=/fr/"), (10, "http://sub.net"), (11, "a://b://c/d"), (12, "http://xnet/"),
    (12, "http://xnet/"), (13, "http://bad.org/9"), (14, "http://bad.org:80/p#://"),
]


def test_registered_domains(spark):
    hosts = ["bbc.co.uk", "a.bbc.co.uk:80", "co.uk", "x.org", "www.x.org:8080", "10.1.2.3:99", "h", ""]
    df = spark.createDataFrame([(h,) for h in hosts], "host string").select(
        url_reputation.domain_of(F.col("host")), url_reputation.suffix_of(F.col("host")))
    assert [tuple(r) for r in df.collect()] == [
        ("bbc.co.uk", "co.uk"), ("bbc.co.uk", "co.uk"), ("co.uk", "co.uk"), ("x.org", "org"),
        ("x.org", "org"), ("10.1.2.3", "10.1.2.3"), ("h", "h"), ("", ""),
    ]
    # Ten bad hosts below a shared suffix do not make a stranger there bad.
    outcomes = [(f"http://h{k}.co.uk/1", 0) for k in range(10) for _ in range(40)]
    outcomes += [(f"http://g{k}.com/1", 1) for k in range(10) for _ in range(40)]
    pages = [(1, "http://bbc.co.uk/"), (2, "http://h3.co.uk/x"), (3, "http://" + "l" * 200_000 + ".com/"),
             (4, "http://h3.co.uk:80/y")]
    got = {r["page_id"]: r["verdict"] for r in rows_of(url_reputation.judge_urls(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(outcomes, "url string, good int"),
        rules=[url_reputation.Rule("b.org", "/x", "block"), url_reputation.Rule("a.org", "/x", "allow")]))}
    assert got == {1: "allow", 2: "block", 3: "allow", 4: "block"}


def test_url_rules_and_parts(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("x"))
    outcomes = spark.createDataFrame(
        [("http://bad.org/1", 0)] * 60 + [("http://ok.org/1", 1)] * 60 + [(None, 1), ("http://q.de", None)],
        "url string, good int",
    )
    rows = rows_of(url_reputation.judge_urls(pages, outcomes))
    assert len(rows) == len(URLS)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[5] == ("net", "/", "net/", "block")
    assert got[6] == ("b.example.com", "/de/1", "example.com/de/", "block")
    assert got[7][2:] == (None, "allow")
    assert got[8] == ("a.org", "/fr/", "org/fr/", "allow")
    assert got[9] == ("a.org", "", None, "allow")
    assert got[10] == ("sub.net", "", None, "allow")
    assert got[11] == ("b:", "//c/d", None, "allow")
    assert got[12][2:] == (None, "allow")
    assert got[13][3] == "block"  # 60 bad pages
    # The port is part of the host, not of the domain whose pages are bad.
    assert got[14] == ("bad.org:80", "/p", None, "block")
    none = url_reputation.judge_urls(pages, outcomes.limit(0))
    assert {r["verdict"] for r in rows_of(none.where("rule is null"))} == {"allow"}
    assert url_reputation.judge_urls(pages.limit(0), outcomes).count() == 0
