"""Whitening against numpy on the whole fit list."""

import math
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelops.llm import whitening
from panelops.llm.queries import QUERIES

from .conftest import SMALL, rows_of


def check(got, rows, components=4):
    """``rows``: (vec_id, vector) that remain."""
    x = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v in rows]
    fit = sorted({v for _, v in x})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    by_id = defaultdict(list)
    for r in got:
        by_id[r["vec_id"]].append(r)
    k = max((r["component"] for r in got), default=0)
    assert k == min(components, np.linalg.matrix_rank(cov, hermitian=True))
    assert Counter(r["vec_id"] for r in got) == Counter({i: k * c for i, c in Counter(i for i, _ in x).items()})
    signs = np.zeros(k)
    for i, v in x:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))
        for r in by_id[i]:
            assert (r["n"], int(r["deviation"])) == (n, deviation)
            j = r["component"] - 1
            gap = min(abs(values[j] - e) for m, e in enumerate(values) if m != j) if d > 1 else 1
            assert r["explained"] == pytest.approx(values[j] / np.trace(cov), rel=1e-9)
            assert r["identity_error"] < 1e-9
            if gap < 1e-6 * values[0]:
                continue
            want = (np.array(v) - np.array([s / n for s in sums])) @ vectors[:, j] / np.sqrt(values[j])
            if abs(want) < 1e-6:
                continue
            signs[j] = signs[j] or np.sign(want * r["whitened"])
            assert r["whitened"] * signs[j] == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_query(spark):
    rows = duckdb.sql(
        f"select vec_id, embedding from read_parquet('{SMALL}/embeddings.parquet')"
    ).fetchall()
    got = rows_of(QUERIES["op13_whitening"](spark, SMALL))
    check(got, rows)


def table(spark, rows, entry="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{entry}>")
    return df.withColumns({c: F.lit("clash") for c in ("x", "v", "n", "component", "size", "at")})


def test_odd_rows(spark):
    good = [
        (1, [0.5, -0.25, 1.0]), (2, [0.1, 0.2, 0.3]), (2, [0.1, 0.2, 0.3]), (None, [4.0, -3.0, 0.0]),
        (5, [0.5, -0.25, 1.0]), (6, [100.0, 7.0, -2.5]), (7, [-0.001, 0.0, -0.0]),
    ]
    bad = [
        (8, None), (9, [1.0, None, 2.0]), (10, [float("nan"), 0.0, 0.0]), (11, [float("inf"), 1.0, 1.0]),
        (12, []), (13, [1.0, 2.0]), (14, [1.0, 2.0, 3.0, 4.0]),
    ]
    got = rows_of(whitening.whiten(table(spark, good + bad)))
    single = [(i, [np.float32(c) for c in v]) for i, v in good]
    check(got, single)


def test_vectors_that_differ_in_few_dimensions(spark):
    rows = [(k, [k / 8, 2 * k / 8, 1.0, (k * k % 5) / 4]) for k in range(12)]
    got = rows_of(whitening.whiten(table(spark, rows)))
    assert max(r["component"] for r in got) == 2
    check(got, rows)


def test_no_component(spark):
    assert rows_of(whitening.whiten(table(spark, []))) == []
    assert rows_of(whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))) == []
    assert rows_of(whitening.whiten(table(spark, [(1, None), (2, [])]))) == []


def test_deviation_beyond_64_bits(spark):
    rows = [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [0.5, 3.0])]
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i + 1: sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    got = rows_of(whitening.whiten(table(spark, rows, "double")))
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 14), st.integers(0, 10**6))
def test_factor_and_rotations(d, rows, seed):
    g = np.random.default_rng(seed)
    x = g.integers(-300, 300, (rows, d)).astype(float) * g.choice([1, 1e-3, 40], d)
    x -= x.mean(axis=0)
    a = x.T @ x
    factor = whitening.pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a, atol=1e-9 * max(1, a.max()))
    u, norms = whitening.one_sided_jacobi(factor)
    assert np.allclose(u.T @ u, np.eye(len(norms)), atol=1e-10)
    assert np.allclose((u * norms**2) @ u.T, a, atol=1e-9 * max(1, a.max()))
    assert (np.diff(norms) <= 0).all()
