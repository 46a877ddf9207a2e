"""Whitening against one dense decomposition."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ebbtide.llm.whitening import whiten
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def compare(df, rows, components=16):
    want, n, share = brute.whitened(rows, components)
    got = {}
    for r in df.collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(got) == set(want)
    names = sorted(next(iter(got.values())))
    assert names == list(range(1, len(names) + 1))
    a = np.array([[got[i][k]["whitened"] for k in names] for i in sorted(got)])
    b = np.array([want[i][1][:len(names)] for i in sorted(got)])
    assert np.isfinite(b).all()
    a, b = a * np.sign((a * b).sum(axis=0)), b
    np.testing.assert_allclose(a, b, atol=1e-8)
    for i in got:
        for k in names:
            r = got[i][k]
            assert (r["n"], r["deviation"]) == (n, want[i][0])
            assert abs(r["explained"] - share[k - 1]) <= 1e-9 and r["identity_error"] < 1e-9
    return len(names)


def test_small(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding")
    assert compare(whiten(vectors), [tuple(r) for r in vectors.collect()]) == 16


def test_odd_rows(spark):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 1 + k) for k in range(5)] + [7.5, 2.0 ** 40]) for i in range(40)]
    rows += [(100 + i, list(v)) for i, v in rows[:7]]  # repeated vectors count once in the fit
    bad = [(200, None), (201, []), (202, [None] * 7), (203, [float("nan")] * 7), (204, [float("inf")] + [0.0] * 6), (205, [1.0])]
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in rows + bad], "vec_id long, embedding array<double>, n int, x int").repartition(3)
    # Two columns are constant, so only five components have variance.
    assert compare(whiten(df), rows, 5) == 5


def test_equal_variances(spark):
    """Opposite corners: all deviations are equal, and any basis will do."""
    rows = [(2 * k + s, [0.0] * k + [1.0 - 2 * s] + [0.0] * (5 - k)) for k in range(6) for s in range(2)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == set(range(1, 7))
    assert all(abs(r["explained"] - 1 / 6) < 1e-12 and r["identity_error"] < 1e-12 for r in got)


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, [0.5, 0.25]), (None, [0.5, 0.25])], schema)).count() == 0


def test_too_large(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        whiten(df).collect()
