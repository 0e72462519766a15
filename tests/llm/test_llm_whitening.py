"""Spectrum slicing against numpy's eigenvalues and plain integer arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pytest

from forumlens.llm import whitening

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, n int, __x string, component string"


def plain(rows: list, most: int = 4):
    """{(row number, component): (n, deviation, |whitened|, explained)} by eigh and Python integers."""
    if not rows:
        return {}
    x = [[math.floor(256 * c) + 0 for c in v] for _, v in rows]
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, sums = len(fit), fit.sum(0)
    mean = np.array([s / n for s in sums], float)
    centred = fit.astype(float) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for i, v in enumerate(x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        for k in range(1, min(most, len(values)) + 1):
            e = values[-k]
            if e > 1e-9 * values.sum():
                out[i, k] = (n, deviation, abs(float((np.array(v, float) - mean) @ vectors[:, -k]) / math.sqrt(e)), e / values.sum())
    return out


def check(got, rows):
    want = plain(rows)
    place: dict = {}
    for i, (key, _) in enumerate(rows):
        place.setdefault(key, []).append(i)
    seen: dict = {}
    assert len(got) == len(want)
    for x in got:
        seen[x["vec_id"], x["component"]] = seen.get((x["vec_id"], x["component"]), 0) + 1
        n, deviation, white, explained = want[place[x["vec_id"]][0], x["component"]]
        assert (x["n"], x["deviation"]) == (n, deviation)
        assert abs(x["whitened"]) == pytest.approx(white, rel=1e-7, abs=1e-7)
        assert x["explained"] == pytest.approx(explained, rel=1e-9)
        assert x["identity_error"] <= 1e-9
    assert all(c == len(place[key]) for (key, _), c in seen.items())


def test_inertia_counts():
    r = np.random.default_rng(0)
    for n in (1, 2, 3, 7, 40):
        for t in range(12):
            a = r.normal(size=(n, n))
            a = np.round(a) * (r.random((n, n)) < 0.4) if t % 3 == 0 else a
            a = a + a.T
            values = np.linalg.eigvalsh(a)
            if np.abs(values).min() > 1e-9:
                assert whitening.negative_pivots(a) == (values < 0).sum()


def test_pairs_of_multiple_and_zero_eigenvalues():
    many = np.diag([5.0, 5.0, 5.0, 2.0, 2.0, 0.0, 0.0])
    pairs = whitening.leading_pairs(many, 6)
    assert [round(e, 9) for e, _ in pairs] == [5, 5, 5, 2, 2]
    along = np.array([v for _, v in pairs])
    assert np.allclose(along @ along.T, np.eye(5), atol=1e-12) and np.allclose(many @ along.T, along.T * [5, 5, 5, 2, 2])
    assert whitening.leading_pairs(np.zeros((3, 3))) == [] and whitening.leading_pairs(np.zeros((0, 0))) == []


def test_whitening_against_plain(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(r.normal(size=(300, 12)) * np.linspace(3, 0.2, 12))]
    rows += [(400 + i, rows[7][1]) for i in range(90)] + [rows[3], rows[3], (None, rows[4][1])]
    bad = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11),
           (904, [1.0, 2.0]), (905, []), (906, [3e38] * 12)]
    table = spark.createDataFrame([(*x, 1, "x", "y") for x in rows + bad], SCHEMA).repartition(5)
    usable, d = whitening.usable(table)
    got = whitening.fit(usable, d).transform(usable)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), rows)


def test_few_vectors_and_dimensions(spark):
    for rows in ([(1, [0.5])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])], [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [-2.0, 0.25])], []):
        table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        usable, d = whitening.usable(table)
        check(whitening.fit(usable, d).transform(usable).collect(), rows)


def test_large_deviations_are_exact_or_null():
    model = whitening.Whitening.__new__(whitening.Whitening)
    model.d, model.n, model.sums = 2, 3, [10, -4]
    x = np.array([[1 << 20, 5], [1 << 40, 1], [0, 0]])
    assert model.deviations(x) == [(3 * (1 << 20) - 10) ** 2 + 19 ** 2, None, 116]


def test_registered_query(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    check(whitening.op13_spectrum_slicing(spark, SMALL).collect(), [(x["vec_id"], x["embedding"]) for x in table.collect()])
