"""Whitening against numpy's own eigenvectors, with nulls, repeats, ranks below the length, extreme entries and empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def spectra():
    rng = np.random.default_rng(1)
    yield np.sort(rng.random(64))
    yield np.ones(8)
    yield np.array([5.0])
    yield np.array([3.0, 3.0, 3.0, 1.0, 1.0, 0.0, 0.0])
    yield 10.0 ** -np.arange(12)
    yield np.array([1.0, 1 + 1e-15, 1 + 1e-13, 2.0, 2.0, -1.0])
    yield np.zeros(5)
    yield 1e6 * np.concatenate([np.ones(30), 1 + 1e-9 * rng.random(30)])


@pytest.mark.parametrize("values", list(spectra()), ids=lambda v: f"{len(v)}")
def test_eigenvectors(values):
    rng = np.random.default_rng(2)
    for turn in (np.eye(len(values)), np.linalg.qr(rng.standard_normal((len(values),) * 2))[0]):
        v = turn * values @ turn.T
        v = (v + v.T) / 2
        got, vectors = whitening.eigenvectors(v)
        scale = max(np.abs(values).max(), 1e-300)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
        assert np.abs(got - np.linalg.eigvalsh(v)[::-1]).max() <= 1e-13 * scale
        assert np.abs(v @ vectors - vectors * got).max() <= 2e-13 * scale and (np.diff(got) <= 1e-15 * scale).all()


def test_polar():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    values, vectors = np.linalg.eigh(a)
    assert np.abs(whitening.polar(a) - vectors * np.sign(values) @ vectors.T).max() < 1e-12


def plain(table):
    """n, deviations, whitened (signs free) and explained of usable vectors of one length."""
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in table], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(r, sums))) for r in x]
    centred = lambda m: ((n * m - sums) / n).astype(float)
    v = centred(fit).T @ centred(fit) / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    return n, deviation, centred(x) @ vectors, values, values / np.trace(v)


def compare(rows, ids, vectors):
    n, deviation, projected, values, explained = plain(vectors)
    width = len(values)
    assert len(rows) == len(ids) * width
    got = {}
    for r in rows:
        got.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    for k, (key, d) in enumerate(zip(ids, deviation)):
        own = got[key, d]
        for c in range(width):
            for r in own[c + 1]:
                assert r["n"] == n and abs(r["explained"] - explained[c]) <= 1e-12 and 0 <= r["identity_error"] < 1e-9
                if values[c] > 1e-9 * values[0]:
                    assert abs(abs(r["whitened"]) - abs(projected[k, c]) / np.sqrt(values[c])) < 1e-6
                else:
                    assert r["whitened"] is None


def test_whiten(spark):
    rng = np.random.default_rng(4)
    good = (rng.standard_normal((200, 20)) @ rng.standard_normal((20, 20)) / 8).astype(np.float32).tolist()
    odd = [(900, None, 1), (901, [None] * 20, 1), (902, [float("nan")] * 20, 1), (903, [float("inf")] * 20, 1), (None, [1e30] * 20, 1), (904, [], 1)]
    rows = [(k, v, 0) for k, v in enumerate(good)] + [(1000, good[0], 0)] * 150 + [(1001, [0.0] * 20, 0)] + odd
    table = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("n", F.lit("x")).withColumn("x", F.lit(1)).withColumn("id", F.lit(2))
    found = whitening.whiten(table).collect()
    kept = [(r[0], r[1]) for r in rows if r not in odd]
    assert len({r["vec_id"] for r in found}) == 202
    compare(found, [k for k, _ in kept], [v for _, v in kept])


def test_ranks_lengths_and_extremes(spark):
    flat = [(k, [float(k), 2.0 * k, 1.0], 0) for k in range(9)]
    pairs = [(100 + k, [float(k % 3), float(k % 2)], 0) for k in range(12)]
    found = whitening.whiten(spark.createDataFrame(flat + pairs, SCHEMA)).collect()
    compare([r for r in found if r["vec_id"] < 100], [k for k, _, _ in flat], [v for _, v, _ in flat])
    compare([r for r in found if r["vec_id"] >= 100], [k for k, _, _ in pairs], [v for _, v, _ in pairs])
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3, SCHEMA)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, 0.0)] * 6
    large = [(k, [(-1.0) ** k * 1e10 * (k + 1), float(k % 2)], 0) for k in range(6)]
    wide = whitening.whiten(spark.createDataFrame(large, SCHEMA)).collect()
    n, deviation, *_ = plain([v for _, v, _ in large])
    assert {(r["vec_id"], r["deviation"]) for r in wide} == {(k, d if d < 2**63 else None) for k, d in enumerate(deviation)}
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_op12_whitening(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    found = queries.op12_whitening(spark, "/root/testdata/sf0.01").collect()
    compare(found, [r["vec_id"] for r in table], [r["embedding"] for r in table])
    assert len({(r["n"], r["identity_error"]) for r in found}) == 1 and len(found) == 16 * len(table)
