"""Whitening: bit planes against plain products, results against numpy and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from cartpulse.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, component string, n int, vector int"


def table(frame, rows):
    return frame(SCHEMA, [(i, None if v is None else [None if c is None else float(c) for c in v], "c", 1, 2) for i, v in rows])


@pytest.mark.parametrize("high", [2, 75, 1 << 36])
def test_scatter_is_exact(high):
    x = np.random.default_rng(1).integers(0, high, (130, 5))
    x[:, 3] = 0
    widths = [int(c.max()).bit_length() for c in x.T]
    exact = x.astype(object)
    want = np.triu(exact.T @ exact)
    assert (whitening.scatter(x, widths) == want).all()


def test_bit_planes_hold_every_bit():
    x = np.random.default_rng(2).integers(0, 1 << 7, (100, 3))
    planes = whitening.bit_planes(x, [7] * 3)
    assert planes.shape == (21, 2)
    ones = np.unpackbits(planes.view(np.uint8), axis=1)[:, :100].reshape(3, 7, 100)
    assert ((ones * (1 << np.arange(7))[:, None]).sum(axis=1) == x.T).all()


def test_against_numpy(frame):
    draw = np.random.default_rng(3)
    vectors = draw.normal(0, 0.3, (400, 40)).astype(np.float32) @ draw.normal(0, 0.3, (40, 40)).astype(np.float32)
    rows = list(enumerate(vectors.astype(np.float32).tolist())) + [(7, vectors[7].tolist())]
    got = whitening.whiten(table(frame, rows).repartition(7)).toPandas()
    x = np.array([[math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v] for _, v in rows])
    n, centred = len(x), x - x.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:32], directions[:, ::-1][:, :32]
    assert len(got) == n * 32 and set(got.component) == set(range(1, 33)) and set(got.n) == {n}
    deviation = {i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(axis=0), strict=True)) for (i, _), row in zip(rows, x, strict=True)}
    assert all(deviation[i] == d for i, d in zip(got.vec_id, got.deviation, strict=True))
    explained = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, values / np.trace(centred.T @ centred / n), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    want = centred @ directions / np.sqrt(values)
    for k in range(32):
        mine = got[got.component == k + 1].set_index("vec_id").whitened.groupby(level=0).first()
        other = np.array([want[i, k] for i in mine.index])
        sign = np.sign((mine * other).sum())
        assert np.allclose(mine, sign * other, atol=1e-6)


def test_unsound_vectors_go(frame):
    good = [(i, [i % 3, (i * i) % 5]) for i in range(20)]
    bad = [(30, None), (31, [None, 1]), (32, [math.nan, 1]), (33, [math.inf, 1]), (34, [1]), (35, []), (36, [1, 2, 3]), (37, [1e20, 0])]
    got = whitening.whiten(table(frame, [*good, *bad, (None, [1, 1])])).toPandas()
    assert len(got) == 21 * 2 and set(got.n) == {21}
    assert got.vec_id.isna().sum() == 2 and set(got.vec_id.dropna()) == set(range(20))


def test_nothing_that_varies(frame):
    for rows in ([], [(1, [1, 2])], [(1, [1, 2]), (2, [1, 2])], [(1, None), (2, [])]):
        got = whitening.whiten(table(frame, rows))
        assert got.collect() == [] and got.columns[0] == "vec_id"


def test_a_dependent_dimension_gives_no_component(frame):
    got = whitening.whiten(table(frame, [(i, [i, 2 * i, (i * 7) % 5]) for i in range(30)])).toPandas()
    assert set(got.component) == {1, 2} and got.identity_error[0] < 1e-9


def test_large_entries_stay_exact(frame):
    rows = [(i, [(-1) ** i * 2.0**33 * (i + 1) / 16, i]) for i in range(15)]
    got = whitening.whiten(table(frame, rows)).toPandas()
    assert got.identity_error[0] < 1e-4 and got.deviation.isna().all()  # beyond a long
