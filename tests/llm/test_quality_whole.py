"""The quality model is learned from every pair of labelled rows, without lists of pairs."""

import zlib

import numpy as np
import pandas as pd
import pytest

from chainfeatures.llm import learn
from chainfeatures.llm import quality as Q


def _rows(n, seed=5, far=0.0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 4))
    x[::97, 2] *= 1 + far
    y = (x @ np.array([1.5, -1.0, 0.3, 0.0]) + r.normal(size=n) > -0.5).astype(int)
    return x, y


def _gradient(m, x, y):
    """Of the mean loss of all pairs, pair by pair."""
    z = (x - m.mean) / m.scale
    diff = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1])
    return -(learn.sigmoid(-(diff @ m.weights))[:, None] * diff).mean(0) + Q.PENALTY / len(y) ** 0.5 * m.weights


@pytest.mark.parametrize("far", [0.0, 300.0])
def test_weights_are_the_optimum_of_all_pairs(far):
    x, y = _rows(700, far=far)
    m = Q.fit(x, y)
    assert np.abs(_gradient(m, x, y)).max() < 1e-7
    s = ((x - m.mean) / m.scale) @ m.weights
    assert m.cut == pytest.approx(np.quantile(s, (y == 0).mean(), method="midpoint"), abs=1e-9)


def test_labels_that_a_line_parts():
    x, _ = _rows(300)
    y = (x[:, 0] > 0.2).astype(int)
    x[:, 0] += y
    m = Q.fit(x, y)
    assert np.isfinite(m.weights).all() and np.abs(_gradient(m, x, y)).max() < 1e-6
    assert ((m.rank(x) >= m.cut) == (y == 1)).all()


def test_pairs_met_by_nodes_equal_pairs_one_by_one():
    r = np.random.default_rng(2)
    s, y = np.concatenate([r.normal(size=200) * 5, r.normal(size=30) * 300]), r.integers(0, 2, 230)
    piece, v = Q.basis(s)
    sums = Q._by_key("mass", 2 * piece + y, v)
    bad, good = Q._Side(sums, 0), Q._Side(sums, 1)
    d = s[y == 0][None] - s[y == 1][:, None]
    total, _, loss = Q._push(good, bad, 1)
    assert loss == pytest.approx(np.logaddexp(0, d).sum(), rel=1e-12) == Q._push(bad, good, -1)[2]
    at = np.searchsorted(good.piece, piece[y == 1])
    assert (v[y == 1] * total[at]).sum(1) == pytest.approx(learn.sigmoid(d).sum(1), rel=1e-10, abs=1e-10)


def test_table_equals_arrays(spark):
    x, y = _rows(900)
    x[:40], y[:40] = x[0], np.arange(40) % 2  # copies with both labels
    m = Q.fit_table(spark.createDataFrame(pd.DataFrame({"x": [v.tolist() for v in x], "label": y}), "x array<double>, label int").repartition(5))
    want = Q.fit(x, y)
    assert m.weights == pytest.approx(want.weights, abs=1e-6) and m.cut == pytest.approx(want.cut, abs=1e-6) and m.mean == pytest.approx(want.mean)


@pytest.mark.parametrize("values", [[2.0] * 9, [0.0, 1e-9, 1e9, 1e9, -3.0, 5.0, 5.0], list(np.random.default_rng(0).normal(size=5000) ** 5)])
def test_ranks_of_scores(spark, values):
    scores, want = spark.createDataFrame([(v,) for v in map(float, values)], "s double"), sorted(values)
    for k in {0, len(values) // 3, len(values) - 1}:
        assert Q._at_rank(scores, k) == want[k]


def test_learns_from_every_labelled_row(spark):
    """More labelled rows than a sample of ``MAX_TRAIN``; repeated ids count once, held-out and null ones never."""
    n = learn.MAX_TRAIN * 3 // 2
    text = lambda i: ("word " * (i % 7) + "x" * (i % 11) + "!" * (i % 5)).strip()
    docs = spark.createDataFrame([(i, text(i)) for i in range(n)] + [(3, text(3)), (None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 7 // 3 % 2) for i in range(n)] + [(3, 1), (None, 1)], "doc_id long, quality int")
    ids = [i for i in range(n) if zlib.crc32(str(i).encode()) % 5]
    assert len(ids) > learn.MAX_TRAIN
    m = Q.train(docs, labels)
    x = Q.features([text(i).encode() for i in ids])
    assert m.mean == pytest.approx(x.mean(0), abs=1e-9) and m.scale == pytest.approx(np.maximum(x.std(0), 1e-3), abs=1e-9)
    want = Q.fit(x, np.array([i % 7 // 3 % 2 for i in ids]) | (np.array(ids) == 3))
    assert m.rank(x) == pytest.approx(want.rank(x), abs=1e-3) and m.cut == pytest.approx(want.cut, abs=1e-3)
