import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainfeatures.llm import language_model as L
from chainfeatures.llm import seating as S
from chainfeatures.llm.tiles import tiled, unpack, unpack_sorted

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def tokens(text):
    return (text or "").encode().translate(LOWER).split() + [None]


def base(rows):
    """Counts and base scores by the contract."""
    c = Counter(w for i, t in rows if not held_out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = tokens(t)
        out.append((i, held_out(i), len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)))
    return sorted(out, key=str)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def check(got, rows):
    want = base(rows)
    got = sorted(((*list(r)[:5], r["base_score"], r["score"]) for r in got), key=str)
    key = lambda r: (str(r[0]), r[2], r[3])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-12, atol=1e-9)
    assert all(math.isfinite(g[6]) and g[6] <= 1e-6 for g in got)
    return got


def test_table(docs):
    rows = rows_of(docs)
    got = check(L.score_texts(docs).collect(), rows)
    new = [g for g in got if g[1]]
    assert new and sum(g[6] for g in new) > sum(g[5] for g in new)  # better than the base where it did not learn
    again = check(L.score_texts(docs, tile_bytes=150_000, part_bytes=100_000, slice_tokens=300).collect(), rows)
    gain = [sum(g[6] for g in x if g[1]) / sum(g[2] for g in x if g[1]) for x in (got, again)]
    assert abs(gain[0] - gain[1]) < 0.02  # other parts draw other seats; slices of contexts change nothing else


def _predictive(model):
    """Words, contexts and the averaged predictive probabilities, from the model's tables by plain dictionaries."""
    vocabulary = {}
    for r in model.vocabulary.collect():
        vocabulary.update(zip(unpack_sorted(r["keys"]).tolist(), unpack(r["counts"], np.int64).tolist()))
    dishes = [r for r in model.pairs.filter("kind = 0").collect()]
    out = {}
    for seated, parent, level, sliced in model.samples:
        own = {}
        for r in parent.filter("kind = 0").collect():
            own.update(zip(unpack_sorted(r["a"]).tolist(), unpack(r["b"], np.float64).tolist()))
        t_of = {r["part"]: unpack(r["a"], np.int64) for r in seated.filter("kind = 0").collect()}
        for w in [*vocabulary, "unknown"]:
            out.setdefault(("", w), []).append((own.get(w, 0.0) + (level.strength + level.discount * level.tables) / level.classes) / (level.strength + level.customers))
        total = sum(own.values()) + model.strength + level.discount * level.tables
        assert abs(total - (model.strength + level.customers)) < 1e-6 * total
        assert level.customers == sum(int(t.sum()) for t in t_of.values()) + sum(int(unpack(r["b"], np.uint32).sum()) for r in dishes)
        for r in dishes:
            d = L.Dishes(r, model.hot)
            t = t_of[r["part"]]
            assert (t >= 1).all() and (t <= d.customers).all()
    return out, len(vocabulary)


def test_parent_probabilities_sum_to_one(docs):
    rows, _, total = tiled(docs, "doc_id", "text", 300_000, learn=F.lit(True))
    model = L.train(rows, total, part_bytes=200_000)
    p, v = _predictive(model)
    for k in range(len(model.samples)):
        assert abs(sum(x[k] for x in p.values()) - 1) < 1e-9 and len(p) == v + 1


def test_context_probabilities_sum_to_one(spark):
    """From scores of texts alone: if the continuations of every word x sum to 1, then
    P(x | start) = S(x) + sum over y of S(x y) / S(y) * P(y | start); its solution must sum to 1 with S(empty)."""
    train = [(k, t) for k, t in enumerate(["a b", "a b c", "a c", "b", "", "a b a b", "c c c", "b a"] * 30) if not held_out(k)]
    words = ["a", "b", "c", "zz"]  # all three that are known, and the class of the unknown
    asked = ["", *words, *[f"{x} {y}" for x in words for y in words]]
    ids = [k for k in range(10_000, 60_000) if held_out(k)]
    df = spark.createDataFrame(train + list(zip(ids, asked)), "doc_id long, text string")
    for slices in (L.SLICE, 40):
        got = {r["doc_id"]: 10 ** r["score"] for r in L.score_texts(df, slice_tokens=slices).collect()}
        s = {t: got[i] for i, t in zip(ids, asked)}
        m = np.array([[s[f"{x} {y}"] / s[y] for y in words] for x in words])
        start = np.linalg.solve(np.eye(4) - m, [s[x] for x in words])
        assert (start > 0).all() and abs(start.sum() + s[""] - 1) < 1e-5
        assert s["a b"] > s["b c"] > s["zz zz"]


@pytest.mark.parametrize("c,a,b,d", [(1, 0.3, 0.1, 0.5), (3, 0.4, 0.2, 0.3), (12, 1.5, 0.05, 0.7), (40, 0.1, 0.0, 0.8)])
def test_seating_equals_one_by_one(c, a, b, d):
    r, n = np.random.default_rng(1), 20_000
    dish, size = S.seat(np.full(n, c), np.full(n, a), np.full(n, b), d, r)
    assert (np.bincount(dish, weights=size) == c).all() and (size >= 1).all()
    t = np.bincount(dish)
    largest = np.zeros(n, np.int64)
    np.maximum.at(largest, dish, size)
    slow_t, slow_largest = [], []
    for _ in range(4000):
        tables = []
        for j in range(c):
            new = (a + b * len(tables)) if tables else 1.0
            weights = [x - d for x in tables] + [new]
            k = r.choice(len(weights), p=np.array(weights) / sum(weights))
            if k == len(tables):
                tables.append(1)
            else:
                tables[k] += 1
        slow_t.append(len(tables))
        slow_largest.append(max(tables))
    assert abs(t.mean() - np.mean(slow_t)) < 5 * np.std(slow_t) / 60 + 1e-9
    assert abs(largest.mean() - np.mean(slow_largest)) < 5 * np.std(slow_largest) / 60 + 1e-9


def test_gibbs_steps_reach_the_exact_distribution():
    a, b, d, c, n = 0.8, 0.3, 0.4, 4, 40_000
    rng = np.random.default_rng(7)
    dish, size = np.arange(n), np.full(n, c)
    counts = np.full(n, c)
    for _ in range(40):
        dish, size = S.reseat(dish, size, counts, np.full(n, a), np.full(n, b), d, rng)
        assert (np.bincount(dish, weights=size, minlength=n) == c).all()
    shape = Counter()
    cuts = np.flatnonzero(np.diff(dish)) + 1
    for s in np.split(size, cuts):
        shape[tuple(sorted(s.tolist()))] += 1
    ways = {(4,): 1, (1, 3): 4, (2, 2): 3, (1, 1, 2): 6, (1, 1, 1, 1): 1}
    rise = lambda k: math.prod(i - d for i in range(1, k))
    weight = {s: w * math.prod(a + b * k for k in range(len(s))) * math.prod(rise(k) for k in s) for s, w in ways.items()}
    total = sum(weight.values())
    for s, w in weight.items():
        assert abs(shape[s] / n - w / total) < 0.012, (s, shape[s] / n, w / total)


def test_edge_cases(spark, edge_docs, no_docs):
    rows = rows_of(edge_docs)
    check(L.score_texts(edge_docs.withColumn("tile", F.lit("t")).withColumn("id", F.lit(3))).collect(), rows)
    assert L.score_texts(no_docs).count() == 0
    none = [(k, "only held out texts") for k in range(2000) if held_out(k)][:3]
    got = check(L.score_texts(spark.createDataFrame(none, "doc_id long, text string")).collect(), none)
    assert all(abs(g[6]) < 1e-9 and g[4] == 0 for g in got)  # one class, the unknown
    big = [(9007199254740993, "a b"), (None, "a c")]
    check(L.score_texts(spark.createDataFrame(big, "doc_id long, text string").coalesce(1)).collect(), big)
