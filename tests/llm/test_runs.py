import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from chainfeatures.llm import runs as R


def brute(words):
    """Every run by trying all periods."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)  # periods ascend: the least one stays
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def digest(doc_id, text):
    w = [x for x in (text or "").encode().split()]
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    drop = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    kept = b" ".join(x for k, x in enumerate(w) if k not in drop)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_random_sequences_equal_brute_force(monkeypatch):
    r = random.Random(5)
    texts = []
    for k in range(400):
        sigma, n = r.choice([1, 2, 2, 3, 5]), r.randint(0, 90)
        w = [b"%d" % r.randrange(sigma) for _ in range(n)]
        for _ in range(r.randint(0, 3)):
            q, at = r.randint(1, 9), r.randint(0, len(w))
            unit = [b"%d" % r.randrange(sigma + 1) for _ in range(q)]
            w[at:at] = (unit * 9)[:r.randint(q, 8 * q)]
        texts.append(w)
    want = [brute(w) for w in texts]
    assert sum(map(len, want)) > 300
    assert [[tuple(x) for x in got.tolist()] for got in R.runs_of(texts)] == want
    monkeypatch.setattr(R, "BATCH_WORDS", 50)
    assert [[tuple(x) for x in got.tolist()] for got in R.runs_of(texts)] == want


def test_nested_and_long_runs():
    inner = [b"a", b"b"] * 5 + [b"c"]
    texts = [inner * 6, [b"x"] * 5000, [b"y"] * 5, ([b"p", b"q", b"r"] * 400)[:-1] + [b"p"] * 7, [b"f", b"a", b"f", b"b"] * 3 + [b"f"]]
    for w, got in zip(texts, R.runs_of(texts)):
        assert [tuple(x) for x in got.tolist()] == brute(w)


def test_suffix_array_and_lcp():
    r = np.random.default_rng(3)
    for n, sigma in ((200, 2), (50, 1), (300, 9)):
        x = np.append(r.integers(1, sigma + 1, n), 0)
        s = R.SuffixArray(x, np.zeros(n + 1, np.int64))
        suffixes = [tuple(x[i:]) for i in range(n + 1)]
        assert s.sa.tolist() == sorted(range(n + 1), key=lambda i: suffixes[i])
        lcp = s.lcp()
        for j in range(1, n + 1):
            a, b = suffixes[s.sa[j - 1]], suffixes[s.sa[j]]
            k = 0
            while k < min(len(a), len(b)) and a[k] == b[k]:
                k += 1
            assert lcp[j] == k


def test_table_equals_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    rows = [(i, " ".join((t or "").split()[:1500])) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in R.periodic_runs(df, planted=True).collect())
    want = sorted(digest(i, t) for i, t in rows)
    assert got == want and sum(w[1] > 0 for w in want) > 5


def test_edge_cases(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    clash = edge_docs.withColumn("id", F.lit("z")).withColumn("start", F.lit(1)).withColumn("period", F.lit(2))
    got = R.periodic_runs(clash, planted=True).collect()
    short = [(i, t) for i, t in rows if len(t or "") < 9000]
    assert sorted([tuple(r) for r in got if (r["doc_id"]) != 7], key=str) == sorted((digest(i, t) for i, t in short if i != 7), key=str)
    long = next(r for r in got if r["doc_id"] == 7)
    assert long["period"] == 12 and long["length"] == 48000 and long["n_runs"] == 1
    assert R.periodic_runs(no_docs, planted=True).count() == 0
    big = spark.createDataFrame([(9007199254740993, "a " * 20), (None, "b " * 20)], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in R.periodic_runs(big).collect()} == {9007199254740993, None}
