import random

import numpy as np
import pytest

from chainfeatures.llm import neardup as N
from chainfeatures.llm.words import BLANK_SEPARATED, windows, words

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Component of each id: all pairs of distinct sets, compared in full."""
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(t))
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    by = {}
    for i, ss in sets.items():
        for s in ss:
            if s:
                by.setdefault(s, []).append(i)
    for ids in by.values():
        for j in ids[1:]:
            a, b = sorted((find(ids[0]), find(j)))
            up[b] = a
    keys = list(by)
    for x in range(len(keys)):
        for y in range(x):
            s, t = keys[x], keys[y]
            if min(len(s), len(t)) * 100 < 85 * max(len(s), len(t)):
                continue
            if 100 * len(s & t) >= 85 * len(s | t):
                a, b = sorted((find(by[s][0]), find(by[t][0])))
                up[b] = a
    return {i: find(i) for i in sets}


def edited(r, base, n):
    w = base.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"w{r.randrange(10**6)}"
    return " ".join(w)


def test_word_hashes_tell_words_apart():
    h, s, e = words(b"Abc abc ABC abd\tx  y\nlonger", BLANK_SEPARATED)
    assert h[0] == h[1] == h[2] != h[3] and len(set(h.tolist())) == 5
    assert [(a, b) for a, b in zip(s, e)][:2] == [(0, 3), (4, 7)]
    big = ("q" * 3_000_000 + " z").encode()
    assert len(words(big, BLANK_SEPARATED)[0]) == 2
    assert len(windows(h, 5)) == len(h) - 4


def test_groups_of_near_copies_equal_brute_force(spark):
    """Large groups with few and many edits, where pivots do not reach every member."""
    r = random.Random(5)
    rows, i = [], 0
    for g in range(6):
        base = " ".join(f"g{g}t{r.randrange(4000)}" for _ in range(140))
        for _ in range(40):
            i += 1
            rows.append((i, edited(r, base, r.choice([0, 0, 1, 1, 2, 2, 3, 4, 5]))))
        for _ in range(6):  # chains: each a small edit of the one before
            i += 1
            base = edited(r, base, 2)
            rows.append((i, base))
    r.shuffle(rows)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    want = brute(rows)
    assert dict(zip(got["doc_id"], got["component_id"])) == want
    assert all(got["kept"] == (got["doc_id"] == got["component_id"]))


def test_open_pairs_lose_nothing(spark, monkeypatch):
    """Without any pivot round everything is left to the prefix test."""
    monkeypatch.setattr(N, "ROUNDS", 0)
    test_groups_of_near_copies_equal_brute_force(spark)


def test_table_equals_brute_force(spark, docs):
    got = N.near_duplicates(docs).toPandas()
    rows = [(x["doc_id"], x["text"]) for x in docs.select("doc_id", "text").collect()]
    assert dict(zip(got["doc_id"], got["component_id"])) == brute(rows)
    assert dict(zip(got["doc_id"], got["n_shingles"])) == {i: len(shingles(t)) for i, t in rows}


def test_edge_cases(edge_docs, no_docs):
    got = N.near_duplicates(edge_docs).collect()
    assert len(got) == edge_docs.count()
    rows = [(x["doc_id"], x["text"]) for x in edge_docs.select("doc_id", "text").collect()]
    want = brute(rows)
    for g in got:
        assert g["component_id"] == want.get(g["doc_id"]) and g["kept"] == (g["doc_id"] is None or want[g["doc_id"]] == g["doc_id"])
    assert {g["n_shingles"] for g in got if g["doc_id"] in (4, 5, 6)} == {0}
    assert N.near_duplicates(no_docs).count() == 0


def test_one_id_with_two_texts_joins_their_groups(spark):
    a = " ".join(f"a{k}" for k in range(30))
    b = " ".join(f"b{k}" for k in range(30))
    got = N.near_duplicates(spark.createDataFrame([(5, a), (2, a), (5, b), (9, b)], "doc_id long, text string")).collect()
    assert {g["component_id"] for g in got} == {2}


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in N.connected_components(spark.createDataFrame(links, "a long, b long"), 200).collect()}
    assert {got[k] for k in range(1, 41)} == {1} and {got[k] for k in range(100, 160)} == {100}


def test_signature_minima():
    flat = np.arange(1, 50, dtype=np.uint64) * np.uint64(7919)
    sig = N.signatures(flat, np.array([0, 20]))
    want = min(int((int(x) * int(N._A[3]) + int(N._B[3])) % 2**64 >> 32) for x in flat[20:])
    assert sig.shape == (2, N.HASHES) and sig[1, 3] == want


def test_large_ids_next_to_null_ids(spark):
    t = "one two three four five six seven eight nine ten eleven twelve"
    df = spark.createDataFrame([(9007199254740993, t), (None, t), (9007199254740995, t), (None, None)], "doc_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in N.near_duplicates(df).collect()}
    big = 9007199254740993
    assert {g[:1] + g[2:] for g in got} == {(big, True), (big + 2, False), (None, True)} and (big + 2, big, False) in got
