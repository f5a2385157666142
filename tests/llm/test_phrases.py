import random
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from chainfeatures.llm import phrases as P

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=10, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in c.items() if len(q) == 3 and b >= least):
                continue
            s, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


def test_intervals_equal_counting():
    r = np.random.default_rng(2)
    x = np.append(r.integers(0, 6, 500), 0)
    index = P.FMIndex(x, 6)
    w, lo, hi = index.words()
    of, first, lo2, hi2, twin = index.extend(index.forward, lo, hi, lo)
    pairs = Counter(zip(x[:-1].tolist(), x[1:].tolist()))
    got = {(int(a), int(b)): int(n) for a, b, n in zip(first, w[of], hi2 - lo2)}
    assert got == {p: c for p, c in pairs.items() if 0 not in p}
    of3, third, lo3, hi3, _ = index.extend(index.backward, twin, twin + hi2 - lo2, lo2)
    triples = Counter(zip(x[:-2].tolist(), x[1:-1].tolist(), x[2:].tolist()))
    got = {(int(first[o]), int(w[of][o]), int(c)): int(n) for o, c, n in zip(of3, third, hi3 - lo3)}
    assert got == {p: c for p, c in triples.items() if 0 not in p}


def test_table_equals_brute_force(spark, docs):
    want = brute([(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()])
    assert len(want) > 100
    assert rows_of(P.collocations(docs)) == want
    assert rows_of(P.collocations(docs, tile_bytes=60_000, part_bytes=50_000)) == want


def test_sql_equals_brute_force(docs):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got = con.execute(P.OP12_SQL).fetchdf()[NAMES]
    assert sorted(tuple(x if isinstance(x, str) else int(x) for x in r) for r in got.itertuples(index=False)) == brute(
        [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()])


def test_ties_overlaps_and_low_counts(spark):
    r = random.Random(1)
    rows = [(r.choice(["en", None, "x"]), " ".join(r.choice("aAbcdé") + r.choice(["", "", ".", ",", "\t"]) for _ in range(r.randint(0, 60)))) for _ in range(120)]
    rows += [("en", "of the of the of the"), ("en", "new york city. New York City!"), ("en", None), ("en", "")] * 6
    df = spark.createDataFrame([(i % 90, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    for least, top in ((10, 2000), (2, 7)):
        assert rows_of(P.collocations(df, least=least, top=top, tile_bytes=500, part_bytes=300)) == brute(rows, least, top)


def test_products_beyond_64_bits(spark):
    n = 3_000_000_000_000
    df = spark.createDataFrame([(n, n - 1, n + 7)], "a long, l long, r long")
    assert df.select(F.expr(P.score("a", "l", "r"))).first()[0] == 1000000 * n * n // ((n - 1) * (n + 7))


def test_edge_cases(edge_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in edge_docs.select("lang", "text").collect()]
    got = rows_of(P.collocations(edge_docs.withColumn("tile", F.lit("t")).withColumn("w1", F.lit(1)), least=2))
    assert got == brute(rows, least=2)
    assert P.collocations(no_docs).count() == 0
