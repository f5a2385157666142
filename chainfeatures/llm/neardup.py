"""MinHash near-duplicates: universal-hash minima, banding, signature verification,
exact confirmation, components by alternating large-star and small-star.

Steps, each on whole tables:

1. every document becomes a set of hashed word shingles, 120 minima of universal
   hashes (multiply-shift), 24 band keys of 5 minima, and a signature of one
   bit for each minimum;
2. documents with the same set form a class, of which only the smallest id goes on,
   so thousands of copies cost one partial aggregation;
3. members of a band bucket are compared with pivots of the bucket, not with each other:
   a signature test first, then the full sets.  After each round, buckets whose
   members are all connected are done; the rest meet new pivots, and in the end all
   pairs of a bucket that still lie in different components are tried.  So no link
   that could join two components is skipped, and a large group never emits all its pairs;
4. the links are contracted to components by alternating large-star and
   small-star on tables in the shared folder.

With 5 rows and 24 bands, a pair of similarity 0.85 misses all bands with a
probability below 1e-6; the signature test lets it pass within five standard deviations.

Defined cases: a text without words has an empty set, is linked with nothing and kept;
with fewer than five words the whole sequence is the only shingle; rows with a null id
stand alone (component null, kept); rows that share an id are one node, whatever their
texts; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batch_rows, shared_table
from .words import BLANK_SEPARATED, blocks, mix, whole, windows, words

SHINGLE = 5
ROWS, BANDS = 5, 24
HASHES = ROWS * BANDS
#: Differing signature bits of 120 up to which a pair is confirmed on full sets; at
#: similarity 0.85 the mean is 9 and the standard deviation 2.9.
MAX_DIFFER = 25
#: Pivot rounds before all open pairs are tried, and the open pairs for each bucket
#: member up to which they are tried at once.
ROUNDS, OPEN_PER_MEMBER = 3, 1
#: Documents that a Python worker is handed at a time.
BATCH_ROWS = 2000

_rng = np.random.default_rng(4711)
_A = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingle_sets(texts: list[bytes], k: int = SHINGLE):
    """Yields (index of the first text, distinct sorted shingle hashes of the block's texts in
    a row, start of each text's part, size of each part)."""
    for i, j, buf, starts in blocks(texts):
        h, s, _ = words(buf, BLANK_SEPARATED)
        doc = np.searchsorted(starts, s, "right") - 1
        n_words = np.bincount(doc, minlength=j - i)
        first = np.cumsum(n_words) - n_words
        sh = windows(h, k)
        parts = []
        for d in range(j - i):
            n, f = n_words[d], first[d]
            if n >= k:
                p = sh[f:f + n - k + 1]
                p.sort()
                parts.append(p[np.flatnonzero(np.diff(p, prepend=~p[:1]))] if len(p) > 1 else p)
            elif n:
                parts.append(np.array([whole(h[f:f + n])], np.uint64))
            else:
                parts.append(sh[:0])
        sizes = np.array([len(p) for p in parts], np.int64)
        yield i, np.concatenate(parts) if parts else sh[:0], np.cumsum(sizes) - sizes, sizes


def signatures(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima (uint32) of every universal hash over each non-empty part."""
    out = np.empty((len(starts), HASHES), np.uint32)
    for q in range(HASHES):
        v = ((flat * _A[q] + _B[q]) >> np.uint64(32)).astype(np.uint32)
        out[:, q] = np.minimum.reduceat(v, starts)
    return out


def _sketch(batches):
    """(doc_id, no_id, text) -> shingle count, set identity, band keys and signature bits."""
    band_of = np.arange(BANDS, dtype=np.uint64)
    for pdf in batches:
        texts = [t.encode() if t else b"" for t in pdf["text"]]
        n_out, c1, c2, bits = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.zeros((len(texts), 2), np.int64)
        keys: list = [np.empty(0, np.int64)] * len(texts)
        for i, flat, starts, sizes in shingle_sets(texts):
            n_out[i:i + len(sizes)] = sizes
            full = np.flatnonzero(sizes)
            if not len(full):
                continue
            st = starts[full]
            c1[i + full] = np.add.reduceat(mix(flat), st).view(np.int64)
            c2[i + full] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), st).view(np.int64)
            sig = signatures(flat, st)
            key = np.zeros((len(full), BANDS), np.uint64)
            for r in range(ROWS):
                key = mix(key + sig[:, r::ROWS].astype(np.uint64) + (band_of << np.uint64(40)) + np.uint64(r + 1))
            for x, d in enumerate(full):
                keys[i + d] = key[x].view(np.int64)
            one = np.zeros((len(full), 128), np.uint8)
            one[:, :HASHES] = sig & np.uint32(1)
            bits[i + full] = np.packbits(one, axis=1).view(np.int64)
        ids = pd.arrays.IntegerArray(pdf["doc_id"].to_numpy(np.int64), pdf["no_id"].to_numpy(bool))
        yield pd.DataFrame({"doc_id": ids, "n_shingles": n_out, "c1": c1, "c2": c2, "bands": keys, "s1": bits[:, 0], "s2": bits[:, 1]})


def _sets(batches):
    for pdf in batches:
        texts = [t.encode() if t else b"" for t in pdf["text"]]
        for i, flat, starts, sizes in shingle_sets(texts):
            yield pd.DataFrame({"doc": pdf["doc_id"].iloc[i:i + len(sizes)].to_numpy(),
                                "shingles": [flat[a:a + n].view(np.int64) for a, n in zip(starts, sizes)]})


def connected_components(links: DataFrame, most: int, name: str = "cc") -> DataFrame:
    """``links(a, b)``, at most about ``most``, -> ``(node, component)``, the component being its smallest node.

    Large-star hangs every larger neighbour of a node on the smallest node it sees,
    small-star does so for the smaller ones; both repeat until only stars are left.  The
    minima are written before they are joined back, so the join may split a hub."""
    e = shared_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name, most)
    n = e.count()

    def stars(x):
        roles = x.groupBy("u").agg(F.count(F.lit(1)).alias("up"), F.lit(0).alias("down")).unionByName(
            x.groupBy(F.col("v").alias("u")).agg(F.lit(0).cast("long").alias("up"), F.lit(1).alias("down")))
        both = roles.groupBy("u").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        return not both.agg(F.count(F.when((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)), 1))).first()[0]

    while n and not stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = shared_table(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m")), name, n)
        large = both.filter("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = shared_table(large, name, n)
        least = shared_table(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c"), name, n)
        joined = large.join(least, F.col("u") == F.col("c"))
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()
        e = shared_table(small, name, n)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _differ(p: str, q: str):
    return (F.bit_count(F.col(f"{p}1").bitwiseXOR(F.col(f"{q}1"))) + F.bit_count(F.col(f"{p}2").bitwiseXOR(F.col(f"{q}2")))) <= MAX_DIFFER


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb"))
    j = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    return j.withColumn("i", common).filter(F.col("i") * 100 >= percent * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b")


def _open_members(members: DataFrame, comp: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The members of buckets that still hold several components, and the number of their open pairs."""
    m = shared_table(members.join(comp, F.col("doc") == F.col("node")).drop("node"), "open", n)
    per = m.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("k"), ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("open"))
    per = shared_table(per.filter("k > 1"), "open-buckets", n)
    left = per.agg(F.sum("open")).first()[0] or 0
    return (shared_table(m.join(per.select("bucket"), "bucket"), "open-members", n) if left else m), left


def _open_pairs(m: DataFrame, sets: DataFrame, percent: int, n: int) -> DataFrame:
    """All pairs (a, b) of a bucket and of different components that can still be similar.

    A prefix test spares most pairs of a large group: with shingles sorted from rare to
    common, two sets of that similarity share one within their first few, and what comes
    before the first shared one in either set is lost to the intersection.  Pairs for which
    this leaves too little are not emitted; no similar pair is among them."""
    docs = shared_table(m.groupBy("doc").agg(F.min("s1").alias("s1"), F.min("s2").alias("s2"), F.min("component").alias("component"),
                                             F.collect_set("bucket").alias("buckets")), "open-docs", n)
    tokens = sets.join(docs.select("doc"), "doc").select("doc", F.size("shingles").alias("n"), F.explode("shingles").alias("t"))
    often = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("c"))
    ranked = tokens.join(often, "t").groupBy("doc").agg(F.min("n").alias("n"), F.array_sort(F.collect_list(F.struct("c", "t"))).alias("o"))
    size = F.col("n") - F.floor((F.lit(percent) * F.col("n") + 99) / 100) + 1
    prefix = ranked.select("doc", "n", F.posexplode(F.slice("o", F.lit(1), size.cast("int"))).alias("i", "x")).filter("x.c > 1")
    prefix = prefix.select("doc", "n", "i", F.col("x.t").alias("t")).join(docs, "doc")
    prefix = shared_table(prefix, "prefixes", n)
    y = prefix.select("t", *[F.col(c).alias(f"y_{c}") for c in ("doc", "n", "i", "component", "buckets")], F.col("s1").alias("t1"), F.col("s2").alias("t2"))
    rest = F.least(F.col("n") - F.col("i"), F.col("y_n") - F.col("y_i"))
    return (prefix.join(y, (prefix["t"] == y["t"]) & (F.col("component") < F.col("y_component"))
                        & ((100 + percent) * rest >= percent * (F.col("n") + F.col("y_n"))) & _differ("s", "t") & F.arrays_overlap("buckets", "y_buckets"))
            .select(F.least("doc", "y_doc").alias("a"), F.greatest("doc", "y_doc").alias("b")).distinct())


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    arrow_batch_rows(docs.sparkSession, BATCH_ROWS)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # no nulls among the ids that pandas sees: next to one it would turn large ids into floats
    filled = d.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text")
    sig = shared_table(filled.mapInPandas(_sketch, "doc_id long, n_shingles long, c1 long, c2 long, bands array<long>, s1 long, s2 long"), "sketch")
    n_docs = sig.count()

    copies = shared_table(sig.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("c1", "c2", "n_shingles")
                          .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "classes", n_docs)
    known = shared_table(sig.join(copies, ["c1", "c2", "n_shingles"], "left")
                         .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"),
                                 F.when(F.coalesce("rep", "doc_id") == F.col("doc_id"), F.col("bands")).alias("bands"), "s1", "s2", F.coalesce("copies", F.lit(1)).alias("copies")), "classed")
    bands = known.filter("n_shingles > 0 AND doc_id = rep").select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("doc"), "s1", "s2", "copies")
    shared = shared_table(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket"), "buckets", BANDS * n_docs)
    members = shared_table(bands.hint("merge").join(shared, "bucket").distinct(), "members", BANDS * n_docs)

    # ids that occur with several texts join the classes of those texts
    ids = shared_table(known.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a <> z").select("doc_id", "a"), "ids", n_docs)
    same_id = known.select("doc_id", F.col("rep").alias("b")).join(ids, "doc_id").filter("a <> b").select("a", "b")

    candidates = shared_table(members.select(F.col("doc").alias("doc_id")).distinct(), "candidates", n_docs)
    # repeated rows once; the join has already dealt the texts out by id
    texts = d.hint("merge").join(candidates, "doc_id").dropDuplicates(["doc_id", "text"])
    sets = shared_table(texts.mapInPandas(_sets, "doc long, shingles array<long>"), "sets")

    n_members = members.count()
    first = connected_components(same_id, n_docs)
    comp = shared_table(candidates.select(F.col("doc_id").alias("node")).unionByName(first.select("node")).distinct()
                        .join(first, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "comp", n_docs)

    def linked(pairs: DataFrame, comp: DataFrame) -> DataFrame:
        links = shared_table(confirm(shared_table(pairs, "pairs", n_members), sets, percent), "links", n_members)
        ends = (links.join(comp.select(F.col("node").alias("a"), F.col("component").alias("x")), "a")
                .join(comp.select(F.col("node").alias("b"), F.col("component").alias("y")), "b"))
        merged = connected_components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")), n_members)
        merged = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
        return shared_table(comp.join(merged, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "comp", n_docs)

    for turn in range(ROUNDS + 1):
        m, left = _open_members(members, comp, n_members)
        if not left:
            break
        if turn == ROUNDS or (turn and left <= OPEN_PER_MEMBER * n_members):
            comp = linked(_open_pairs(m, sets, percent, n_members), comp)
            break
        # pivots: the text with most copies and the smallest id, later ones at random
        who = F.struct("doc", "s1", "s2", "component")
        one, other = (F.struct("copies", F.xxhash64("doc")), -F.col("doc")) if turn == 0 else (F.xxhash64("doc", F.lit(turn)), -F.xxhash64("doc", F.lit(turn)))
        pivots = m.groupBy("bucket").agg(F.max_by(who, one).alias("p"), F.max_by(who, other).alias("q"))
        pivots = shared_table(pivots.select("bucket", F.explode(F.array("p", "q")).alias("p")).select(
            "bucket", F.col("p.doc").alias("pivot"), F.col("p.s1").alias("t1"), F.col("p.s2").alias("t2"), F.col("p.component").alias("other")), "pivots", n_members)
        pairs = (m.join(pivots, "bucket").filter("doc <> pivot AND component <> other").filter(_differ("s", "t"))
                 .select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b")).distinct())
        comp = linked(pairs, comp)

    out = known.select("doc_id", "n_shingles", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    out = out.withColumn("component_id", F.coalesce("component", "rep"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def op4_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
