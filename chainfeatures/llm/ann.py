"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

Largest inner product becomes least distance by one more coordinate, ``sqrt(M^2 - |x|^2)``
with ``M`` the largest norm (0 for a query), so the tree prunes by Euclidean distance.

1. the tree is fitted on a bounded sample (``MAX_SAMPLE`` vectors by hash order) and has
   at most ``MAX_SAMPLE / LEAST_LEAF`` leaves; it is the only thing sent to all tasks;
2. every vector descends to its leaf; neighbouring leaves form a *block* of about ``BLOCK`` vectors, and a leaf of
   more than that is several blocks by hash of the id, so a very common vector is spread over tasks;
3. the number of leaf visits is calibrated: sample queries are searched in the sample by
   brute force, and visits are widened until the leaves visited hold the target share
   of their true neighbours;
4. each query walks the tree with a priority queue of nodes, nearest centre first, until it has
   that many leaves and they hold enough rows besides those of its own id.  A batch of queries goes to a block as one row: their
   vectors as one matrix and which leaves of the block each of them visits.  A matrix product finds what can be among the
   best, that is scored in double precision, and the best of each block are merged at the end.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components, or
have another length than most, take no part, nor do null ids; equal scores are ordered by id; a query id
that is repeated is asked once, a candidate as often as it is there; rows with the
query's own id are no candidates; fewer candidates than asked for give fewer rows; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table

MAX_SAMPLE = 20_000
LEAST_LEAF = 8
LEAF = 400
BLOCK = 16_000
#: Scores that a task holds at a time.
SCORES = 1 << 20
BRANCH = 8
TARGET_RECALL = 0.97
CALIBRATION = 200


class Tree:
    """Nodes in arrays: centre, children (empty for a leaf), leaf number (-1 inside)."""

    def __init__(self, x: np.ndarray, leaf_size: int, seed: int = 5):
        self.centers: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.n_leaves = 0
        rng = np.random.default_rng(seed)
        todo = [(x, None, x.mean(0) if len(x) else np.zeros(x.shape[1]))]
        while todo:
            rows, parent, center = todo.pop()
            me = len(self.leaf)
            self.centers.append(center)
            self.children.append([])
            self.leaf.append(-1)
            if parent is not None:
                self.children[parent].append(me)
            groups = self._split(rows, rng) if len(rows) > leaf_size else []
            if len(groups) < 2:
                self.leaf[me] = self.n_leaves
                self.n_leaves += 1
            todo += [(g, me, g.mean(0)) for g in groups] if len(groups) > 1 else []
        self.all = np.stack(self.centers)
        self.stacked = [np.stack([self.centers[c] for c in ch]) if ch else None for ch in self.children]

    @staticmethod
    def _split(rows: np.ndarray, rng) -> list[np.ndarray]:
        distinct = np.unique(rows, axis=0)
        if len(distinct) < 2:
            return []
        c = distinct[rng.choice(len(distinct), min(BRANCH, len(distinct)), replace=False)]
        for _ in range(12):
            to = _distances(rows, c).argmin(1)
            c = np.stack([rows[to == k].mean(0) if (to == k).any() else c[k] for k in range(len(c))])
        to = _distances(rows, c).argmin(1)
        return [rows[to == k] for k in range(len(c)) if (to == k).any()]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row: down the nearest centres."""
        out = np.empty(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            to = _distances(x[rows], self.stacked[node]).argmin(1)
            todo += [(c, rows[to == k]) for k, c in enumerate(self.children[node]) if (to == k).any()]
        return out

    def best_bins(self, q: np.ndarray, visits: int, sizes: list[int] | None = None, least: int = 0) -> list[int]:
        """``walk`` for one query vector in the tree's own coordinates."""
        return self.walk(_distances(q[None], self.all)[0], visits, sizes, least)

    def walk(self, distance: np.ndarray, visits: int, sizes: list[int] | None = None, least: int = 0) -> list[int]:
        """The leaves that best-bin-first reaches, in order: ``visits``, and more until by ``sizes`` they hold ``least`` rows.
        ``distance``: of the query to every node's centre, as ``distances`` gives it."""
        d = distance.tolist()
        heap, out, held = [(0.0, 0)], [], 0
        while heap and (len(out) < visits or held < least):
            _, node = heapq.heappop(heap)
            if self.children[node]:
                for c in self.children[node]:
                    heapq.heappush(heap, (d[c], c))
            else:
                out.append(self.leaf[node])
                held += sizes[out[-1]] if sizes else 0
        return out

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Of each query (its last coordinate is 0) to every node's centre, up to the query's own square."""
        return _distances(np.hstack([q, np.zeros((len(q), 1))]), self.all)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (c * c).sum(1) - 2 * (x @ c.T)


def augment(x: np.ndarray, largest: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(largest**2 - (x * x).sum(1), 0))[:, None]])


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the pairs of rows, each summed in component order: equal vectors get equal scores."""
    out = np.zeros(len(q))
    for d in range(x.shape[1]):
        out += q[:, d] * x[:, d]
    return out


def calibrate(tree: Tree, x: np.ndarray, leaves: np.ndarray, largest: float, k: int, target: float) -> int:
    """Fewest visits whose leaves hold ``target`` of the true neighbours of sample queries."""
    n = min(CALIBRATION, len(x))
    at = np.linspace(0, len(x) - 1, n).astype(int)
    far = tree.distances(x[at]) if n else None
    need = []
    for row, i in enumerate(at):
        s = x @ x[i]
        s[i] = -np.inf
        best = np.argsort(-s, kind="stable")[:min(k, len(x) - 1)]
        order = tree.walk(far[row], tree.n_leaves)
        rank = np.empty(tree.n_leaves, np.int64)
        rank[order] = np.arange(len(order))
        need.append(rank[leaves[best]] + 1)
    need = np.sort(np.concatenate(need)) if need else np.empty(0, np.int64)
    return int(need[min(len(need) - 1, int(np.ceil(target * len(need))) - 1)]) if len(need) else tree.n_leaves


def blocks_of(sizes: list[int]) -> tuple[list[int], list[int]]:
    """First block of each leaf, and how many it has: small neighbouring leaves share one."""
    first, parts, block, held = [], [], 0, 0
    for size in sizes:
        if held and held + size > BLOCK:
            block, held = block + 1, 0
        n = max(1, -(-size // BLOCK))
        first.append(block)
        parts.append(n)
        held += size
        if n > 1:
            block, held = block + n, 0
    return first, parts


def best_of(own: np.ndarray, q: np.ndarray, visited: np.ndarray, ids: np.ndarray, y: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best visited rows of a block for each query, nearest first; ``ids`` ascend.

    A matrix product finds all that can be among the best; those are then scored component by component, so that equal
    vectors get equal scores."""
    rough = q @ y.T
    rough[~visited | (own[:, None] == ids[None, :])] = -np.inf
    slack = 1e-12 * q.shape[1] * np.sqrt((y * y).sum(1)).max() * np.sqrt((q * q).sum(1))
    kept = len(ids) - k
    least = np.partition(rough, kept, axis=1)[:, kept] if kept > 0 else np.full(len(q), -np.inf)
    r, c = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
    s = inner(q[r], y[c])
    order = np.lexsort((c, -s, r))  # ties to the smaller id
    r, c, s = r[order], c[order], s[order]
    new = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1]))) if len(r) else np.empty(0, np.int64)
    ends = np.append(new[1:], len(r))
    to = np.minimum(ends, new + k)
    return pd.DataFrame({"query_id": own[r[new]], "ids": [ids[c[a:b]] for a, b in zip(new, to)], "scores": [s[a:b] for a, b in zip(new, to)]})


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists("v", lambda x: x != 0))
    most = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return v.filter(F.size("v") == (most["d"] if most else 0))


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            target: float = TARGET_RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``is_query(vec_id)`` holds."""
    v = usable(vectors, id_col, vec_col)
    stats = v.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    n, largest = stats[0], float(stats[1] or 0.0) ** 0.5
    sample = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(MAX_SAMPLE).select("v").toPandas()
    x = np.stack(sample["v"]) if len(sample) else np.zeros((0, 1))
    tree = Tree(augment(x, largest), max(LEAST_LEAF, LEAF * len(x) // max(n, 1)))
    visits = calibrate(tree, x, tree.assign(augment(x, largest)), largest, k, target)

    def place(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(leaf=tree.assign(augment(np.stack(pdf["v"]), largest)).astype(np.int32))

    placed = shared_table(v.mapInPandas(place, "vec_id long, v array<double>, leaf int"), "leaves")
    counts = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # one row for each leaf
    sizes = [counts.get(leaf, 0) for leaf in range(tree.n_leaves)]
    first, parts = blocks_of(sizes)
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("leaf") + 1)
    held = placed.withColumn("block", (pick(first) + F.pmod(F.xxhash64("vec_id"), pick(parts))).cast("int"))
    leaf_lo = {}  # of each block: its first leaf, and how many
    for leaf in range(tree.n_leaves):
        for b in range(first[leaf], first[leaf] + parts[leaf]):
            lo, n_leaves = leaf_lo.get(b, (leaf, 0))
            leaf_lo[b] = lo, n_leaves + 1

    def walk(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            ids, q = pdf["vec_id"].to_numpy(np.int64), np.stack(pdf["v"])
            visited = np.zeros((len(ids), tree.n_leaves), bool)
            for r, (d, own) in enumerate(zip(tree.distances(q), pdf["own"])):  # ``own``: rows of the id, in whatever leaves
                visited[r, tree.walk(d, visits, sizes, k + own)] = True
            rows = []
            for b, (lo, n_leaves) in leaf_lo.items():
                here = visited[:, lo:lo + n_leaves]
                at = np.flatnonzero(here.any(axis=1))
                if len(at):
                    rows.append((b, ids[at].tobytes(), q[at].tobytes(), np.packbits(here[at]).tobytes()))
            yield pd.DataFrame(rows, columns=["block", "ids", "q", "visited"]).astype({"block": "int32"})

    asked = placed.filter(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("own")).mapInPandas(
        walk, "block int, ids binary, q binary, visited binary")

    def score(key, left, right):
        out = [pd.DataFrame({"query_id": np.empty(0, np.int64), "ids": np.empty(0, object), "scores": np.empty(0, object)})]
        if len(left) and len(right):
            right = right.sort_values("vec_id")
            ids, y = right["vec_id"].to_numpy(np.int64), np.stack(right["v"])
            lo, n_leaves = leaf_lo[key[0]]
            leaf = right["leaf"].to_numpy() - lo
            for own, q, visited in zip(left["ids"], left["q"], left["visited"]):
                own, q = np.frombuffer(own, np.int64), np.frombuffer(q, np.float64).reshape(-1, y.shape[1])
                visited = np.unpackbits(np.frombuffer(visited, np.uint8), count=len(own) * n_leaves).reshape(len(own), n_leaves).astype(bool)
                step = max(1, SCORES // len(ids))
                for a in range(0, len(own), step):
                    out.append(best_of(own[a:a + step], q[a:a + step], visited[a:a + step][:, leaf], ids, y, k))
        return pd.concat(out)

    found = asked.groupBy("block").cogroup(held.groupBy("block")).applyInPandas(score, "query_id long, ids array<long>, scores array<double>")
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list(
        F.transform(F.arrays_zip("ids", "scores"), lambda p: F.struct((-p["scores"]).alias("s"), p["ids"].alias("i")))))), 1, k).alias("b"))
    return best.select("query_id", F.posexplode("b").alias("rank", "p")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("p.i").alias("vec_id"), (-F.col("p.s")).alias("score"))


def op6_ann(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 20 == 0, k=20)
