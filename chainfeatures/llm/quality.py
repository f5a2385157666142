"""Quality classifier: Bradley-Terry pairwise ranking.

Each document gets a vector of surface features of its whole text.  A document labelled
good is preferred to one labelled bad; the model learns weights ``w`` so that
``sigmoid(w . (x_good - x_bad))`` is the probability of that preference, by logistic loss on
the feature differences of all pairs of a good and a bad training document.  ``w . x``
ranks all documents, and the cut is the quantile of the training scores at the share of bad
labels; the reported score is a logistic function of the distance to that cut, 0.3 at the cut.

Features, means, weights and cut come from every labelled document that is not held out.
The loss of all pairs needs no list of pairs: how much a document adds depends on its own
score and on the scores of the other label, so a pass over the documents spreads each label's scores
over Chebyshev nodes (see ``basis``), and a second one sums what every document adds at its
score.  Both are sums over rows, made by Spark; the driver gets them by pieces of the score axis.

Defined cases: a null or empty text is scored by its (empty) features; a null id is not held out
and never learned from; without labels of both kinds every score is 0.5; repeated rows
get equal scores, and of rows that repeat an id the one with the smallest features is learned from; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, discard, shared_table
from .learn import labelled_ids, sigmoid
from .words import BLANK_SEPARATED, blocks, windows, words

MODULUS, HELD_OUT, THRESHOLD = 5, 0, 0.3
#: Penalty of the mean loss of a pair, times the square root of the number of documents.
PENALTY = 0.001 / 12 ** 0.5
STEPS, TOLERANCE = 100, 1e-6
#: Width of a piece of the score axis, and Chebyshev nodes in it: the sigmoid is met to about 1e-15.
WIDTH, NODES = 0.5, 12
#: Pieces further apart than this have a sigmoid of 0 or 1 in double precision.
NEAR = 80
#: Parts that a pass for the cut divides the range of scores into.
CUT_PARTS = 1024

_BYTE_GROUPS = [list(range(97, 123)), list(range(65, 91)), list(range(48, 58)), [32], [10, 13], [9, 11, 12], list(range(128, 256)), [46, 44], [33, 63],
                [34, 39], [40, 41, 91, 93, 123, 125], [60, 62], [124], [45, 95], [42], [35], [37], [38], [36], [64], [43, 61, 126, 94, 96], [47, 92], [58, 59],
                [*range(0, 9), *range(14, 32), 127]]
_GROUP = np.zeros(256, np.int64)
for _g, _members in enumerate(_BYTE_GROUPS):
    _GROUP[_members] = _g


def _share(x, n):
    """Log-shares: a tenth, a hundredth and a thousandth are as far apart as they look."""
    return np.log(x / max(n, 1) + 1e-3)


def features(texts: list[bytes]) -> np.ndarray:
    out = []
    for i, j, buf, starts in blocks(texts):
        h, s, e = words(buf, BLANK_SEPARATED)
        first = np.searchsorted(s, starts)
        last = np.append(first[1:], len(s))
        a = np.frombuffer(buf, np.uint8)
        for d in range(j - i):
            text = texts[i + d]
            n = len(text)
            groups = np.bincount(_GROUP, np.bincount(a[starts[d]:starts[d] + n], minlength=256), minlength=len(_BYTE_GROUPS))
            hw, lens = h[first[d]:last[d]], (e - s)[first[d]:last[d]]
            k = len(hw)
            _, times = np.unique(hw, return_counts=True)
            w3 = windows(hw, 3)
            lines = [x for x in text.split(b"\n") if x.strip()]
            tail = a[e[first[d]:last[d]] - 1]  # what words end with
            odd = (tail < 48) & ~np.isin(tail, (33, 39, 41, 44, 46)) | np.isin(tail, (61, 64, 94, 95, 96, 124, 126))
            upper = (a[s[first[d]:last[d]]] >= 65) & (a[s[first[d]:last[d]]] <= 90)
            out.append([
                *(_share(g, n) for g in groups),
                np.log1p(n), np.log1p(k), np.log1p(len(lines)),
                lens.mean() if k else 0.0, lens.std() if k else 0.0, np.log1p(lens.max()) if k else 0.0,
                len(times) / max(k, 1), times.max() / k if k else 0.0,
                1 - len(np.unique(w3)) / len(w3) if len(w3) else 0.0,
                1 - len(set(lines)) / len(lines) if lines else 0.0,
                np.log1p(n / max(len(lines), 1)),
                odd.mean() if k else 0.0, upper.mean() if k else 0.0, (lens == 1).mean() if k else 0.0,
            ])
    return np.array(out, float).reshape(len(texts), -1)


class Model:
    def __init__(self, mean, scale, weights, cut):
        self.mean, self.scale, self.weights, self.cut = mean, scale, weights, cut

    def rank(self, x: np.ndarray) -> np.ndarray:
        """``w . x`` of each row, whatever rows are beside it."""
        return ((x - self.mean) / self.scale * self.weights).sum(1)

    def score_features(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return sigmoid(self.rank(x) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        return self.score_features(features(texts)) if texts else np.empty(0)


_POINTS = np.polynomial.chebyshev.chebpts1(NODES)
_TO_NODES = np.linalg.inv(np.polynomial.chebyshev.chebvander(_POINTS, NODES - 1))

#: Sums by (what, key): ``what`` names the sum, ``key`` is a label, or ``2 * piece + label``.
Sums = dict[tuple[str, int], np.ndarray]
#: Adds up a function of (features, labels) over all rows.
Run = Callable[[Callable[[np.ndarray, np.ndarray], Sums]], Sums]


def basis(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The piece of each score, and its weights at the nodes of the piece: a smooth function of the score
    is the sum of its values at the nodes by these weights."""
    piece = np.floor(s / WIDTH)
    return piece.astype(np.int64), np.polynomial.chebyshev.chebvander(2 * (s / WIDTH - piece) - 1, NODES - 1) @ _TO_NODES


def _by_key(what: str, key: np.ndarray, v: np.ndarray) -> Sums:
    order = np.argsort(key, kind="stable")
    keys, first = np.unique(key[order], return_index=True)
    return {(what, int(k)): x for k, x in zip(keys, np.add.reduceat(v[order], first))}


class _Side:
    """Scores of one label, spread over the nodes of the pieces that hold any."""

    def __init__(self, sums: Sums, label: int):
        own = sorted((k >> 1, v) for (what, k), v in sums.items() if what == "mass" and k & 1 == label)
        self.piece = np.array([k for k, _ in own])
        self.mass = np.array([v for _, v in own])
        self.node = (self.piece[:, None] + (_POINTS + 1) / 2) * WIDTH
        self.count = self.mass.sum(1)

    def near(self, piece: int) -> slice:
        return slice(*np.searchsorted(self.piece, [piece - NEAR, piece + NEAR + 1]))


def _push(one: _Side, other: _Side, sign: int) -> tuple[np.ndarray, np.ndarray, float]:
    """What all scores of ``other`` do to ``one``: at its nodes the sum of ``sigmoid(sign * (other - node))``, for its pieces
    the sum of the sigmoid's slope (scores as if in the middle), and the loss of all pairs."""
    total, slope, loss = np.empty_like(one.node), np.empty(len(one.piece)), 0.0
    up_mass, up_sum = (np.append(0, np.cumsum(v)) for v in (other.count, (other.mass * other.node).sum(1)))
    for i, piece in enumerate(one.piece.tolist()):
        near, t = other.near(piece), one.node[i]
        # of the pieces that are far off, those on one side add 1 (and their distance), the others nothing
        far, far_sum = (v[-1] - v[near.stop] if sign > 0 else v[near.start] for v in (up_mass, up_sum))
        d = sign * (other.node[near].ravel() - t[:, None])
        mass = other.mass[near].ravel()
        total[i] = sigmoid(d) @ mass + far
        loss += one.mass[i] @ (np.logaddexp(0, d) @ mass + sign * (far_sum - t * far))
        p = sigmoid((other.piece[near] - piece) * WIDTH)
        slope[i] = (p * (1 - p)) @ other.count[near]
    return total, slope, loss


def learn_weights(run: Run) -> tuple[int, Model | None]:
    """(number of bad rows, model without cut) by Newton's method on the mean loss of all pairs; no model without both labels."""
    first = run(lambda x, y: {(what, int(k)): v for k in np.unique(y) for what, v in (("n", np.array([(y == k).sum()], float)), ("x", x[y == k].sum(0)))})
    if not all(("n", k) in first for k in (0, 1)):
        return 0, None
    n0, n1 = (first["n", k][0] for k in (0, 1))
    mean = (first["x", 0] + first["x", 1]) / (n0 + n1)
    var = run(lambda x, y: {("var", 0): ((x - mean) ** 2).sum(0)})["var", 0] / (n0 + n1)
    m = Model(mean, np.maximum(np.sqrt(var), 1e-3), np.zeros(len(mean)), None)
    pairs, l2 = n0 * n1, PENALTY / (n0 + n1) ** 0.5

    def spread(w):
        at = Model(m.mean, m.scale, w, None)

        def part(x, y):
            piece, v = basis(at.rank(x))
            return _by_key("mass", 2 * piece + y, v)

        sums = run(part)
        bad, good = _Side(sums, 0), _Side(sums, 1)
        push = _push(bad, good, -1), _push(good, bad, 1)
        return bad, good, push, push[1][2] / pairs + l2 / 2 * (w @ w)

    def slopes(w, bad, good, push):
        """Gradient and curvature; scores count as the middles of their pieces in the curvature only."""
        at = Model(m.mean, m.scale, w, None)
        key = np.concatenate([2 * bad.piece, 2 * good.piece + 1])
        order = np.argsort(key)
        key, total, slope = key[order], np.concatenate([push[0][0], push[1][0]])[order], np.concatenate([push[0][1], push[1][1]])[order]

        def part(x, y):
            z = (x - at.mean) / at.scale
            piece, v = basis(at.rank(x))
            k = np.searchsorted(key, 2 * piece + y)
            pull = (v * total[k]).sum(1) * np.where(y == 1, -1, 1)
            return {("g", 0): pull @ z, ("h", 0): ((z * slope[k][:, None]).T @ z).ravel(), **_by_key("z", 2 * piece + y, z)}

        sums = run(part)
        h = sums["h", 0].reshape(len(w), -1)
        z0 = np.array([sums["z", 2 * int(k)] for k in bad.piece])
        for k in good.piece.tolist():
            near = bad.near(k)
            p = sigmoid((bad.piece[near] - k) * WIDTH)
            cross = np.outer(sums["z", 2 * k + 1], (p * (1 - p)) @ z0[near])
            h = h - cross - cross.T
        return sums["g", 0] / pairs + l2 * w, h / pairs + l2 * np.eye(len(w))

    w = m.weights
    *at, loss = spread(w)
    for _ in range(STEPS):
        g, h = slopes(w, *at)
        step = np.linalg.solve(h, g)
        while True:
            *to, less = spread(w - step)
            if less <= loss * (1 + 1e-12) or np.abs(step).max() < TOLERANCE:
                break
            step = step / 2
        w, at, loss = w - step, to, less
        if np.abs(step).max() < TOLERANCE:
            break
    m.weights = w
    return int(n0), m


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """All preference pairs of the rows -> Bradley-Terry weights and the quantile cut."""
    bad, m = learn_weights(lambda part: part(x, y))
    if m is None:
        return Model(None, None, None, None)
    m.cut = np.partition(m.rank(x), [bad - 1, bad])[[bad - 1, bad]].mean()
    return m


def _sum_rows(rows: DataFrame) -> Run:
    """Adds up over the rows of a table (x, label)."""
    def run(part):
        def of_task(batches):
            sums: Sums = {}
            for pdf in batches:
                if len(pdf):
                    for k, v in part(np.stack(pdf["x"]), pdf["label"].to_numpy(np.int64)).items():
                        sums[k] = sums[k] + v if k in sums else v
            yield pd.DataFrame({"what": [k for k, _ in sums], "key": [k for _, k in sums], "v": list(sums.values())}).astype({"what": object, "key": "int64", "v": object})

        out = (rows.mapInPandas(of_task, "what string, key long, v array<double>").select("what", "key", F.posexplode("v").alias("at", "v"))
               .groupBy("what", "key", "at").agg(F.sum("v").alias("v"))
               .groupBy("what", "key").agg(F.sort_array(F.collect_list(F.struct("at", "v")))["v"].alias("v")))
        return {(r["what"], r["key"]): np.array(r["v"]) for r in out.collect()}  # bounded by the pieces that scores lie in

    return run


def _at_rank(scores: DataFrame, k: int) -> float:
    """The ``k``-th smallest score (from 0): each pass keeps the part of the range that holds it."""
    lo, hi = scores.agg(F.min("s"), F.max("s")).first()
    while lo < hi:
        part = F.least(F.floor((F.col("s") - lo) / F.lit((hi - lo) / CUT_PARTS)), F.lit(CUT_PARTS - 1))
        found = scores.filter(F.col("s").between(lo, hi)).groupBy(part.alias("part")).agg(F.count("s").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).collect()
        for r in sorted(found):
            if k < r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            k -= r["n"]
    return lo


def fit_table(rows: DataFrame) -> Model:
    """``fit`` of the rows of a table (x, label)."""
    bad, m = learn_weights(_sum_rows(rows))
    if m is None:
        return Model(None, None, None, None)
    scores = shared_table(rows.select(_of_features(m.rank)("x").alias("s")), "train-scores")
    low = _at_rank(scores, bad - 1)
    high = _at_rank(scores, bad)
    discard(scores)
    m.cut = (low + high) / 2
    return m


def _of_features(fn):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for col in batches:
            yield pd.Series(fn(np.stack(col)) if len(col) else [], dtype=float)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double").asNondeterministic()


def feature_column(text):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for col in batches:
            yield pd.Series(list(features([t.encode() if t else b"" for t in col])), dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<double>").asNondeterministic()(text)


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x`` of every row: what learning and scoring read instead of the texts."""
    return shared_table(docs.select(F.col(id_col).alias("doc_id"), feature_column(F.col(text_col).cast("string")).alias("x")), "quality-features")


def train_table(table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Model of all labelled rows of a ``feature_table`` that are not held out."""
    ids = labelled_ids(labels, label_col, MODULUS, HELD_OUT, id_col)
    rows = table.withColumnRenamed("doc_id", "__id").join(ids, "__id").groupBy("__id", "label").agg(F.min("x").alias("x")).select("x", "label")
    rows = shared_table(rows, "train")
    model = fit_table(rows)
    discard(rows)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    return train_table(feature_table(docs, id_col, text_col), labels, id_col, label_col)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    table = feature_table(docs, id_col, text_col)
    model = train_table(table, labels, id_col)
    return table.select("doc_id", F.coalesce(crc_mod("doc_id", MODULUS) == HELD_OUT, F.lit(False)).alias("held_out"),
                        _of_features(model.score_features)("x").alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
