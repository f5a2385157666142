"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

The restaurant of a context (the word before) seats the words that follow it; all of them share one parent, the
restaurant without context, whose customers are their tables and whose own parent is uniform over the distinct
training tokens and one more for all unknown ones.  Nothing of the corpus is left out: every pair is a dish.

1. *vocabulary*: exact counts of the training tokens, in parts by hash;
2. *pairs*: tiles of documents list their distinct pairs once, in parts by context.  A context that is very
   frequent is sliced by the word that follows (at most ``MAX_HOT`` contexts can be, by the definition of
   frequent), so no part grows with one word.  A part sums the pairs and keeps those with two or more customers; a pair
   with one customer has one table and needs no sampling;
3. *sweeps*: given the parent's probabilities, every part seats its dishes and moves customers by Gibbs steps
   (``seating``); then the tables go up, the parent is seated anew, and its probabilities go down.  Parts work side by side
   with the counts of the last sweep.  Sweeps after ``BURN_IN`` are the samples;
4. *scores*: the parts answer every tile for its own list, and the tile adds up
   log10 of the predictive probability, averaged over the samples, of each of its tokens.

Between the steps stand written tables.  Draws depend on parts and sweeps alone, so a task that is
run again draws the same.  Discounts come from the pairs (and words) seen once and twice in the whole corpus.

Defined cases: a null text is empty and has one token, its end; a null id is no held-out one; repeated rows count as
often as they are there; rows equal in id and text share a tile; an empty training set
leaves one class, the unknown, with probability 1; an empty table gives an empty result; other columns are not
read.  A very long text is a tile of its own and its task's memory grows with it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, crc_mod, discard, parts_for, shared_table
from .seating import tables
from .tiles import by_part, merged, pack, pack_sorted, tiled, unpack, unpack_sorted
from .words import BLANK_SEPARATED, blocks, mix, words

MODULUS, HELD_OUT = 10, 0
SWEEPS, BURN_IN, MOVES = 3, 1, 2
STRENGTH = 1.0
TILE_BYTES, PART_BYTES = 12 << 20, 12 << 20
#: A context is sliced from this many tokens on, and never one with less than 1 / MAX_HOT of all tokens.
SLICE, MAX_HOT = 250_000, 65_536

START, END = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_SLICE_STEP = np.uint64(0x8EBC6AF09C88C6E3)


class Tokens:
    """The tokens of many texts: hash of each, the text it belongs to, and where each text starts."""

    def __init__(self, texts: list[bytes]):
        parts = []
        for i, _, buf, starts in blocks(texts):
            h, s, _ = words(buf, BLANK_SEPARATED)
            parts.append((h, np.diff(np.append(np.searchsorted(s, starts), len(s)))))
        h = np.concatenate([p[0] for p in parts] or [np.empty(0, np.uint64)])
        n = np.concatenate([p[1] for p in parts] or [np.empty(0, np.int64)])  # words of each text
        d = np.repeat(np.arange(len(texts)), n)
        self.word = np.full(len(h) + len(texts), END, np.uint64)
        self.word[np.arange(len(h)) + d] = h
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), n + 1)
        self.starts = np.cumsum(n + 1) - n - 1


class Hot:
    """Frequent contexts and their slices: the context's key says both."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, slice_tokens: int):
        order = np.argsort(keys)
        self.keys = keys[order]
        self.slices = np.maximum(1, -(-counts[order] // slice_tokens)).astype(np.uint64)
        own = np.repeat(np.arange(len(self.keys)), self.slices.astype(np.int64))
        self.first = (np.cumsum(self.slices) - self.slices).astype(np.int64)
        which = (np.arange(len(own)) - self.first[own]).astype(np.uint64)
        self.slice_keys, self.slice_owner = mix(self.keys[own] + (which + np.uint64(1)) * _SLICE_STEP), own
        order = np.argsort(self.slice_keys)
        self.sliced, self.owner = self.slice_keys[order], own[order]

    def contexts(self, names: np.ndarray, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts that occur, sorted by key; the word that each stands for; and each token's context.

        ``before``: place of the word before each token in ``names``; ``word``: the token's hash."""
        at = self.find(self.keys, names)
        code = before
        hot = np.flatnonzero(at[before] >= 0) if len(self.keys) and len(before) else []
        if len(hot):
            of = at[before[hot]]
            code = before.astype(np.int64)
            code[hot] = len(names) + self.first[of] + (mix(word[hot] ^ START) % self.slices[of]).astype(np.int64)
        keys, stands = np.concatenate((mix(names), self.slice_keys)), np.concatenate((names, self.keys[self.slice_owner]))
        used = np.flatnonzero(np.bincount(code, minlength=len(keys)))
        used = used[np.argsort(keys[used])]
        rank = np.empty(len(keys), np.int64)
        rank[used] = np.arange(len(used))
        return keys[used], stands[used], rank[code]

    def owners(self, context: np.ndarray) -> np.ndarray:
        """Which frequent context a key is a slice of (-1: none)."""
        at = self.find(self.sliced, context)
        return np.where(at >= 0, self.owner[at], -1) if len(self.sliced) else at

    @staticmethod
    def find(sorted_keys: np.ndarray, of: np.ndarray) -> np.ndarray:
        if not len(sorted_keys):
            return np.full(len(of), -1, np.int64)
        at = np.minimum(np.searchsorted(sorted_keys, of), len(sorted_keys) - 1)
        return np.where(sorted_keys[at] == of, at, -1)


class TileList:
    """Distinct words and contexts of a tile, sorted by key, and each token's pair as a number: pairs in order of
    these numbers are sorted by context and word."""

    def __init__(self, pdf: pd.DataFrame, hot: Hot):
        t = Tokens([x.encode() for x in pdf["text"]])
        self.learn, self.text = pdf["learn"].to_numpy(bool), t.text
        at, found = pd.factorize(t.word)
        order = np.argsort(found)
        rank = np.empty(len(found), np.int32)
        rank[order] = np.arange(len(found), dtype=np.int32)
        self.words, self.word_of = found[order], rank[at]
        del at
        names = np.append(self.words, START)
        before = np.concatenate((self.word_of[:1], self.word_of[:-1]))
        before[t.starts] = len(self.words)
        self.contexts, self.before, context_of = hot.contexts(names, before, t.word)
        self.code = context_of * len(self.words)
        self.code += self.word_of

    def parts_of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context and word of pairs."""
        return np.divmod(code, max(len(self.words), 1))

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs and how often each is learned from."""
        s = self.code * 2
        s += self.learn[self.text]
        s.sort()
        pair = s >> 1
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1]))) if len(s) else np.empty(0, np.int64)
        return pair[first], np.add.reduceat(s & 1, first) if len(first) else first


# -- vocabulary ----------------------------------------------------------------------------------

def _count_words(parts: int):
    def run(batches):
        for pdf in batches:
            t = Tokens([x.encode() for x in pdf["text"][pdf["learn"]]])
            keys, counts = np.unique(t.word, return_counts=True)
            rows = [(p, pack_sorted(keys[at]), pack(counts[at])) for p, at in by_part(keys, parts)]
            yield pd.DataFrame(rows, columns=["part", "keys", "counts"])
    return run


def _merge_words(pdf: pd.DataFrame) -> pd.DataFrame:
    keys, counts, _ = merged([unpack_sorted(b) for b in pdf["keys"]], [unpack(b, np.int64) for b in pdf["counts"]])
    return pd.DataFrame({"part": [pdf["part"].iloc[0]], "keys": [pack_sorted(keys)], "counts": [pack(counts)],
                         "tokens": [int(counts.sum())], "distinct": [len(keys)]})


def _frequent(least: int):
    def run(batches):
        for pdf in batches:
            for k, c in zip(pdf["keys"], pdf["counts"]):
                keys, counts = unpack_sorted(k), unpack(c, np.int64)
                on = counts >= least
                yield pd.DataFrame({"key": keys[on].view(np.int64), "n": counts[on]})
    return run


# -- pairs -----------------------------------------------------------------------------------------

PAIR_ROW = "part int, tile int, contexts binary, sizes binary, words binary, counts binary"
#: Kinds of rows of the merged table: the dishes of a part, where a tile's list lies in them, customers for the parent.
DISHES, PLACES, CUSTOMERS = 0, 1, 2
MERGED_ROW = "kind int, part int, tile int, a binary, b binary, c binary, d binary, e binary, once long, twice long"


def _list_pairs(hot: Hot, parts: int):
    def run(key, pdf):
        t = TileList(pdf, hot)
        code, counts = t.counted()
        (context, word), rows = t.parts_of(code), []
        for p, at in by_part(t.contexts, parts):
            mine = slice(*np.searchsorted(context, [at.start, at.stop]))
            sizes = np.bincount(context[mine] - at.start, minlength=at.stop - at.start)
            rows.append((p, key[0], pack_sorted(t.contexts[at]), pack(sizes.astype(np.uint32)),
                         pack_sorted(t.words[word[mine]]), pack(counts[mine].astype(np.uint32))))
        return pd.DataFrame(rows, columns=_names(PAIR_ROW))
    return run


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _merge_pairs(word_parts: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tile")
        part = int(pdf["part"].iloc[0])
        lists = [unpack_sorted(b) for b in pdf["contexts"]]
        contexts, _, context_at = merged(lists, [np.zeros(len(k), np.int64) for k in lists])
        sizes = [unpack(b, np.uint32).astype(np.int64) for b in pdf["sizes"]]
        context = np.repeat(context_at, np.concatenate(sizes))
        word = np.concatenate([unpack_sorted(b) for b in pdf["words"]])
        count = np.concatenate([unpack(b, np.uint32) for b in pdf["counts"]]).astype(np.int64)
        order = np.lexsort((word, context))
        c, w = context[order], word[order]
        cut = np.concatenate(([True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])))
        first = np.flatnonzero(cut)
        pair_at = np.empty(len(word), np.int64)
        pair_at[order] = np.cumsum(cut) - 1
        c, w, n = c[first], w[first], np.add.reduceat(count[order], first)
        once, several = n == 1, n > 1
        alone = np.bincount(c[once], minlength=len(contexts))
        rows = [(DISHES, part, -1, pack_sorted(contexts), pack(alone.astype(np.uint32)), pack(c[several].astype(np.uint32)),
                 pack_sorted(w[several]), pack(n[several]), int(once.sum()), int((n == 2).sum()))]
        # a pair of a tile: unseen in training, seen once, or the dish of that number
        code = np.where(several, 1 + np.cumsum(several), once.astype(np.int64))
        pairs_to, contexts_to = np.cumsum([k.sum() for k in sizes]), np.cumsum([len(k) for k in lists])
        for k, tile in enumerate(pdf["tile"]):
            mine = code[pair_at[pairs_to[k] - sizes[k].sum():pairs_to[k]]]
            held = context_at[contexts_to[k] - len(lists[k]):contexts_to[k]]
            rows.append((PLACES, part, int(tile), pack_sorted(held.astype(np.uint64)), pack(np.minimum(mine, 2).astype(np.uint8)),
                         pack_sorted((mine[mine > 1] - 2).astype(np.uint64)), None, None, 0, 0))
        keys, customers = np.unique(w[once], return_counts=True)
        rows += [(CUSTOMERS, p, -1, pack_sorted(keys[at]), pack(customers[at]), None, None, None, 0, 0) for p, at in by_part(keys, word_parts)]
        return pd.DataFrame(rows, columns=_names(MERGED_ROW))
    return run


class Dishes:
    """The contexts of a part and their pairs with several customers."""

    def __init__(self, row, hot: Hot):
        self.contexts = unpack_sorted(row["a"])
        self.alone = unpack(row["b"], np.uint32).astype(np.int64)  # pairs seen once, of each context
        self.context = unpack(row["c"], np.uint32).astype(np.int64)
        self.word = unpack_sorted(row["d"])
        self.customers = unpack(row["e"], np.int64)
        self.owner = hot.owners(self.contexts)

    def tables_of(self, t: np.ndarray, sliced: np.ndarray | None) -> np.ndarray:
        """Tables of every context; ``sliced``: of the frequent ones over all their slices."""
        own = self.alone + np.bincount(self.context, weights=t, minlength=len(self.contexts)).astype(np.int64)
        return own if sliced is None or not len(sliced) else np.where(self.owner >= 0, sliced[self.owner], own)


# -- sweeps -----------------------------------------------------------------------------------------

#: Kinds: tables of the dishes of a part, tables that go up to a part of the parent.
SEATED, UP = 0, 1
SEATED_ROW = "kind int, part int, child int, a binary, b binary, hot array<int>, hot_tables array<long>"
#: Kinds: the parent's dishes, what a part asked for.
PARENT, DOWN = 0, 1
PARENT_ROW = "kind int, part int, parent int, a binary, b binary, customers long, tables long, once long, twice long"


def _seated_rows(part: int, dishes: Dishes, t: np.ndarray, word_parts: int) -> pd.DataFrame:
    of = dishes.tables_of(t, None)
    hot = np.flatnonzero(dishes.owner >= 0)
    rows = [(SEATED, part, -1, pack(t), None, dishes.owner[hot].tolist(), of[hot].tolist())]
    keys, at = np.unique(dishes.word, return_inverse=True)
    up = np.bincount(at, weights=t, minlength=len(keys)).astype(np.int64)
    rows += [(UP, p, part, pack_sorted(keys[k]), pack(up[k]), None, None) for p, k in by_part(keys, word_parts)]
    return pd.DataFrame(rows, columns=_names(SEATED_ROW))


def _one_table_each(hot: Hot, word_parts: int):
    def run(batches):
        for pdf in batches:
            for _, row in pdf.iterrows():
                dishes = Dishes(row, hot)
                yield _seated_rows(int(row["part"]), dishes, np.ones(len(dishes.word), np.int64), word_parts)
    return run


class Level:
    """Totals of the parent after a sweep: what turns ``customers - discount * tables`` into a probability."""

    def __init__(self, customers: int, held: int, discount: float, classes: int, strength: float):
        self.customers, self.tables, self.discount, self.classes, self.strength = customers, held, discount, classes, strength

    def probability(self, own: np.ndarray) -> np.ndarray:
        return (own + (self.strength + self.discount * self.tables) / self.classes) / (self.strength + self.customers)


def _seat_parent(sweep: int, before: Level, moves: int):
    def run(key, asked: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        asked = asked.sort_values("child")
        lists = [unpack_sorted(b) for b in asked["a"]]
        keys, c, place = merged(lists + [unpack_sorted(b) for b in base["a"]],
                                [unpack(b, np.int64) for b in asked["b"]] + [unpack(b, np.int64) for b in base["b"]])
        rng = np.random.default_rng([sweep, 1, key[0]])
        d, p = before.discount, np.full(len(keys), 1.0 / before.classes)
        t = tables(c, (before.strength + d * max(before.tables - 1, 0)) * p, d * p, d, moves, rng)
        own = c - d * t
        rows = [(PARENT, key[0], -1, pack_sorted(keys), pack(own), int(c.sum()), int(t.sum()), int((c == 1).sum()), int((c == 2).sum()))]
        cuts = np.cumsum([len(k) for k in lists])
        rows += [(DOWN, int(child), key[0], None, pack(own[place[e - len(k):e]]), 0, 0, 0, 0) for child, k, e in zip(asked["child"], lists, cuts)]
        return pd.DataFrame(rows, columns=_names(PARENT_ROW))
    return run


def _seat_dishes(sweep: int, parent: Level, strength: float, d: float, hot: Hot, sliced: np.ndarray, moves: int, word_parts: int):
    def run(key, mine: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        dishes = Dishes(mine.iloc[0], hot)
        t = unpack(given.loc[given["kind"] == SEATED, "t"].iloc[0], np.int64)
        own = [unpack(b, np.float64) for b in given[given["kind"] != SEATED].sort_values("parent")["own"]]
        p = parent.probability(np.concatenate(own or [np.empty(0)]))[np.unique(dishes.word, return_inverse=True)[1]]
        others = dishes.tables_of(t, sliced)[dishes.context] - t
        t = tables(dishes.customers, (strength + d * others) * p, d * p, d, moves, np.random.default_rng([sweep, 2, key[0]]))
        return _seated_rows(key[0], dishes, t, word_parts)
    return run


def discount(once: int, twice: int) -> float:
    """From the dishes with one and two customers."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


class Model:
    """What training leaves: written tables and a few totals."""

    def __init__(self, **kw):
        self.__dict__.update(kw)


def train(rows: DataFrame, text_bytes: int, strength: float = STRENGTH, sweeps: int = SWEEPS, burn_in: int = BURN_IN,
          moves: int = MOVES, part_bytes: int = PART_BYTES, slice_tokens: int = SLICE) -> Model:
    """``rows``: (tile, id, text, learn).  Pairs of rows that are not learned from get a place, but no count."""
    parts, word_parts = parts_for(text_bytes, part_bytes, 4), parts_for(text_bytes, 2 * part_bytes, 4)
    counted = rows.select("text", "learn").mapInPandas(_count_words(word_parts), "part int, keys binary, counts binary")
    vocabulary = shared_table(counted.groupBy("part").applyInPandas(
        _merge_words, "part int, keys binary, counts binary, tokens long, distinct long"), "lm-vocabulary")
    total = vocabulary.agg(F.sum("tokens"), F.sum("distinct")).first()
    n, v = int(total[0] or 0), int(total[1] or 0)
    least = max(slice_tokens, -(-n // MAX_HOT))
    frequent = vocabulary.mapInPandas(_frequent(least), "key long, n long").toPandas()  # at most MAX_HOT rows
    # a text's start is a context as often as a text ends
    end = frequent["key"].to_numpy(np.int64).view(np.uint64) == END
    keys = np.where(end, START, frequent["key"].to_numpy(np.int64).view(np.uint64))
    hot = Hot(keys, frequent["n"].to_numpy(np.int64), least)

    texts = rows.select("tile", "text", "learn")
    pairs = texts.groupBy("tile").applyInPandas(_list_pairs(hot, parts), PAIR_ROW)
    merged_pairs = shared_table(pairs.groupBy("part").applyInPandas(_merge_pairs(word_parts), MERGED_ROW), "lm-pairs")
    seen = merged_pairs.agg(F.sum("once"), F.sum("twice")).first()
    d = discount(int(seen[0] or 0), int(seen[1] or 0))
    dishes = merged_pairs.filter(F.col("kind") == DISHES)
    base = shared_table(merged_pairs.filter(F.col("kind") == CUSTOMERS).select("part", F.col("a").alias("keys"), F.col("b").alias("counts"))
                        .groupBy("part").applyInPandas(_merge_words, "part int, keys binary, counts binary, tokens long, distinct long")
                        .select("part", F.col("keys").alias("a"), F.col("counts").alias("b")), "lm-base")
    seated = shared_table(dishes.mapInPandas(_one_table_each(hot, word_parts), SEATED_ROW), "lm-seated")
    level, samples = Level(0, v, 0.75, v + 1, strength), []
    for sweep in range(sweeps + 1):
        up = seated.filter(F.col("kind") == UP).select("part", "child", "a", "b")
        parent = shared_table(up.groupBy("part").cogroup(base.groupBy("part")).applyInPandas(
            _seat_parent(sweep, level, moves), PARENT_ROW), "lm-parent")
        sums = parent.agg(*[F.sum(c) for c in ("customers", "tables", "once", "twice")]).first()
        sums = [int(x or 0) for x in sums]
        level = Level(sums[0], sums[1], level.discount, v + 1, strength)
        sliced = np.zeros(len(hot.keys), np.int64)  # one number for each frequent context
        held = seated.filter(F.col("kind") == SEATED).select(F.explode(F.arrays_zip("hot", "hot_tables")).alias("h"))
        for r in held.groupBy("h.hot").agg(F.sum("h.hot_tables").alias("t")).collect():
            sliced[r["hot"]] = r["t"]
        if sweep > burn_in or sweep == sweeps:
            samples.append((seated, parent, level, sliced))
        if sweep == sweeps:
            break
        down = parent.filter(F.col("kind") == DOWN).select("part", F.lit(UP).alias("kind"), "parent", F.col("b").alias("own"), F.lit(None).cast("binary").alias("t"))
        now = seated.filter(F.col("kind") == SEATED).select("part", "kind", F.lit(-1).alias("parent"), F.lit(None).cast("binary").alias("own"), F.col("a").alias("t"))
        old = seated
        seated = shared_table(dishes.groupBy("part").cogroup(down.unionByName(now).groupBy("part")).applyInPandas(
            _seat_dishes(sweep, level, strength, d, hot, sliced, moves, word_parts), SEATED_ROW), "lm-seated")
        if sweep <= burn_in:  # written in full above, and no sample
            discard(old)
            discard(parent)
        if sweep == 0:
            level.discount = discount(sums[2], sums[3])
    discard(base)
    return Model(vocabulary=vocabulary, pairs=merged_pairs, samples=samples, hot=hot, tokens=n, distinct=v, strength=strength, discount=d, word_parts=word_parts)


# -- scores -----------------------------------------------------------------------------------------

ANSWER_ROW = "kind int, tile int, part int, a binary, b binary, c binary"
WORDS, PAIRS = 0, 1


def _ask_words(hot: Hot, parts: int):
    def run(key, pdf):
        keys = np.unique(Tokens([x.encode() for x in pdf["text"]]).word)
        return pd.DataFrame([(p, key[0], pack_sorted(keys[at])) for p, at in by_part(keys, parts)], columns=["part", "tile", "keys"])
    return run


def _take(keys: np.ndarray, values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The values of the keys ``of`` (0 for those not there)."""
    at = Hot.find(keys, of)
    return np.where(at >= 0, values[at], 0) if len(keys) else np.zeros(len(of), values.dtype)


def _answer_words(samples: int):
    def run(key, asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        held = {}
        for k, a, b in zip(known["sample"], known["a"], known["b"]):
            held[int(k)] = unpack_sorted(a), unpack(b, np.int64 if k < 0 else np.float64)
        rows = []
        for tile, b in zip(asked["tile"], asked["keys"]):
            of = unpack_sorted(b)
            none = np.empty(0, np.uint64), np.empty(0)
            own = [_take(*held.get(k, none), of).astype(np.float32) for k in range(samples)]
            counts = _take(*held[-1], of) if -1 in held else np.zeros(len(of), np.int64)
            rows.append((WORDS, int(tile), key[0], pack(counts), pack(np.concatenate(own)), None))
        return pd.DataFrame(rows, columns=_names(ANSWER_ROW))
    return run


def _answer_pairs(hot: Hot, d: float, sliced: list[np.ndarray]):
    def run(key, places: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("sample")
        dishes = Dishes(known.iloc[0], hot)
        ts = [unpack(b, np.int64) for b in known["a"].iloc[1:]]
        held = [dishes.tables_of(t, s) for t, s in zip(ts, sliced)]
        left = np.mean([dishes.customers - d * t for t in ts], axis=0).astype(np.float32)
        rows = []
        for tile, a, b, c in zip(places["tile"], places["a"], places["b"], places["c"]):
            at = unpack_sorted(a).astype(np.int64)
            rows.append((PAIRS, int(tile), key[0], pack(np.concatenate([h[at] for h in held])), b, pack(left[unpack_sorted(c).astype(np.int64)])))
        return pd.DataFrame(rows, columns=_names(ANSWER_ROW))
    return run


def _score(hot: Hot, d: float, strength: float, levels: list[Level], n: int, v: int):
    def run(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        t = TileList(texts, hot)
        of, size = t.text, len(texts)
        sums = lambda x: np.bincount(of, weights=x, minlength=size)
        answers = answers.sort_values("part")
        by_kind = {k: answers[answers["kind"] == k] for k in (WORDS, PAIRS)}
        split = lambda blobs, dtype: np.concatenate([unpack(b, dtype).reshape(len(levels), -1) for b in blobs], axis=1)
        counts = np.concatenate([unpack(b, np.int64) for b in by_kind[WORDS]["a"]])
        base = np.log10((counts + 0.1) / (n + 0.1 * (v + 1)))
        out = {"id": texts["id"].to_numpy(), "learn": t.learn, "n_tokens": np.bincount(of, minlength=size),
               "n_known": sums(counts[t.word_of] > 0).astype(np.int64), "base_score": sums(base[t.word_of])}
        t.word_of = None
        # customers of a context: as often as its word (a start: as a text's end) was learned
        customers = _take(t.words, counts, np.where(t.before == START, END, t.before))
        code_of, pair_of = np.unique(t.code, return_inverse=True)
        t.code = None
        c, w = (x.astype(np.int32) for x in t.parts_of(code_of))
        code = np.concatenate([unpack(b, np.uint8) for b in by_kind[PAIRS]["b"]])
        p = np.where(code == 1, 1 - d, 0.0)
        p[code == 2] = np.concatenate([unpack(b, np.float32) for b in by_kind[PAIRS]["c"]])
        own, held = split(by_kind[WORDS]["b"], np.float32), split(by_kind[PAIRS]["a"], np.int64)
        for k, level in enumerate(levels):
            p += (strength + d * held[k])[c] * level.probability(own[k].astype(np.float64))[w] / len(levels)
        p /= (strength + customers)[c]
        out["score"] = sums(np.log10(p)[pair_of])
        return pd.DataFrame(out)
    return run


def score(model: Model, rows: DataFrame) -> DataFrame:
    """``id, learn, n_tokens, n_known, base_score, score`` of the rows that ``train`` was given."""
    m = model
    texts = rows.select("tile", "id", "text", "learn")
    none = F.lit(None).cast("binary")
    known = m.vocabulary.select("part", F.lit(-1).alias("sample"), F.col("keys").alias("a"), F.col("counts").alias("b"))
    dishes = m.pairs.filter(F.col("kind") == DISHES).select("part", F.lit(-1).alias("sample"), "a", "b", "c", "d", "e")
    for k, (seated, parent, _, _) in enumerate(m.samples):
        known = known.unionByName(parent.filter(F.col("kind") == PARENT).select("part", F.lit(k).alias("sample"), "a", "b"))
        dishes = dishes.unionByName(seated.filter(F.col("kind") == SEATED).select(
            "part", F.lit(k).alias("sample"), "a", *[none.alias(c) for c in "bcde"]))
    levels, sliced = [s[2] for s in m.samples], [s[3] for s in m.samples]
    asked = texts.groupBy("tile").applyInPandas(_ask_words(m.hot, m.word_parts), "part int, tile int, keys binary")
    words_in = asked.groupBy("part").cogroup(known.groupBy("part")).applyInPandas(_answer_words(len(levels)), ANSWER_ROW)
    places = m.pairs.filter(F.col("kind") == PLACES).select("part", "tile", "a", "b", "c")
    pairs_in = places.groupBy("part").cogroup(dishes.groupBy("part")).applyInPandas(_answer_pairs(m.hot, m.discount, sliced), ANSWER_ROW)
    return texts.groupBy("tile").cogroup(words_in.unionByName(pairs_in).groupBy("tile")).applyInPandas(
        _score(m.hot, m.discount, m.strength, levels, m.tokens, m.distinct),
        "id string, learn boolean, n_tokens long, n_known long, base_score double, score double")


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_bytes: int = TILE_BYTES, **settings) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row; held-out rows are not learned from."""
    bound_batches(docs.sparkSession)
    learn = F.coalesce(crc_mod(id_col, MODULUS) != HELD_OUT, F.lit(True))
    rows, _, total = tiled(docs, id_col, text_col, tile_bytes, learn=learn)
    model = train(rows, total, **settings)
    return score(model, rows).select(
        F.col("id").cast(docs.schema[id_col].dataType).alias("doc_id"), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op11_lm(spark, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
