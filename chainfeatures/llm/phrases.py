"""Phrase collocations: n-grams from an FM-index for each shard, counted over all shards.

A shard is the text of one language in one tile of documents.  Its word ids are indexed in both
directions (Burrows-Wheeler transforms of the word sequence and of its reverse, with C and the LF
mapping).  All intervals of one length are extended by all words at a time; the interval in
one direction and its twin in the other are kept in step.

1. every shard extends its words to the left and lists words and two-word phrases with their counts,
   as 64-bit hashes; parts sum them over the shards and answer each shard which of its
   own reach the least count anywhere.  Sums of hashes that fall together are too large, never too
   small, so nothing is lost here;
2. the shards index their text again and extend what is left to the right: a three-word phrase is
   listed where both its two-word parts reach the least count.  These lists carry the words
   themselves, compressed, and other parts sum them over all shards: exactly;
3. cuts, scores, the rule of longer phrases and ranks are DataFrame operations.

The index is sorted to the depth that the extensions need, so its cost does not depend on repeats.

Defined cases: a null or empty text has no words; a null language is ``und``; rows are counted as often as they are
there, with or without an id; phrases with equal score and count are ordered by their bytes; an empty table gives an
empty result; other columns are not read.  A very long text is a tile of its own and its task's memory grows with it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, shared_table
from .tiles import by_part, merged, pack, pack_bytes, pack_sorted, tiled, unpack, unpack_bytes, unpack_sorted
from .words import mix

LEAST = 10
TOP = 2000
#: A shorter phrase goes where a longer candidate has this share (per cent) of its count.
SHARE = 50
#: Bytes of text for each part that sums hashes.
PART_BYTES = 12 << 20
#: Groups that a language's candidates are ranked in before the last ranking: it meets at most SALTS * top rows.
SALTS = 64
BORDER = b"\xff"  # no byte of UTF-8

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + BORDER * 10)
_PLACE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


class Direction:
    """One Burrows-Wheeler transform: rows sorted by ``depth`` symbols, C and LF."""

    def __init__(self, x: np.ndarray, sigma: int, depth: int):
        n = len(x)
        key = x.copy()
        for d in range(1, depth):
            key *= sigma
            key[:n - d] += x[d:]
        order = np.argsort(key)
        self.bwt = x[order - 1]
        self.c = np.concatenate(([0], np.cumsum(np.bincount(x, minlength=sigma))))
        self.lf = np.empty(n, np.int64)  # C[c] + occurrences of c in rows before
        self.lf[np.argsort(self.bwt, kind="stable")] = np.arange(n)


class FMIndex:
    """Both directions of a sequence of ids; 0 is a border, and the sequence ends with one."""

    def __init__(self, x: np.ndarray, sigma: int, depth: int = 2):
        self.sigma = sigma
        self.forward, self.backward = Direction(x, sigma, depth), Direction(x[::-1].copy(), sigma, depth)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every id but 0 with its interval (the same in both directions)."""
        w = np.arange(1, self.sigma)
        return w, self.forward.c[1:-1], self.forward.c[2:]

    def extend(self, way: Direction, lo: np.ndarray, hi: np.ndarray, twin: np.ndarray):
        """All intervals extended by all words that precede them in ``way``: (interval, word, lo, hi, twin lo),
        sorted by interval and word."""
        size = hi - lo
        own = np.repeat(np.arange(len(lo)), size)
        row = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size) + lo[own]
        word = way.bwt[row]
        key = own * self.sigma + word
        order = np.argsort(key, kind="stable")
        k = key[order]
        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.empty(0, np.int64)
        count = np.diff(np.append(first, len(k)))
        at = order[first]
        own, word = own[at], word[at]
        new_lo = way.lf[row[at]]
        before = first - (np.cumsum(size) - size)[own]  # rows of the interval with smaller words
        keep = word > 0
        return own[keep], word[keep], new_lo[keep], (new_lo + count)[keep], (twin[own] + before)[keep]


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word ids (0: a border of pieces) and the distinct words, ``words[id - 1]``."""
    raw = BORDER.join(texts + [b""]).translate(_LOWER).replace(BORDER, b" " + BORDER + b" ").split()
    raw.insert(0, BORDER)  # the border gets code 0
    x, words = pd.factorize(np.array(raw, dtype=object))
    return x[1:].astype(np.int64), words[1:]


class Shard:
    """One language of one tile: index, words, two-word phrases and their hashes."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.lang = lang
        x, self.text = tokens(texts)
        self.n = int((x > 0).sum())
        self.index = FMIndex(x, len(self.text) + 1)
        self.seed = seed = pd.util.hash_array(np.array([lang], dtype=object))[0]
        h = np.concatenate(([np.uint64(0)], pd.util.hash_array(self.text, categorize=False) if len(self.text) else np.empty(0, np.uint64)))
        self.word, lo, hi = self.index.words()
        self.count = hi - lo
        self.word_key = mix(h[self.word] * _PLACE[0] + seed)
        of, first, self.lo, self.hi, self.twin = self.index.extend(self.index.forward, lo, hi, lo)
        self.first, self.second = first, self.word[of]
        self.pair_count = self.hi - self.lo
        self.pair_key = mix(h[self.first] * _PLACE[1] + h[self.second] * _PLACE[2] + seed)

    def longer(self, pair_ok: np.ndarray):
        """Three-word phrases whose two-word parts are both ``pair_ok``: first, second, third word and count."""
        ok = np.flatnonzero(pair_ok)
        code = np.sort(self.first[ok] * self.index.sigma + self.second[ok])
        size = self.hi[ok] - self.lo[ok]
        of, third, lo, hi, _ = self.index.extend(self.index.backward, self.twin[ok], self.twin[ok] + size, self.lo[ok])
        second = self.second[ok][of]
        want = second * self.index.sigma + third
        at = np.searchsorted(code, want)
        keep = (at < len(code)) & (code[np.minimum(at, len(code) - 1)] == want) if len(code) else np.zeros(len(want), bool)
        return self.first[ok][of][keep], second[keep], third[keep], (hi - lo)[keep]


def shards(pdf: pd.DataFrame) -> list[Shard]:
    """The shards of a tile that hold any text, by language."""
    out = []
    for lang, rows in pdf.groupby("lang", sort=True):
        out.append(Shard(lang, [t.encode() for t in rows["text"]]))
    return out


def _listing(of: list[Shard]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All keys of a tile, sorted, their counts, and the order that sorts them."""
    keys = np.concatenate([k for s in of for k in (s.word_key, s.pair_key)] or [np.empty(0, np.uint64)])
    counts = np.concatenate([k for s in of for k in (s.count, s.pair_count)] or [np.empty(0, np.int64)])
    order = np.argsort(keys, kind="stable")
    return keys[order], counts[order], order


def list_keys(parts: int):
    def run(key, pdf):
        keys, counts, _ = _listing(shards(pdf))
        rows = [(p, key[0], pack_sorted(keys[at]), pack(counts[at].astype(np.uint32))) for p, at in by_part(keys, parts)]
        return pd.DataFrame(rows, columns=["part", "tile", "keys", "counts"])
    return run


def often(least: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack_sorted(b) for b in pdf["keys"]]
        _, sums, place = merged(lists, [unpack(b, np.uint32).astype(np.int64) for b in pdf["counts"]])
        flags = (sums >= least)[place]
        cuts = np.cumsum([len(k) for k in lists])[:-1]
        return pd.DataFrame({"tile": pdf["tile"].to_numpy(), "part": pdf["part"].to_numpy(),
                             "flags": [pack(np.packbits(f)) for f in np.split(flags, cuts)], "n": [len(k) for k in lists]})
    return run


def list_phrases(parts: int):
    """The phrases themselves and their counts, by part; the empty phrase counts all words."""
    def run(key, texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        of = shards(texts)
        keys, _, order = _listing(of)
        answers = answers.sort_values("part")
        flags = [np.unpackbits(unpack(b, np.uint8), count=int(n)) for b, n in zip(answers["flags"], answers["n"])]
        ok = np.zeros(len(keys), bool)
        if flags:
            ok[order] = np.concatenate(flags).astype(bool)
        rows, at = [], 0
        for s in of:
            word_ok, pair_ok = ok[at:at + len(s.word_key)], ok[at + len(s.word_key):at + len(s.word_key) + len(s.pair_key)]
            at += len(s.word_key) + len(s.pair_key)
            a, b, c, n = s.longer(pair_ok)
            text = np.concatenate((np.array([b""], object), s.text))
            two = text[s.first[pair_ok]] + b" " + text[s.second[pair_ok]]
            phrases = np.concatenate((text[:1], text[s.word[word_ok]], two, text[a] + b" " + text[b] + b" " + text[c]))
            counts = np.concatenate(([s.n], s.count[word_ok], s.pair_count[pair_ok], n))
            # dealt by the first and last word's keys, so that phrases of one frequent word are spread
            h = mix(np.concatenate(([s.seed], s.word_key[word_ok], s.pair_key[pair_ok], s.word_key[a - 1] * _PLACE[1] + s.word_key[b - 1] * _PLACE[2] + s.word_key[c - 1])))
            order_of = np.argsort(h)
            for p, k in by_part(h[order_of], parts):
                mine = order_of[k]
                rows.append((p, s.lang, pack_bytes(b"\n".join(phrases[mine])), pack(counts[mine])))
        return pd.DataFrame(rows, columns=["part", "lang", "phrases", "counts"])
    return run


def sum_phrases(least: int):
    """Sums over all shards, of the phrases themselves: two and three words from ``least`` on, and all words."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lang, rows in pdf.groupby("lang"):
            lists = [unpack_bytes(b).split(b"\n") for b in rows["phrases"]]
            at, phrases = pd.factorize(np.array([p for k in lists for p in k], dtype=object))
            f = np.zeros(len(phrases), np.int64)
            np.add.at(f, at, np.concatenate([unpack(b, np.int64) for b in rows["counts"]]))
            kept = [(p.decode().split(" "), n) for p, n in zip(phrases, f.tolist()) if n >= least or b" " not in p]
            out.append(pd.DataFrame([(lang, *(w if w != [""] else []), *[None] * (3 - (len(w) if w != [""] else 0)), n) for w, n in kept],
                                    columns=["lang", "w1", "w2", "w3", "f"]))
        return pd.concat(out)
    return run


def phrase_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  least: int = LEAST, **sizes) -> DataFrame:
    """``lang, w1, w2, w3, f``: exact counts of the phrases of two and three words that reach ``least`` and of
    their words (and some others); the row without words has the number of words of the language."""
    rows, _, total = tiled(docs, id_col, text_col, lang=F.coalesce(F.col(lang_col).cast("string"), F.lit("und")),
                           **{k: v for k, v in sizes.items() if k == "tile_bytes"})
    texts = rows.select("tile", "lang", "text")
    parts = parts_for(total, sizes.get("part_bytes", PART_BYTES), 4)
    keys = texts.groupBy("tile").applyInPandas(list_keys(parts), "part int, tile int, keys binary, counts binary")
    answers = keys.groupBy("part").applyInPandas(often(least), "tile int, part int, flags binary, n int")
    local = texts.groupBy("tile").cogroup(answers.groupBy("tile")).applyInPandas(
        list_phrases(parts), "part int, lang string, phrases binary, counts binary")
    return local.groupBy("part").applyInPandas(sum_phrases(least), "lang string, w1 string, w2 string, w3 string, f long")


def score(a: str, left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)) as SQL text, exact for counts below 10**15."""
    n = "CAST({} AS DECIMAL(15,0))".format
    return f"CAST((CAST(1000000 AS DECIMAL(7,0)) * ({n(a)} * {n(a)})) DIV ({n(left)} * {n(right)}) AS BIGINT)"


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 least: int = LEAST, top: int = TOP, share: int = SHARE, **sizes) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases."""
    f = shared_table(phrase_counts(docs, id_col, text_col, lang_col, least, **sizes), "phrases")
    n = f.filter("w1 IS NULL").select("lang", F.col("f").alias("n"))
    words = f.filter("w1 IS NOT NULL AND w2 IS NULL").select("lang", F.col("w1").alias("w"), F.col("f").alias("fw"))
    two = f.filter(f"w2 IS NOT NULL AND w3 IS NULL AND f >= {int(least)}").select("lang", "w1", "w2", F.col("f").alias("a"))
    three = f.filter(f"w3 IS NOT NULL AND f >= {int(least)}").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))
    # every word of a candidate and every two-word part of a longer one reaches the least count itself
    one = lambda w, name: words.select("lang", F.col("w").alias(w), F.col("fw").alias(name))
    pair = lambda x, y, name: two.select("lang", F.col("w1").alias(x), F.col("w2").alias(y), F.col("a").alias(name))
    inside = three.select("lang", "w1", "w2", "a").unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    inside = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longest"))
    short = (two.join(inside, ["lang", "w1", "w2"], "left").filter(F.col("longest").isNull() | (100 * F.col("longest") < share * F.col("a")))
             .join(one("w1", "l"), ["lang", "w1"]).join(one("w2", "r"), ["lang", "w2"])
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", F.expr(score("a", "l", "r")).alias("score")))
    long = (three.join(one("w1", "l1"), ["lang", "w1"]).join(one("w3", "r2"), ["lang", "w3"])
            .join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"]).join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"])
            .withColumn("s1", F.expr(score("a", "l1", "r1"))).withColumn("s2", F.expr(score("a", "l2", "r2"))))
    cut = F.col("s1") <= F.col("s2")
    long = long.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(cut, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                       F.when(cut, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    # the best of every salted group first: no task sorts all phrases of a language
    best, order = short.unionByName(long).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))), (F.desc("score"), F.desc("a"), "phrase")
    for keys in (("lang", "salt"), ("lang",)):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(F.broadcast(n), "lang").select(  # one row for each language that has a phrase
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = """
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
tokens AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS (
  SELECT lang, w[i] AS w1, CASE WHEN i < len(w) THEN w[i + 1] END AS w2, CASE WHEN i + 1 < len(w) THEN w[i + 2] END AS w3 FROM tokens),
n AS (SELECT lang, count(*) AS n FROM grams GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM grams GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM grams WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, w1, w2, max(f) AS m FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  LEFT JOIN longer m ON m.lang = f2.lang AND m.w1 = f2.w1 AND m.w2 = f2.w2
  WHERE f2.f >= 10 AND (m.m IS NULL OR 100 * m.m < 50 * f2.f)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 1, x.f, y.f
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 2, x.f, y.f
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
scored AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
