"""Toxicity: Levenshtein automata over a lexicon trie, with context windows.

The lexicon is learned from labelled documents: words of two letters or more, and stems of at least four
letters that many different words begin with, which occur in toxic documents far
more than in others (log-likelihood ratio; later rounds look at the toxic documents that
have no term yet).  One deterministic automaton is the intersection of the lexicon trie with
the Levenshtein automata of distance 1: its states are sets of (trie node, edits).  It
runs over all words of a block at once, a table step for each code point; nearly all words are
dropped after two or three.  Near misses that clean documents use are exempt.

Learning and scoring cut words alike: runs of letters and digits of any script, so quotation
marks, dashes and apostrophes of any kind border a word; case is folded in all scripts.

Every hit is seen in a window: whether it stands between quotation marks or is
reported (quotation), whether other hits or words of address are close (abuse).  Counts of
these are the features of a logistic regression.

Defined cases: a null or empty text has no hits and gets the base score; a null id is not held
out and never learned from; without labels of both kinds the lexicon is empty and all scores are
low; repeated rows get equal scores; very long texts are read whole, block by block; an empty table gives an empty
result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, shared_table
from .learn import labelled_sample, logistic, sigmoid
from .words import ALPHANUMERIC, blocks, words

STEMS = range(4, 11)
#: Share of the best term's likelihood ratio that a term of the same round must reach.
STRONG = 0.2
#: Closed words from this number of characters on, and stems from the second, also match at distance 1.
FUZZY_WORD, FUZZY_STEM = 5, 7
#: Longer terms match exactly.
FUZZY_MOST = 24
WINDOW_BYTES = 120
MODULUS, HELD_OUT, THRESHOLD = 4, 2, 0.3

# --- fixed values: quotation marks, words that report speech, words of address ---
QUOTE_PAIRS = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’", "`": "`"}
REPORT = re.compile(r"\b(said|says|wrote|quoted?|called|term|word|phrase|sagte|schrieb|zitiert|wort|dit|écrit|cite|mot|dijo|escribió|cita|palabra)\b")
ADDRESS = re.compile(r"\b(you|your|u|ur|du|dich|dein|ihr|euch|tu|toi|ton|vous|tú|te|usted|ustedes)\b")
# --- end of fixed values ---

FEATURES = ["abuse", "quoted", "fuzzy", "distinct", "dense", "share", "address"]


def fold(text: str) -> str:
    """Lower case by single code points: no letter becomes two, and sigma has one form."""
    return text.replace("\u0130", "i").lower().replace("ς", "σ")


@cache
def _code_points() -> tuple[np.ndarray, dict[int, list[int]]]:
    """Whether each code point belongs to words, and the code points that fold to another."""
    is_word = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    variants: dict[int, list[int]] = {}
    for c in np.flatnonzero(is_word[:0x20000]).tolist():  # no letter with case is above
        low = ord(fold(chr(c)))
        if low != c:
            variants.setdefault(low, []).append(c)
    return is_word, variants


class Automaton:
    """Deterministic automaton of a lexicon [(term, is_stem)] with at most one edit."""

    def __init__(self, lexicon: list[tuple[bytes, bool]]):
        self.terms = lexicon
        child: list[dict[int, int]] = [{}]
        closed: dict[int, int] = {}
        opened: dict[int, int] = {}
        fuzzy = {}
        for k, (term, stem) in enumerate(lexicon):
            node, term = 0, [ord(c) for c in fold(term.decode())]
            for c in term:
                if c not in child[node]:
                    child[node][c] = len(child)
                    child.append({})
                node = child[node][c]
            (opened if stem else closed)[node] = k
            fuzzy[k] = (FUZZY_STEM if stem else FUZZY_WORD) <= len(term) <= FUZZY_MOST
        # nodes that lead to a term which may be misspelt
        soft = [False] * len(child)
        for node in range(len(child) - 1, -1, -1):
            own = [fuzzy[t[node]] for t in (closed, opened) if node in t]
            soft[node] = any(own) or any(soft[n] for n in child[node].values())

        def closure(states):
            todo, seen = list(states), set(states)
            while todo:
                node, e = todo.pop()
                if e == 0 and soft[node]:
                    for n in child[node].values():
                        if soft[n] and (n, 1) not in seen:
                            seen.add((n, 1))
                            todo.append((n, 1))
            return frozenset(s for s in seen if s[1] == 0 or (s[0], 0) not in seen)

        def hit(states, table):
            best = None
            for node, e in states:
                if node in table and (e == 0 or fuzzy[table[node]]):
                    best = min(best, (e, table[node])) if best else (e, table[node])
            return best

        alphabet = {c: i for i, c in enumerate(sorted({c for d in child for c in d}))}
        variants = _code_points()[1]
        self.kind = np.full(0x110000, len(alphabet), np.int32)
        for c, i in alphabet.items():
            self.kind[[c, *variants.get(c, [])]] = i
        start = closure({(0, 0)})
        number, todo = {frozenset(): 0, start: 1}, [start]
        rows = {0: (0, {})}  # state after any other code point, and after those that lead on from the state
        ends, stems = {0: None}, {0: None}
        while todo:
            states = todo.pop()
            me = number[states]
            ends[me], stems[me] = hit(states, closed), hit(states, opened)
            row = {}
            for c in [-1, *{c for node, _ in states for c in child[node]}]:
                nxt = set()
                for node, e in states:
                    if c in child[node]:
                        nxt.add((child[node][c], e))
                    if e == 0 and soft[node]:
                        nxt.add((node, 1))
                        nxt.update((n, 1) for x, n in child[node].items() if x != c and soft[n])
                to = closure(nxt)
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row[c] = number[to]
            rows[me] = (row.pop(-1), row)
        self.step = np.empty((len(number), len(alphabet) + 1), np.int32)
        for k, (other, row) in rows.items():
            self.step[k] = other
            for c, to in row.items():
                self.step[k, alphabet[c]] = to
        pack = lambda d: np.array([-1 if d[k] is None else d[k][1] * 2 + d[k][0] for k in range(len(number))], np.int32)
        self.at_end, self.at_stem = pack(ends), pack(stems)

    def match(self, a: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Term and edits of each word as ``term * 2 + edits``, or -1."""
        out = np.full(len(s), -1, np.int32)
        if not self.terms:
            return out
        at, state, t = np.arange(len(s)), np.ones(len(s), np.int32), 0
        pos, end = s.copy(), e
        while len(at):
            done = pos == end
            if done.any():
                out[at[done]] = self.at_end[state[done]]
                go = ~done
                at, state, pos, end = at[go], state[go], pos[go], end[go]
            state = self.step[state, self.kind[a[pos]]]
            stem = self.at_stem[state]
            found = stem >= 0
            out[at[found]] = stem[found]
            go = (state != 0) & ~found
            at, state, pos, end = at[go], state[go], pos[go] + 1, end[go]
            t += 1
        return out


def is_quoted(left: str, right: str) -> bool:
    """Whether the text around a hit opens a quotation before and closes it after it."""
    for o, c in QUOTE_PAIRS.items():
        if c not in right:
            continue
        if (o == c and left.count(o) % 2) or (o != c and left.rfind(o) > left.rfind(c)):
            return True
    return False


def _cut(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points, the byte where each begins (and the end), and start and end of every word in code points."""
    a = np.frombuffer(buf, np.uint8)
    if buf.isascii():
        code, at = a, np.arange(len(a) + 1)
    else:
        code = np.frombuffer(buf.decode().encode("utf-32-le"), np.uint32)
        at = np.append(np.flatnonzero((a & 0xC0) != 0x80), len(a))
    edge = np.flatnonzero(np.diff(_code_points()[0][code].view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return code, at, edge[0::2], edge[1::2]


def _hashes(found: list[str]) -> np.ndarray:
    return words("\n".join(map(fold, found)).encode(), ALPHANUMERIC)[0]


def hits(texts: list[bytes], auto: Automaton, exempt: np.ndarray):
    """(index of the text, number of words, [(word number, term, edits, first byte, end)]) of every text."""
    for i, j, buf, starts in blocks(texts):
        code, byte, s, e = _cut(buf)
        m = auto.match(code, s, e)
        at = np.flatnonzero(m >= 0)
        s, e = byte[s], byte[e]
        near = np.flatnonzero(m[at] % 2 == 1)
        if len(exempt) and len(near):
            h = _hashes([buf[s[k]:e[k]].decode() for k in at[near]])
            known = exempt[np.minimum(np.searchsorted(exempt, h), len(exempt) - 1)] == h
            at = np.delete(at, near[known])
        first = np.searchsorted(s, starts)
        last = np.append(first[1:], len(s))
        doc = np.searchsorted(starts, s[at], "right") - 1
        lo, hi = np.searchsorted(doc, np.arange(j - i)), np.searchsorted(doc, np.arange(j - i), "right")
        for d in range(j - i):
            own = at[lo[d]:hi[d]]
            yield i + d, int(last[d] - first[d]), [(int(k - first[d]), int(m[k]) // 2, int(m[k]) % 2, int(s[k] - starts[d]), int(e[k] - starts[d])) for k in own]


def features(texts: list[bytes], auto: Automaton, exempt: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), len(FEATURES)))
    for d, n, found in hits(texts, auto, exempt):
        if not found:
            continue
        text, quoted, address, fuzzy = texts[d], 0, 0, 0
        for _, _, edits, s, e in found:
            left = text[max(0, s - WINDOW_BYTES):s].decode("utf-8", "ignore").lower()
            right = text[e:e + WINDOW_BYTES].decode("utf-8", "ignore").lower()
            near_left = left[-60:]
            said = bool(REPORT.search(near_left)) and is_quoted(left, right)
            quoted += said or is_quoted(left.split("\n")[-1], right.split("\n")[0])
            address += bool(ADDRESS.search(near_left[-24:]) or ADDRESS.search(right[:24]))
            fuzzy += edits
        places = np.array([k for k, *_ in found])
        dense = (np.searchsorted(places, places + 20, "right") - np.arange(len(places))).max()
        out[d] = [np.log1p(len(found) - quoted), np.log1p(quoted), np.log1p(fuzzy), np.log1p(len({t for _, t, *_ in found})),
                  np.log1p(dense), np.log1p(1000 * (len(found) - quoted) / max(n, 1)), np.log1p(address)]
    return out


def _candidates(text: str) -> set[str]:
    """Every possible term of a text: closed words (marked ``$``) and stems."""
    out = set()
    for w in set(re.findall(r"[^\W_]+", fold(text))):
        if len(w) > 1:
            out.add(w + "$")
        out.update(w[:k] for k in STEMS if len(w) > k)
    return out


def _count_candidates(only: set[str] | None):
    """Documents with each candidate."""
    def run(batches: Iterator[pd.DataFrame]):
        c = Counter()
        for pdf in batches:
            for t in pdf["text"]:
                found = _candidates(t)
                c.update(found if only is None else found & only)
        yield pd.DataFrame({"candidate": list(c), "n": list(c.values())}).astype({"candidate": object, "n": "int64"})  # also of no rows
    return run


def _llr(k1, n1, k0, n0):
    """Log-likelihood ratio of a term in ``k1`` of ``n1`` and ``k0`` of ``n0`` documents, where it leans to the first."""
    def part(k, n, p):
        return k * np.log(np.maximum(p, 1e-300)) + (n - k) * np.log(np.maximum(1 - p, 1e-300))
    p1, p0, p = k1 / n1, k0 / n0, (k1 + k0) / (n1 + n0)
    g = 2 * (part(k1, n1, p1) + part(k0, n0, p0) - part(k1, n1, p) - part(k0, n0, p))
    return np.where(p1 > p0, g, 0.0)


def learn_lexicon(sample: DataFrame) -> list[tuple[bytes, bool]]:
    """[(term, whether it is a stem)] from (text, label).  Closed words of two letters or more and stems come into question; rounds
    go on until no term is new, each without the documents that earlier terms explain."""
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return []
    lexicon: list[tuple[bytes, bool]] = []
    left, n1 = sample.filter("label = 1"), n[1]
    while True:
        seen = shared_table(left.select("text").mapInPandas(_count_candidates(None), "candidate string, n long").groupBy("candidate").agg(F.sum("n").alias("n"))
                            .filter(F.col("n") >= 3), "candidates")
        tried = seen.count()
        # what is too rare to pass even if no other document had it needs no counting there
        size = np.arange(3, n1 + 1)
        size = size[_llr(size.astype(float), n1, np.zeros(len(size)), n[0]) >= 2 * np.log(max(tried, 1))]
        seen = seen.filter(F.col("n") >= int(size[0]) if len(size) else F.lit(False)).toPandas()
        if not len(seen):
            break
        other = (sample.filter("label = 0").select("text").mapInPandas(_count_candidates(set(seen["candidate"])), "candidate string, n long")
                 .groupBy("candidate").agg(F.sum("n").alias("k0")).toPandas())
        t = seen.merge(other, how="left", on="candidate").fillna({"k0": 0})
        g = _llr(t["n"].to_numpy(float), n1, t["k0"].to_numpy(float), n[0])
        # most terms of a corpus are rare and harmless: ask for more than chance among all that were tried
        # ask also for a good part of the best term's evidence: what only a few copied documents share comes into
        # question in a later round, when documents that a stronger term explains are out of the count
        ok = (g >= np.maximum(2 * np.log(tried), STRONG * g.max())) & (t["n"].to_numpy() / n1 >= 20 * t["k0"].to_numpy() / n[0])
        t = t.assign(g=g)[ok].assign(size=lambda x: x["candidate"].str.len()).sort_values(["g", "size", "candidate"], ascending=[False, False, True])
        fresh = 0
        for cand in t["candidate"]:
            stem, body = not cand.endswith("$"), cand.removesuffix("$").encode()
            if any((body.startswith(b) if s else body == b) or (stem and b.startswith(body)) for b, s in lexicon):
                continue
            lexicon.append((body, stem))
            fresh += 1
        if not fresh:
            break
        exact = [(b.decode(), s) for b, s in lexicon]
        pattern = r"(?iu)(?<![\p{L}\p{N}])(" + "|".join(re.escape(b) + ("" if s else r"(?![\p{L}\p{N}])") for b, s in exact) + ")"
        left = left.filter(~F.col("text").rlike(pattern))
        n1 = left.count()
        if n1 < 3:
            break
    return lexicon


class Model:
    def __init__(self, lexicon, exempt, mean, scale, weights):
        self.lexicon, self.exempt, self.mean, self.scale, self.weights = lexicon, exempt, mean, scale, weights
        self.auto = None

    def score(self, texts: list[bytes]) -> np.ndarray:
        self.auto = self.auto or Automaton(self.lexicon)
        x = (features(texts, self.auto, self.exempt) - self.mean) / self.scale
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


def _near_misses(lexicon):
    def run(batches):
        auto, none, c = Automaton(lexicon), np.empty(0, np.uint64), Counter()
        for pdf in batches:
            for t, y in zip(pdf["text"], pdf["label"]):
                b = t.encode()
                for _, _, found in hits([b], auto, none):
                    c.update((w, y) for w in {fold(b[s:e].decode()) for _, _, edits, s, e in found if edits})
        yield pd.DataFrame([(w, y, n) for (w, y), n in c.items()], columns=["word", "label", "n"]).astype({"label": "int32", "n": "int64"})
    return run


def _feature_rows(lexicon, exempt):
    def run(batches):
        auto = Automaton(lexicon)
        for pdf in batches:
            x = features([t.encode() for t in pdf["text"]], auto, exempt)
            yield pd.DataFrame({"x": list(x), "label": pdf["label"]})
    return run


def fit(sample: DataFrame) -> Model:
    """Lexicon, exempt near misses and weights from the bounded sample (text, label)."""
    lexicon = learn_lexicon(sample)
    none = np.empty(0, np.uint64)
    zero = np.zeros(len(FEATURES))
    if not lexicon:
        return Model([], none, zero, zero + 1, np.append(zero, -3.0))
    near = sample.mapInPandas(_near_misses(lexicon), "word string, label int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("clean")).filter("clean >= 2").select("word").collect()  # words of the sample next to a term
    exempt = _hashes([r["word"] for r in near])
    exempt.sort()
    rows = sample.mapInPandas(_feature_rows(lexicon, exempt), "x array<double>, label int").toPandas()  # at most MAX_TRAIN rows
    x, y = np.stack(rows["x"]), rows["label"].to_numpy(float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 0.05)
    return Model(lexicon, exempt, mean, scale, logistic((x - mean) / scale, y, l2=0.05))


def score_column(model: Model, text):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for col in batches:
            yield pd.Series(model.score([t.encode() if t else b"" for t in col]))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double").asNondeterministic()(text)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    return fit(labelled_sample(docs, labels, label_col, MODULUS, HELD_OUT, id_col, text_col))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = train(docs, labels, id_col, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(crc_mod(id_col, MODULUS) == HELD_OUT, F.lit(False)).alias("held_out"),
                       score_column(model, F.col(text_col).cast("string")).alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
