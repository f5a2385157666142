"""Benchmark decontamination by winnowing.

Both sides are cut into words, hashed in grams of 5, and winnowed: the least gram hash of
every 6 consecutive grams is kept.  Any 10 words that a document shares with an item
contain 6 grams on both sides, so both keep the same gram: every shared window of 10
words starts at a shared fingerprint.  A fingerprint hit is then extended: the
windows of 10 words around it are compared with the item's windows, and the words of
those that occur are hit.  Items of fewer words are one window, compared as a whole.

The benchmark is sent to the executors only while its texts and ids are below
``broadcast_bytes``; a larger one meets the documents in shuffle joins: first the distinct
fingerprints, then the windows around the shared ones, by value and not by item, so a phrase that
all documents and items share is one row for each document.  Items are named last, for windows that occur.

Defined cases: null or empty text has no words and is clean; an item without words or
without an id hits nothing; repeated item ids count once; an empty benchmark leaves all
documents clean; very long texts are judged whole; rows with one id, or none, are judged each for itself; an empty
table gives an empty result; other columns, whatever their names, are not read (``keep_clean`` passes them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table
from .words import ALPHANUMERIC, blocks, mix, whole, windows, words

WINDOW, GRAM = 10, 5
BROADCAST_BYTES = 32 << 20
_HIT = "n_words long, n_hit long, items array<string>"


def winnow(gram: np.ndarray, span: int = WINDOW - GRAM + 1) -> np.ndarray:
    """Positions whose hash is the least of some ``span`` consecutive grams."""
    n = len(gram) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least = gram[:n].copy()
    for j in range(1, span):
        np.minimum(least, gram[j:j + n], out=least)
    keep = np.zeros(len(gram), bool)
    for j in range(span):
        keep[j:j + n] |= gram[j:j + n] == least
    return np.flatnonzero(keep)


def _inside(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


class Index:
    """Fingerprints and windows of benchmark items: {words in the window: (hashes, first owner of each, owners)}."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.names = sorted({item for item, _ in items})
        number = {item: k for k, item in enumerate(self.names)}
        by_len: dict[int, list] = {}
        prints = [np.empty(0, np.uint64)]
        for (item, _), h in zip(items, _documents([text for _, text in items])):
            if len(h) >= WINDOW:
                gram = windows(h, GRAM)
                prints.append(gram[winnow(gram)])
            if len(h):
                value = _item_windows(h)
                by_len.setdefault(min(len(h), WINDOW), []).append((value, np.full(len(value), number[item], np.int32)))
        self.prints = np.unique(np.concatenate(prints))
        self.windows = {}
        for n, found in by_len.items():
            value, owner = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((owner, value))
            value, owner = value[order], owner[order]
            keys, first = np.unique(value, return_index=True)
            self.windows[n] = (keys, np.append(first, len(value)), owner)

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, set]:
        """Which words of one document are hit, and by which items."""
        cover, items = np.zeros(len(h) + 1, np.int64), set()
        for n, (keys, first, owner) in self.windows.items():
            if len(h) < n:
                continue
            if n == WINDOW:
                start, value = _extended(h, self.prints)
            else:
                start = np.arange(len(h) - n + 1)
                value = _short(h, n)
            ok = _inside(keys, value)
            np.add.at(cover, start[ok], 1)
            np.add.at(cover, start[ok] + n, -1)
            for k in np.unique(np.searchsorted(keys, value[ok])):
                items.update(self.names[o] for o in owner[first[k]:first[k + 1]])
        return np.cumsum(cover[:-1]) > 0, items


def _item_windows(h: np.ndarray) -> np.ndarray:
    """Hashes of an item's windows: of all runs of WINDOW words, or of the whole of a shorter item."""
    return windows(h, WINDOW) if len(h) >= WINDOW else np.array([whole(h)], np.uint64)


def _extended(h: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every window of a document that contains one of its fingerprints that is in ``prints`` (sorted)."""
    gram = windows(h, GRAM)
    at = winnow(gram)
    at = at[_inside(prints, gram[at])]
    start = np.unique((at[:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
    start = start[(start >= 0) & (start <= len(h) - WINDOW)]
    if not len(start):
        return start, gram[:0]
    lo = start[0]
    return start, windows(h[lo:start[-1] + WINDOW], WINDOW)[start - lo]


def _short(h: np.ndarray, n: int) -> np.ndarray:
    """``whole`` of every ``n`` consecutive words."""
    return mix(windows(h, n) + np.uint64(n))


def _documents(texts: list[bytes]):
    """Word hashes of each text, in order."""
    for i, j, buf, starts in blocks(texts):
        h, s, _ = words(buf, ALPHANUMERIC)
        first = np.searchsorted(s, starts)
        last = np.append(first[1:], len(h))
        for d in range(j - i):
            yield h[first[d]:last[d]]


def _bytes(col: pd.Series) -> list[bytes]:
    return [t.encode() if t else b"" for t in col]


def _items(bench: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return bench.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).filter("item IS NOT NULL AND text RLIKE '[0-9A-Za-z]|[^\\\\x00-\\\\x7F]'")


def _bounded(items: DataFrame, limit: int) -> bool:
    """Whether the items, with their ids and some bytes for each row, have at most ``limit`` bytes."""
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item") + F.lit(64)).alias("n")).first()["n"]
    return (size or 0) <= limit


def hit_column(bench_items: list[tuple[str, bytes]], text):
    """Column of (n_words, n_hit, items) for a text column, against a bounded benchmark."""

    def run(batches):
        index = Index(bench_items)
        for col in batches:
            rows = []
            for h in _documents(_bytes(col)):
                if len(h):
                    mask, items = index.hits(h)
                    rows.append((len(h), int(mask.sum()), sorted(items)))
                else:
                    rows.append((0, 0, []))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items"])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, _HIT).asNondeterministic()(text)


def _rows(parts: list[tuple], names: list[str]) -> pd.DataFrame:
    """One frame from tuples of a key and equally long arrays."""
    sizes = np.array([len(p[1]) for p in parts], np.int64)
    out = {names[0]: np.repeat(np.array([p[0] for p in parts], object), sizes)}
    for k, name in enumerate(names[1:], 1):
        out[name] = np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64)
    return pd.DataFrame(out)


def _prints_of(lengths: list[int]):
    """(key, text) -> a document's fingerprints (``n`` is WINDOW) and its windows of the lengths that short items have."""
    def run(batches):
        for pdf in batches:
            parts = []
            for key, h in zip(pdf["key"], _documents(_bytes(pdf["text"]))):
                gram = windows(h, GRAM)
                found = [(WINDOW, gram[winnow(gram)])] + [(n, _short(h, n)) for n in lengths if n <= len(h)]
                for n, v in found:
                    v = np.unique(v).view(np.int64)
                    parts.append((key, np.full(len(v), n), v))
            yield _rows(parts, ["key", "n", "fp"])
    return run


def _item_prints(batches):
    for pdf in batches:
        parts = []
        for h in _documents(_bytes(pdf["text"])):
            if len(h) >= WINDOW:
                gram = windows(h, GRAM)
                v = np.unique(gram[winnow(gram)]).view(np.int64)
                parts.append((WINDOW, v))
            elif len(h):
                parts.append((len(h), _item_windows(h).view(np.int64)))
        yield _rows(parts, ["n", "fp"])


def _windows_of_items(batches):
    for pdf in batches:
        parts = []
        for item, h in zip(pdf["item"], _documents(_bytes(pdf["text"]))):
            if len(h):
                v = np.unique(_item_windows(h)).view(np.int64)
                parts.append((item, np.full(len(v), min(len(h), WINDOW)), v))
        yield _rows(parts, ["item", "n", "w"])


def _windows_at(batches):
    """(key, text, shared) -> the windows of a document that contain a shared fingerprint or are a shared short window."""
    for pdf in batches:
        parts = []
        for key, h, ns, fps in zip(pdf["key"], _documents(_bytes(pdf["text"])), pdf["ns"], pdf["fps"]):
            ns, fps = np.asarray(ns), np.asarray(fps, np.int64).view(np.uint64)
            for n in np.unique(ns).tolist():
                mine = np.sort(fps[ns == n])
                if n == WINDOW:
                    start, value = _extended(h, mine)
                else:
                    value = _short(h, n)
                    start = np.flatnonzero(_inside(mine, value))
                    value = value[start]
                parts.append((key, np.full(len(start), n), start, value.view(np.int64)))
        yield _rows(parts, ["key", "n", "start", "w"])


def _joined(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, n_hit, items) of contaminated documents ``docs(key, text)`` by shuffle joins.

    The item side of the first two joins has one row for each value, so no value multiplies rows however many
    documents or items hold it."""
    marks = shared_table(items.select("text").mapInPandas(_item_prints, "n int, fp long").distinct(), "marks")
    lengths = sorted(r["n"] for r in marks.filter(F.col("n") < WINDOW).select("n").distinct().collect())  # under WINDOW values
    shared = docs.mapInPandas(_prints_of(lengths), "key string, n int, fp long").join(marks, ["n", "fp"], "left_semi").distinct()
    # of one text: not more than its words for each length
    shared = shared_table(shared.groupBy("key").agg(F.collect_list(F.struct("n", "fp")).alias("s")).select("key", F.col("s.n").alias("ns"), F.col("s.fp").alias("fps")), "shared")
    once = docs.join(shared.select("key"), "key", "left_semi").dropDuplicates(["key"])
    owned = items.mapInPandas(_windows_of_items, "item string, n int, w long").distinct()
    at = once.join(shared, "key").mapInPandas(_windows_at, "key string, n int, start int, w long")
    hit = shared_table(at.join(owned.select("n", "w").distinct(), ["n", "w"], "left_semi"), "hits")
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("ranges", zero, lambda a, x: F.struct(
        F.greatest(a["end"], x["start"] + x["n"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), x["start"] + x["n"] - F.greatest(x["start"], a["end"]))).alias("n")), lambda a: a["n"])
    words_hit = hit.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "n"))).alias("ranges")).select("key", covered.alias("n_hit"))
    named = hit.select("key", "n", "w").distinct().join(owned, ["n", "w"]).groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return words_hit.join(named, "key")


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated`` for every row of ``docs``."""
    items = _items(bench, item_col, item_text_col)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if _bounded(items, broadcast_bytes):
        rows = [(r["item"], r["text"].encode()) for r in items.collect()]  # its size has just been checked
        out = d.select("doc_id", hit_column(rows, F.col("text")).alias("h")).select("doc_id", "h.*")
    else:
        keyed = d.withColumn("key", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
        counted = keyed.select("doc_id", "key", hit_column([], F.col("text")).alias("h")).select("doc_id", "key", "h.n_words")
        found = shared_table(_joined(keyed.select("key", "text"), items), "contaminated")
        out = counted.join(found, "key", "left").select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have, in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def keep_clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that no benchmark item contaminates."""
    items = _items(bench, item_col, item_text_col)
    if _bounded(items, broadcast_bytes):
        rows = [(r["item"], r["text"].encode()) for r in items.collect()]  # its size has just been checked
        hit = _fresh(docs, "hit")
        return docs.withColumn(hit, hit_column(rows, F.col(text_col).cast("string"))).filter(F.col(f"{hit}.n_hit") == 0).drop(hit)
    key, name = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256), _fresh(docs, "key")
    found = _joined(docs.select(key.alias("key"), F.col(text_col).cast("string").alias("text")), items).select(F.col("key").alias(name))
    return docs.join(shared_table(found, "contaminated"), key == F.col(name), "left_anti")


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    r = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")
