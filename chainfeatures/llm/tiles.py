"""Tiles of documents, and packed arrays of 64-bit keys that travel between tiles and parts.

A *tile* is a few MB of documents, dealt by a hash of id and text, so that a lost task deals the same
documents again.  Tiles list what they hold as sorted 64-bit keys; a *part* is a range of keys, so a
tile's sorted list falls into parts by cutting.  A key reaches a part once for each tile, however
often it occurs: that is the aggregation before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for, text_bytes

TILE_BYTES = 8 << 20


def tiled(docs: DataFrame, id_col: str, text_col: str, tile_bytes: int = TILE_BYTES, **more) -> tuple[DataFrame, int, int]:
    """((tile, id, text, and the columns ``more``), rows, bytes of all texts); a null text is empty.

    ``id`` is the id's text: pandas would turn large whole numbers next to a null into floats."""
    n, total = text_bytes(docs, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    tiles = parts_for(total + 64 * n, tile_bytes)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), text.alias("text"), *[c.alias(name) for name, c in more.items()])
    return rows.withColumn("tile", F.pmod(F.xxhash64("id", "text"), F.lit(tiles)).cast("int")), n, total


def pack(a: np.ndarray) -> bytes:
    """A NumPy array as compressed bytes, equal places of all values next to each other."""
    a = np.ascontiguousarray(a)
    raw = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
    return len(a).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(b: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    n = int.from_bytes(b[:8], "little")
    raw = pa.decompress(b[8:], decompressed_size=n * dtype.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).reshape(n)


def pack_bytes(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_bytes(b: bytes) -> bytes:
    return pa.decompress(b[8:], decompressed_size=int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def part_cuts(sorted_keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the list of sorted keys is cut into parts: ``parts + 1`` places."""
    borders = np.array([(k << 64) // parts for k in range(1, parts)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(sorted_keys, borders), [len(sorted_keys)]))


def by_part(sorted_keys: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    cuts = part_cuts(sorted_keys, parts)
    for p in np.flatnonzero(np.diff(cuts)):
        yield int(p), slice(int(cuts[p]), int(cuts[p + 1]))


def merged(lists: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of several lists, sorted; the sum of their values; the place of every entry of the joined lists."""
    keys = np.concatenate(lists) if lists else np.empty(0, np.uint64)
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    cut = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.empty(0, bool)
    first = np.flatnonzero(cut)
    v = np.concatenate(values)[order] if values else np.empty(0, np.int64)
    sums = np.add.reduceat(v, first) if len(first) else v[:0]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(cut) - 1
    return s[first], sums, place
