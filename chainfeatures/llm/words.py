"""Words of many texts as NumPy arrays of 64-bit hashes.

Texts are joined into blocks of about half a MB, so that a task holds a few arrays of that
size whatever the number of texts; a longer text is a block of its own and is
hashed piece by piece.  The hash of a word is a polynomial over random 64-bit
values of its (lower-cased) bytes, taken from running sums, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

BLOCK = (1 << 19) - 1
_rng = np.random.default_rng(20240229)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Odd multipliers for the positions of a window of words.
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Separators are the blanks 09-0D and 20.
BLANK_SEPARATED = np.ones(256, bool)
BLANK_SEPARATED[[9, 10, 11, 12, 13, 32]] = False
#: Words are ASCII letters, digits and all bytes of non-ASCII characters.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def blocks(texts: list[bytes], size: int = BLOCK) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first, end, joined bytes, start of each text) of consecutive texts."""
    i = 0
    while i < len(texts):
        j, total = i, 0
        while j < len(texts) and (j == i or total + len(texts[j]) <= size):
            total += len(texts[j]) + 1
            j += 1
        lens = np.fromiter((len(t) + 1 for t in texts[i:j]), np.int64, j - i)
        yield i, j, b"\n".join(texts[i:j]), np.cumsum(lens) - lens
        i = j


def words(buf: bytes, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (exclusive) of every word, in order."""
    a = np.frombuffer(buf, np.uint8)
    edge = np.flatnonzero(np.diff(is_word[a].view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    s, e = edge[0::2], edge[1::2]
    h = np.empty(len(s), np.uint64)
    values = _VALUES[_LOWER]
    w = 0
    while w < len(s):
        lo = s[w]
        if e[w] - lo > BLOCK:  # one huge word: its own digest
            h[w] = int.from_bytes(blake2b(_LOWER[a[lo:e[w]]].tobytes(), digest_size=8).digest(), "little")
            w += 1
            continue
        x = int(np.searchsorted(e, lo + BLOCK, "right"))
        x = max(x, w + 1)
        hi = e[x - 1]
        pw, inv = _power_tables(int(hi - lo) + 1)
        run = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[a[lo:hi]] * pw[: hi - lo], out=run[1:])
        h[w:x] = (run[e[w:x] - lo] - run[s[w:x] - lo]) * inv[s[w:x] - lo]
        w = x
    return mix(h), s, e


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive words (over text borders too: mask those)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j:j + n] * _PLACE[j]
    return mix(out)


def whole(h: np.ndarray) -> np.uint64:
    """Hash of a short sequence as one unit; differs from any window of more words."""
    t = windows(h, len(h))
    return mix(t + np.uint64(len(h)))[0]
