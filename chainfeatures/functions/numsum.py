"""NumPy's summation order, as an expression tree.

``np.mean``/``np.sum`` over a contiguous float64 array use a pairwise sum:
fewer than 8 terms -> left to right from 0.0; up to 128 -> 8 interleaved lanes,
combined as ((r0+r1)+(r2+r3))+((r4+r5)+(r6+r7)), then the remainder left to
right; longer -> split in halves (a multiple of 8) recursively.  Building the same tree over a fixed number of
terms gives results bit-identical to the reference's NumPy means; ``add`` is
supplied by the caller, so the same tree renders as Spark Columns or SQL text.
"""

from __future__ import annotations

from typing import Callable, Sequence, TypeVar

T = TypeVar("T")


def _pairwise(xs: Sequence[T], add: Callable[[T, T], T], zero: T) -> T:
    n = len(xs)
    if n < 8:
        acc = zero
        for x in xs:
            acc = add(acc, x)
        return acc
    if n <= 128:
        r = list(xs[:8])
        i = 8
        while i < n - (n % 8):
            r = [add(r[j], xs[i + j]) for j in range(8)]
            i += 8
        res = add(add(add(r[0], r[1]), add(r[2], r[3])), add(add(r[4], r[5]), add(r[6], r[7])))
        for x in xs[i:]:
            res = add(res, x)
        return res
    half = n // 2
    half -= half % 8
    return add(_pairwise(xs[:half], add, zero), _pairwise(xs[half:], add, zero))


def numpy_sum(xs: Sequence[T], add: Callable[[T, T], T], zero: T) -> T:
    return _pairwise(xs, add, zero)
