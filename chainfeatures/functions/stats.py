"""Rolling statistics as SQL expression text (window aggregates only)."""

from __future__ import annotations

from chainfeatures.config import STD_FLOOR
from chainfeatures.functions.frames import Frames

FLOOR = repr(STD_FLOOR)


def zscore_with_current(x: str, fr: Frames, n: int, ok: str) -> str:
    """z of x against the non-missing values of the n earlier minutes plus now.

    Sample std; null if x is missing, fewer than 2 values, or std < 1e-6.
    """
    mean, std, cnt = fr.cur("avg", x, n), fr.cur("stddev_samp", x, n), fr.cur("count", x, n)
    return (f"CASE WHEN {ok} AND {x} IS NOT NULL AND {cnt} >= 2 AND {std} >= {FLOOR} "
            f"THEN ({x} - {mean}) / {std} END")


def zscore_history(x: str, fr: Frames, n: int, ok: str) -> str:
    """z of x against the n earlier minutes only; needs std > 1e-6."""
    mean, std = fr.hist("avg", x, n), fr.hist("stddev_samp", x, n)
    return f"CASE WHEN {ok} AND {std} > {FLOOR} THEN ({x} - {mean}) / {std} END"


def log_return(now: str, then: str) -> str:
    """ln(now/then) when both are positive, else null."""
    return f"CASE WHEN {now} > 0 AND {then} > 0 THEN ln({now} / {then}) END"


def ema_fold(points: str, span: int) -> str:
    """Exponential mean with ``span``, no adjustment, over a time-sorted array
    of ``struct(s, v)``, seeded with its first element.

    Missing values follow the recursive definition: the weight of the running
    mean keeps decaying across a gap and is reset when a value arrives; before
    the first value the mean is missing.
    """
    com = (span - 1) / 2.0
    alpha = 1.0 / (1.0 + com)
    a, d = f"CAST('{alpha!r}' AS DOUBLE)", f"CAST('{1.0 - alpha!r}' AS DOUBLE)"
    wd = f"(CASE WHEN acc.m IS NOT NULL THEN acc.w * {d} ELSE acc.w END)"
    m = (f"CASE WHEN acc.m IS NULL THEN p.v WHEN p.v IS NULL THEN acc.m "
         f"WHEN acc.m != p.v THEN ({wd} * acc.m + {a} * p.v) / ({wd} + {a}) ELSE acc.m END")
    w = f"CASE WHEN acc.m IS NOT NULL AND p.v IS NOT NULL THEN 1.0D ELSE {wd} END"
    return (f"aggregate(slice({points}, 2, greatest(size({points}) - 1, 0)), "
            f"named_struct('m', CAST(try_element_at({points}, 1).v AS DOUBLE), 'w', 1.0D), "
            f"(acc, p) -> named_struct('m', {m}, 'w', {w}), acc -> acc.m)")
