"""Positional frames over the global minute queue, as Spark SQL window text.

``minute_seq`` numbers the valid minutes 1, 2, 3, ... in time order, so "k
minutes ago" is the row whose ``minute_seq`` is exactly ``s - k`` (absent ->
null; no fallback to an older row).  Every look-back in the engine is one of
three range frames over ``minute_seq``, within a partition (a key and its time
block):

* ``lag(x, k)``          -- the value exactly k positions back  (k PRECEDING .. k PRECEDING)
* ``hist(agg, x, n)``    -- over the n earlier positions         (n PRECEDING .. 1 PRECEDING)
* ``cur(agg, x, n)``     -- over the n earlier positions and now (n PRECEDING .. CURRENT ROW)

The warm-up gate is global: a look-back of n needs n earlier minutes in the
queue, whether or not the key had rows in them (``gate``).

Features are written as SQL expression text and turned into Columns with one
``F.expr`` each: Catalyst sees the same plan as with the Column API, and plan
construction stays cheap for ~100 windowed expressions.
"""

from __future__ import annotations

SEQ = "minute_seq"


class Frames:
    """Window text for one partitioning (e.g. ``expirDate, block``).

    With a ``sink`` dict, every distinct windowed aggregate is registered once
    under a generated column name and the name is returned instead of the
    text: the pipeline computes the registered aggregates in one projection
    and the features from their names in the next, so an aggregate used twice
    by a formula (a std in a guard and a divisor) is evaluated once.
    """

    def __init__(self, *partition: str, sink: dict | None = None, tag: str = "w"):
        self.partition = ", ".join(f"`{p}`" for p in partition)
        self.spec = f"PARTITION BY {self.partition} ORDER BY {SEQ}"
        self.sink = sink
        self.tag = tag
        self.keys = partition

    def staged(self, sink: dict, tag: str) -> "Frames":
        return Frames(*self.keys, sink=sink, tag=tag)

    def over(self, lo: str, hi: str) -> str:
        return f"OVER ({self.spec} RANGE BETWEEN {lo} AND {hi})"

    def _win(self, text: str) -> str:
        if self.sink is None:
            return text
        name = self.sink.setdefault(text, f"_{self.tag}{len(self.sink)}")
        return f"`{name}`"

    def lag(self, x: str, k: int) -> str:
        return self._win(f"max({x}) {self.over(f'{k} PRECEDING', f'{k} PRECEDING')}")

    def hist(self, agg: str, x: str, n: int) -> str:
        return self._win(f"{agg}({x}) {self.over(f'{n} PRECEDING', '1 PRECEDING')}")

    def cur(self, agg: str, x: str, n: int) -> str:
        return self._win(f"{agg}({x}) {self.over(f'{n} PRECEDING', 'CURRENT ROW')}")

    def span(self, agg: str, x: str, lo: int, hi: int = 0) -> str:
        """Positions s-lo .. s-hi."""
        end = "CURRENT ROW" if hi == 0 else f"{hi} PRECEDING"
        return self._win(f"{agg}({x}) {self.over(f'{lo} PRECEDING', end)}")


def available(window_size: int) -> str:
    """Queue size before the current minute is appended (capacity-limited)."""
    return f"least({SEQ} - 1, {int(window_size)})"


def gate(n: int, window_size: int) -> str:
    return f"({available(window_size)} >= {int(n)})"
