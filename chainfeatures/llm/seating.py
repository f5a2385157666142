"""Chinese-restaurant seating of many dishes at a time, as NumPy arrays.

A *dish* of a restaurant has ``c`` customers at ``t`` tables.  With discount ``d``, a customer sits at a
table of ``n`` others with weight ``n - d`` and opens a table with weight ``a + b * t``, where ``a`` is
(strength + d * tables of the other dishes) * (parent's probability of the dish) and ``b`` is d * that probability.
"""

from __future__ import annotations

import numpy as np


def seat(c: np.ndarray, a: np.ndarray, b: np.ndarray, d: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Seat ``c`` >= 1 customers of every dish one after the other: (dish of every table, its size), by dish.

    The customers between two openings are not gone through one by one.  In an urn with weights A (open) and
    j - d * t (sit down) the wait for the first opening is geometric in a Beta(A, j - d * t) share, and what later
    customers add to a table against the older ones is binomial in a Beta share: both are exact."""
    n = len(c)
    t, j = np.ones(n, np.int64), np.ones(n, np.int64)
    opened = [(np.arange(n), np.ones(n, np.int64))]  # the k-th entry: dishes with k + 1 tables, and when that one opened
    at = np.flatnonzero(c > 1)
    while len(at):
        share = np.clip(rng.beta(np.maximum(a[at] + b[at] * t[at], 1e-12), j[at] - d * t[at]), 1e-300, 1 - 1e-16)
        when = j[at] + np.floor(np.log(rng.random(len(at)) + 1e-300) / np.log1p(-share)) + 1
        ok = when <= c[at]
        at = at[ok]
        if len(at):
            j[at] = when[ok].astype(np.int64)
            t[at] += 1
            opened.append((at, j[at].copy()))
    left = c.astype(np.int64).copy()
    dish, size = [], []
    for k in range(len(opened) - 1, 0, -1):  # tables from the last one opened to the second
        of, when = opened[k]
        share = rng.beta(1 - d, np.maximum(when - 1 - d * k, 1e-12))
        got = 1 + rng.binomial(left[of] - when, share)
        left[of] -= got
        dish.append(of)
        size.append(got)
    dish, size = np.concatenate([np.arange(n), *dish]), np.concatenate([left, *size])
    order = np.argsort(dish, kind="stable")
    return dish[order], size[order]


def reseat(dish: np.ndarray, size: np.ndarray, c: np.ndarray, a: np.ndarray, b: np.ndarray, d: float,
           rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """One Gibbs step for every dish: a customer drawn at random gets up and sits down again given all others."""
    n = len(c)
    if not n:
        return dish, size
    size = size.copy()
    last = np.cumsum(np.bincount(dish, minlength=n)) - 1  # last table of each dish
    table = np.searchsorted(np.cumsum(size), np.cumsum(c) - c + np.minimum((rng.random(n) * c).astype(np.int64), c - 1), "right")
    size[table] -= 1
    t = np.bincount(dish[size > 0], minlength=n)
    opens, sits = a + b * t, (c - 1) - d * t
    new = (rng.random(n) * (opens + sits) < opens) | (c == 1)
    weight = np.cumsum(np.where(size > 0, size - d, 0.0))
    before = np.concatenate(([0.0], weight[last[:-1]]))
    to = np.searchsorted(weight, before + rng.random(n) * np.maximum(sits, 0), "right")
    to = np.clip(to, np.concatenate(([0], last[:-1] + 1)), last)
    empty = size[table] == 0
    size[to[~new]] += 1
    size[table[new & empty]] = 1
    more = np.flatnonzero(new & ~empty)
    size, dish = np.insert(size, last[more] + 1, 1), np.insert(dish, last[more] + 1, more)
    held = size > 0
    return dish[held], size[held]


def tables(c: np.ndarray, a: np.ndarray, b: np.ndarray, d: float, moves: int, rng: np.random.Generator) -> np.ndarray:
    """Tables of every dish (0 where it has no customers) after seating and ``moves`` Gibbs steps."""
    t = np.zeros(len(c), np.int64)
    on = np.flatnonzero(c > 0)
    c, a, b = c[on].astype(np.int64), a[on], b[on]
    dish, size = seat(c, a, b, d, rng)
    for _ in range(moves):
        dish, size = reseat(dish, size, c, a, b, d, rng)
    t[on] = np.bincount(dish, minlength=len(on))
    return t
