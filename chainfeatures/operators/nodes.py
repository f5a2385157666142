"""Per (minute, expiry) node values: the ATM row and the fixed-offset rows.

Aggregates only (``min_by`` with numeric orderings and numeric values), so
Spark runs them as a code-generated hash aggregate and combines them map-side
before the shuffle: one row per (minute, expiry) and task crosses the
network, not the panel.
"""

from __future__ import annotations

# For whole-number distances: (|distance|, strike to 1e-8) packed into one exact
# DECIMAL(38,0): |d|*1e6 < 1e12 and strike*1e8 < 1e18 for any real chain, so the packed
# value orders rows exactly like the pair, and a decimal (unlike a struct) is
# a mutable aggregation buffer: the aggregate stays hash-based.
ATM_ORDER = ("CASE WHEN distance_to_atm IS NOT NULL AND strike IS NOT NULL THEN "
             "CAST(round(abs(distance_to_atm) * 1000000) AS DECIMAL(38,0)) * CAST(1000000000000000000 AS DECIMAL(38,0))"
             " + CAST(round(strike * 100000000) AS DECIMAL(38,0)) END")


def atm_pick(column: str) -> str:
    """Value of ``column`` in the row with the smallest |distance_to_atm|
    (null distances ignored); ties go to the lowest strike, i.e. the first row
    of a strike-sorted file.  The picked value may itself be null."""
    return f"min_by(`{column}`, {ATM_ORDER})"


def offset_pick(column: str, offset: int) -> str:
    """Value at ``distance_to_atm == offset`` (lowest strike if repeated); null if absent."""
    return f"min_by(`{column}`, CASE WHEN distance_to_atm = {offset} THEN strike END)"


def exact_order(aggregate, integral: bool):
    """The pick as it stands for whole-number distances; for fractional ones the pair itself is
    the order, so that no difference, however small, is rounded to a tie."""
    if integral or not isinstance(aggregate, str):
        return aggregate
    pair = "CASE WHEN distance_to_atm IS NOT NULL AND strike IS NOT NULL THEN struct(abs(distance_to_atm) AS d, strike AS s) END"
    return aggregate.replace(ATM_ORDER, pair)
