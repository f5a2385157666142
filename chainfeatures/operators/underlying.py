"""Underlying price look-back (15 features), one value per minute.

Computed on the minute spine (one row per minute), then joined to the rows.
"""

from __future__ import annotations

from chainfeatures.functions.frames import SEQ
from chainfeatures.functions.numsum import numpy_sum
from chainfeatures.functions.stats import ema_fold, log_return
from chainfeatures.plans.registry import Context, FeatureSection

P = "stockPrice"


class UnderlyingSection(FeatureSection):
    name = "section_underlying"
    level = "minute"
    lookback = 30
    feature_names = (
        "UnderlyingReturn_L1", "UnderlyingReturn_L5", "UnderlyingReturn_L15",
        "UnderlyingCumReturn_5", "UnderlyingCumReturn_15", "UnderlyingCumReturn_30",
        "UnderlyingSMA_5", "UnderlyingSMA_15", "UnderlyingSMA_30",
        "UnderlyingEMA_5", "UnderlyingEMA_15", "UnderlyingEMA_30",
        "UnderlyingVol_5", "UnderlyingVol_15", "UnderlyingVol_30",
    )

    def row_inputs(self, ctx: Context):
        # One price step per minute: (previous, current).  A step with a
        # non-positive price is skipped; a used step with a missing price
        # poisons the volatility.  Plus the time-sorted price windows.
        fr = ctx.minute
        prev = fr.lag(P, 1)
        skip = f"(coalesce({prev} <= 0, false) OR coalesce({P} <= 0, false))"
        out = {
            "_step_used": f"CASE WHEN {skip} THEN 0 ELSE 1 END",
            "_step_sq": f"CASE WHEN NOT {skip} THEN ln({P} / {prev}) * ln({P} / {prev}) END",
            "_step_bad": f"CASE WHEN NOT {skip} AND ({P} IS NULL OR {prev} IS NULL) THEN 1 ELSE 0 END",
        }
        for n in (5, 15, 30):
            pt = f"named_struct('s', {SEQ}, 'v', {P})"
            out[f"_pts{n}"] = f"array_sort({fr.cur('collect_list', pt, n)})"
        return out

    def columns(self, ctx: Context):
        fr = ctx.minute
        out = {}

        def ret(k):
            return f"CASE WHEN {ctx.gate(k)} THEN {log_return(P, fr.lag(P, k))} END"

        for k in (1, 5, 15):
            out[f"UnderlyingReturn_L{k}"] = ret(k)
        for k in (5, 15, 30):
            out[f"UnderlyingCumReturn_{k}"] = ret(k)
        for n in (5, 15, 30):
            # mean of the n+1 prices, summed in NumPy's order (bit-identical
            # means); any missing price -> null
            total = numpy_sum([f"get(_pts{n}, {i}).v" for i in range(n + 1)], lambda a, b: f"({a} + {b})", "0.0D")
            out[f"UnderlyingSMA_{n}"] = (f"CASE WHEN {ctx.gate(n)} AND {fr.cur('count', P, n)} = {n + 1} "
                                         f"THEN {total} / {n + 1} END")
        for n in (5, 15, 30):
            out[f"UnderlyingEMA_{n}"] = f"CASE WHEN {ctx.gate(n)} THEN {ema_fold(f'_pts{n}', n)} END"
        for n in (5, 15, 30):
            used, bad, sq = (fr.span("sum", c, n - 1) for c in ("_step_used", "_step_bad", "_step_sq"))
            out[f"UnderlyingVol_{n}"] = f"CASE WHEN {ctx.gate(n)} AND {bad} = 0 AND {used} > 0 THEN sqrt({sq}) END"
        return out
