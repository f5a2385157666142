"""Relative-moneyness nodes (35 features): offsets -2..2 from the ATM step.

An offset absent from the current minute (or with a missing CallIVMid) gets
no features at all; its spread z-score is null then too.
"""

from __future__ import annotations

from chainfeatures.config import OFFSETS
from chainfeatures.functions.stats import zscore_with_current
from chainfeatures.operators.nodes import offset_pick
from chainfeatures.plans.registry import Context, FeatureSection


def offset_tag(o: int) -> str:
    return f"m{-o}" if o < 0 else f"p{o}"


class OffsetSection(FeatureSection):
    name = "section_offset"
    level = "node"
    lookback = 15
    feature_names = tuple(
        name
        for o in OFFSETS
        for name in (f"IV_offsetChange_{o}_L1", f"IV_offsetChange_{o}_L5",
                     f"IV_offsetZ_{o}_5", f"IV_offsetZ_{o}_15", f"IV_SkewToATM_{o}",
                     f"SpreadPct_offsetZ_{o}_5", f"SpreadPct_offsetZ_{o}_15"))

    def node_aggs(self, ctx: Context):
        aggs = {}
        for o in OFFSETS:
            aggs[f"_iv_{offset_tag(o)}"] = offset_pick("CallIVMid", o)
            aggs[f"_sp_{offset_tag(o)}"] = offset_pick("CallSpreadPct", o)
        return aggs

    def columns(self, ctx: Context):
        fr = ctx.node
        atm_iv = f"_iv_{offset_tag(0)}"
        out = {}
        for o in OFFSETS:
            iv, sp = f"_iv_{offset_tag(o)}", f"_sp_{offset_tag(o)}"

            def present(e):
                return f"CASE WHEN {iv} IS NOT NULL THEN {e} END"

            for k in (1, 5):
                out[f"IV_offsetChange_{o}_L{k}"] = present(f"CASE WHEN {ctx.gate(k)} THEN {iv} - {fr.lag(iv, k)} END")
            for n in (5, 15):
                out[f"IV_offsetZ_{o}_{n}"] = present(zscore_with_current(iv, fr, n, ctx.gate(n)))
            out[f"IV_SkewToATM_{o}"] = present(f"{iv} - {atm_iv}")
            for n in (5, 15):
                out[f"SpreadPct_offsetZ_{o}_{n}"] = present(zscore_with_current(sp, fr, n, ctx.gate(n)))
        return out
