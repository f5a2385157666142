"""ATM node look-back (12 features), one value per (minute, expiry)."""

from __future__ import annotations

from chainfeatures.functions.stats import zscore_with_current
from chainfeatures.operators.nodes import atm_pick
from chainfeatures.plans.registry import Context, FeatureSection

_VALUES = {"iv": "CallIVMid", "sp": "CallSpreadPct", "gm": "CallGamma"}


class AtmSection(FeatureSection):
    name = "section_atm"
    level = "node"
    lookback = 30
    feature_names = (
        "ATM_CallIVChange_L1", "ATM_CallIVChange_L5", "ATM_CallIVChange_L15",
        "ATM_CallIVZ_5", "ATM_CallIVZ_15", "ATM_CallIVZ_30",
        "ATM_CallSpreadPctChange_L1", "ATM_CallSpreadPctChange_L5", "ATM_CallSpreadPctChange_L15",
        "ATM_CallGammaChange_L1", "ATM_CallGammaChange_L5", "ATM_CallGammaChange_L15",
    )

    def node_aggs(self, ctx: Context):
        return {f"_atm_{a}": atm_pick(c) for a, c in _VALUES.items()}

    def columns(self, ctx: Context):
        fr = ctx.node
        out = {}

        def change(v, k):
            return f"CASE WHEN {ctx.gate(k)} AND {v} IS NOT NULL THEN {v} - {fr.lag(v, k)} END"

        for k in (1, 5, 15):
            out[f"ATM_CallIVChange_L{k}"] = change("_atm_iv", k)
        for n in (5, 15, 30):
            out[f"ATM_CallIVZ_{n}"] = zscore_with_current("_atm_iv", fr, n, ctx.gate(n))
        for k in (1, 5, 15):
            out[f"ATM_CallSpreadPctChange_L{k}"] = change("_atm_sp", k)
        for k in (1, 5, 15):
            out[f"ATM_CallGammaChange_L{k}"] = change("_atm_gm", k)
        return {name: out[name] for name in self.feature_names}
