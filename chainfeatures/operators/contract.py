"""Per-contract short history (22 features), over (expirDate, strike)."""

from __future__ import annotations

from chainfeatures.functions.stats import log_return, zscore_history
from chainfeatures.plans.registry import Context, FeatureSection

LEGS = ("Call", "Put")


def _names(leg: str) -> tuple[str, ...]:
    return (f"{leg}MidReturn_L1", f"{leg}MidReturn_L2", f"{leg}MidReturn_L3",
            f"{leg}MidZ_3", f"{leg}MidZ_5", f"{leg}IVChange_L1", f"{leg}IVZ_3", f"{leg}IVZ_5",
            f"{leg}VolumeZ_3", f"{leg}VolumeZ_5", f"{leg}SpreadPctChange_L1")


class ContractSection(FeatureSection):
    name = "section_contract"
    level = "contract"
    lookback = 5
    feature_names = _names("Call") + _names("Put")

    def columns(self, ctx: Context):
        fr = ctx.contract
        out = {}
        for leg in LEGS:
            mid, iv, sp = f"{leg}Mid", f"{leg}IVMid", f"{leg}SpreadPct"
            vol = f"CAST({leg.lower()}Volume AS DOUBLE)"
            for k in (1, 2, 3):
                out[f"{leg}MidReturn_L{k}"] = f"CASE WHEN {ctx.gate(k)} THEN {log_return(mid, fr.lag(mid, k))} END"
            for n in (3, 5):
                out[f"{leg}MidZ_{n}"] = zscore_history(mid, fr, n, ctx.gate(n))
            out[f"{leg}IVChange_L1"] = f"CASE WHEN {ctx.gate(1)} THEN {iv} - {fr.lag(iv, 1)} END"
            for n in (3, 5):
                out[f"{leg}IVZ_{n}"] = zscore_history(iv, fr, n, ctx.gate(n))
            for n in (3, 5):
                out[f"{leg}VolumeZ_{n}"] = zscore_history(vol, fr, n, ctx.gate(n))
            out[f"{leg}SpreadPctChange_L1"] = f"CASE WHEN {ctx.gate(1)} THEN {sp} - {fr.lag(sp, 1)} END"
        return out
