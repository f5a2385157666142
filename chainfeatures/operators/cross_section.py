"""Cross-sectional dynamics inside an expiry (9 features), per row."""

from __future__ import annotations

from chainfeatures.plans.registry import Context, FeatureSection

_PCT = (("IVPercentile", "IVPercentile_Expiry"),
        ("VolumePercentile", "VolumePercentile_Expiry"),
        ("OIPercentile", "OIPercentile_Expiry"))


class CrossSection(FeatureSection):
    name = "section_cross_sectional"
    level = "contract"
    lookback = 30
    feature_names = (
        "IVPercentile_Change_L5", "IVPercentile_Change_L15",
        "VolumePercentile_Change_L5", "VolumePercentile_Change_L15",
        "OIPercentile_Change_L5", "OIPercentile_Change_L15",
        "VolumeShare_Expiry", "VolumeShare_ExpirySMA_15", "VolumeShare_ExpirySMA_30",
    )

    def node_aggs(self, ctx: Context):
        return {"_call_volume_total": "sum(CAST(callVolume AS DOUBLE))"}

    def row_inputs(self, ctx: Context):
        # Unrounded share of the expiry's call volume in this minute; null when
        # the expiry total is not positive or the row's own volume is missing.
        return {"_share": "CASE WHEN _call_volume_total > 0 THEN CAST(callVolume AS DOUBLE) / _call_volume_total END"}

    def columns(self, ctx: Context):
        fr = ctx.contract
        out = {}
        for prefix, col in _PCT:
            for k in (5, 15):
                out[f"{prefix}_Change_L{k}"] = f"CASE WHEN {ctx.gate(k)} THEN {col} - {fr.lag(col, k)} END"
        out["VolumeShare_Expiry"] = "_share"
        for n in (15, 30):
            out[f"VolumeShare_ExpirySMA_{n}"] = f"CASE WHEN {ctx.gate(n)} THEN {fr.cur('avg', '_share', n)} END"
        return out
