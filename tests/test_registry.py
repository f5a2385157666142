"""Feature registry: names, section counts, version hash, plug-in sections."""

import pytest
from pyspark.sql import functions as F

from chainfeatures.config import DEFAULT_FEATURE_HASH
from chainfeatures.plans.pipeline import compute_features
from chainfeatures.plans.registry import FeatureSection, HistorySection, create_default_registry, version_hash


def test_counts_and_hash():
    reg = create_default_registry()
    feats = reg.get_active_features()
    assert len(feats) == 93 and len(set(feats)) == 93
    counts = {n: len(s.feature_names) for n, s in reg.active_sections()}
    assert counts == {"section_atm": 12, "section_contract": 22, "section_cross_sectional": 9,
                      "section_offset": 35, "section_underlying": 15}
    assert reg.compute_version_hash() == DEFAULT_FEATURE_HASH == "0613f3add0197063"
    assert version_hash(list(reversed(feats))) == DEFAULT_FEATURE_HASH


def test_enable_disable():
    reg = create_default_registry()
    with pytest.raises(ValueError):
        reg.enable_section("section_missing")
    reg.disable_section("section_offset")
    assert len(reg.get_active_features()) == 58
    assert reg.compute_version_hash() != DEFAULT_FEATURE_HASH


class SpreadGap(FeatureSection):
    """A user section: call minus put spread, and its 2-minute change."""
    name = "section_spread_gap"
    level = "contract"
    lookback = 2
    feature_names = ("SpreadGap", "SpreadGapChange_L2")

    def columns(self, ctx):
        gap = "(CallSpreadPct - PutSpreadPct)"
        return {"SpreadGap": gap,
                "SpreadGapChange_L2": f"CASE WHEN {ctx.gate(2)} THEN {gap} - {ctx.contract.lag(gap, 2)} END"}


def test_plugin_section(spark):
    from chainfeatures.sources.chain import derived_chain

    reg = create_default_registry()
    for n in list(reg.enabled):
        reg.disable_section(n)
    reg.register_section("section_spread_gap", SpreadGap()).enable_section("section_spread_gap")
    out = compute_features(derived_chain(spark, "/root/testdata/sf0.001"), registry=reg)
    assert out.columns[-2:] == ["SpreadGap", "SpreadGapChange_L2"]
    assert out.filter(F.col("SpreadGapChange_L2").isNotNull()).count() > 0


class Wrong(FeatureSection):
    name = "section_wrong"
    level = "contract"
    lookback = 1
    feature_names = ("A", "B")

    def columns(self, ctx):
        return {"A": "1.0D"}


def test_plugin_must_add_declared_names(spark):
    from chainfeatures.sources.chain import derived_chain

    reg = create_default_registry().register_section("section_wrong", Wrong()).enable_section("section_wrong")
    with pytest.raises(ValueError, match="declares"):
        compute_features(derived_chain(spark, "/root/testdata/sf0.001"), registry=reg)


def test_history_section_equals_brute_force(spark):
    """A section that sorts its history, over blocks of several sizes, next to an ordinary section."""
    from chainfeatures.config import FeatureParams
    from chainfeatures.plans.catalog import MedianMid, registry_with
    from chainfeatures.sources.chain import derived_chain

    chain = derived_chain(spark, "/root/testdata/sf0.001")
    minutes = sorted(r[0] for r in chain.select("timestamp_int").distinct().collect())[:90]
    chain = chain.filter(F.col("timestamp_int").isin(minutes))
    rows = {(r["timestamp_int"], r["expirDate"], r["strike"]): r["CallMid"] for r in chain.collect()}
    want = {}
    for (t, e, k), _ in rows.items():
        s = minutes.index(t)
        seen = sorted(x for m in minutes[max(0, s - 5):s + 1] if (x := rows.get((m, e, k))) is not None)
        want[t, e, k] = seen[(len(seen) - 1) // 2] if s >= 5 and seen else None
    for block in (16, 1024):
        reg = registry_with({"section_contract"}).register_section("section_median_mid", MedianMid()).enable_section("section_median_mid")
        out = compute_features(chain, registry=reg, params=FeatureParams(block_minutes=block))
        got = {(r["timestamp_int"], r["expirDate"], r["strike"]): r["CallMidMedian_5"] for r in out.collect()}
        assert got.keys() == want.keys() and all((got[k] is None) == (v is None) and (v is None or abs(got[k] - v) < 5.1e-5) for k, v in want.items())
        assert out.filter(F.col("CallMidReturn_L1").isNotNull()).count() > 0


class Short(HistorySection):
    name, inputs, feature_names = "section_short", ("CallMid",), ("A", "B")

    def history(self, rows, params):
        return rows[["CallMid"]].rename(columns={"CallMid": "A"})


def test_history_section_must_give_declared_names(spark):
    from chainfeatures.plans.catalog import registry_with
    from chainfeatures.sources.chain import derived_chain

    reg = registry_with(set()).register_section("section_short", Short()).enable_section("section_short")
    with pytest.raises(Exception, match="declares"):
        compute_features(derived_chain(spark, "/root/testdata/sf0.001"), registry=reg).collect()
