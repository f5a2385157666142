"""Engine vs the queue simulator on a hand-made panel full of edge cases:
overnight gap, expiry appearing mid-day, contract absent exactly k minutes
back, all-null distances, missing ATM row (-1/+1 tie), zero total volume,
flat series, NaN inputs, null IV at an offset with a valid spread, zero price,
fewer than N earlier minutes."""

import functools

import numpy as np
import pandas as pd
import pytest

from chainfeatures.config import FeatureParams
from chainfeatures.plans.pipeline import compute_features
from chainfeatures.plans.registry import create_default_registry

from queue_sim import simulate

STAMPS = ([202503241530 + m for m in range(0, 30)] + [202503250930 + m for m in range(0, 20)])


def _panel(seed=7):
    rng = np.random.default_rng(seed)
    minutes = []
    for i, ts in enumerate(STAMPS):
        rows = []
        exps = ["2025-03-28"] + (["2025-04-04"] if i >= 9 else [])
        price = 0.0 if i == 13 else round(590 + rng.normal() * 2, 4)
        for e in exps:
            for k, strike in enumerate([588.0, 589.0, 590.0, 591.0, 592.0]):
                if e == "2025-03-28" and strike == 589.0 and i % 7 == 5:
                    continue  # contract absent in some minutes
                dist = k - 2
                if e == "2025-03-28" and i in (4, 22) and dist == 0:
                    continue  # no exact ATM row: -1/+1 tie
                rows.append(dict(
                    timestamp_int=ts, expirDate=e, strike=strike,
                    distance_to_atm=float("nan") if (e == "2025-04-04" and i == 15) else float(dist),
                    stockPrice=price,
                    CallMid=float("nan") if (i == 11 and k == 1) else round(abs(rng.normal(3, 1)), 5),
                    PutMid=round(abs(rng.normal(3, 1)), 5) if i != 17 else 0.0,
                    CallIVMid=float("nan") if (i == 25 and dist == 1) else round(0.2 + rng.random() / 10, 6),
                    PutIVMid=round(0.2 + rng.random() / 10, 6),
                    CallSpreadPct=round(rng.random() / 20, 4),
                    PutSpreadPct=float("nan") if i % 5 == 0 else round(rng.random() / 20, 4),
                    CallGamma=round(rng.random() / 50, 5),
                    callVolume=0.0 if (e == "2025-04-04" and i == 12) else float(rng.integers(0, 50)),
                    putVolume=7.0,
                    IVPercentile_Expiry=round(rng.random(), 4), VolumePercentile_Expiry=round(rng.random(), 4),
                    OIPercentile_Expiry=round(rng.random(), 4)))
        minutes.append(pd.DataFrame(rows))
    return minutes


@functools.lru_cache(maxsize=None)
def _expected():
    return simulate(_panel())


@pytest.mark.parametrize("block", [None, 40])
def test_engine_matches_simulator(spark, block):
    minutes = _panel()
    expected = _expected()
    pdf = pd.concat(minutes, ignore_index=True)
    df = spark.createDataFrame(pdf)
    params = FeatureParams(block_minutes=block)
    got = compute_features(df, params=params).toPandas()
    feats = create_default_registry().get_active_features()
    key = ["timestamp_int", "expirDate", "strike"]
    m = got[key + feats].merge(expected[key + feats], on=key, suffixes=("", "_sim"))
    assert len(m) == len(got) == len(expected)
    bad = []
    for f in feats:
        a, b = m[f].astype(float).values, m[f + "_sim"].astype(float).values
        same_null = np.isnan(a) == np.isnan(b)
        close = np.isnan(a) | np.isnan(b) | (np.abs(a - b) <= 1.000001e-4)
        if not (same_null.all() and close.all()):
            bad.append((f, int((~same_null).sum()), int((~close).sum())))
    assert not bad, bad


@pytest.mark.parametrize("history", [60, 8])
def test_live_minute_matches_simulator(spark, history):
    """run_live: the newest minute against its preloaded history only (the
    newest ``history`` earlier minutes within 5 days) = a fresh queue holding
    exactly those minutes."""
    from chainfeatures.plans.jobs import run_live

    minutes = _panel()
    expected = simulate(minutes[-(history + 1):] if history < len(minutes) else minutes)
    last = minutes[-1]["timestamp_int"].iloc[0]
    expected = expected[expected["timestamp_int"] == last]
    df = spark.createDataFrame(pd.concat(minutes, ignore_index=True))
    rows, meta = run_live(df, int(last), history_minutes=history)
    got = rows.toPandas()
    feats = create_default_registry().get_active_features()
    key = ["timestamp_int", "expirDate", "strike"]
    m = got[key + feats].merge(expected[key + feats], on=key, suffixes=("", "_sim"))
    assert len(m) == len(expected) > 0
    for f in feats:
        a, b = m[f].astype(float).values, m[f + "_sim"].astype(float).values
        assert ((np.isnan(a) & np.isnan(b)) | (np.abs(a - b) <= 1.000001e-4)).all(), f
    md = meta.first()
    assert md["history_minutes_loaded"] == min(history, len(minutes) - 1) + 1
    assert md["feature_version_hash"] == "0613f3add0197063" and md["row_count"] == len(expected)
