"""Second oracle: every feature straight from SURVEY S1-S8, one value at a time.

The panel is turned into look-up tables keyed by minute position, ``{key: {position:
value}}``, and each feature is a formula over positions ``s - k``.  No frames are
merged or grouped per minute; sums are plain Python (``math.fsum``).  Slow, and used on
hand-made panels only.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd

OFFSETS = (-2, -1, 0, 1, 2)
INPUTS = ("CallMid", "CallIVMid", "CallSpreadPct", "callVolume", "PutMid", "PutIVMid", "PutSpreadPct", "putVolume", "CallGamma",
          "IVPercentile_Expiry", "VolumePercentile_Expiry", "OIPercentile_Expiry", "distance_to_atm", "stockPrice")


def _value(x):
    """A float, or None for anything missing."""
    return None if x is None or x != x else float(x)


def _minus(a, b):
    return None if a is None or b is None else a - b


def _log_ratio(a, b):
    return math.log(a / b) if a is not None and b is not None and a > 0 and b > 0 else None


def _mean(v):
    return math.fsum(v) / len(v)


def _spread(v):
    """Sample standard deviation; None for fewer than two values."""
    if len(v) < 2:
        return None
    m = _mean(v)
    return math.sqrt(math.fsum((x - m) ** 2 for x in v) / (len(v) - 1))


class Panel:
    """Look-up tables of a panel: contract values, expiry nodes, prices, shares."""

    def __init__(self, minutes):
        self.contract = {c: defaultdict(dict) for c in INPUTS}
        self.rows = []
        self.price = {}
        self.atm = defaultdict(dict)
        self.node = defaultdict(dict)
        self.share = defaultdict(dict)
        for s, frame in enumerate(minutes, 1):
            mine = [{c: r[c] if c in ("timestamp_int", "expirDate", "strike") else _value(r[c]) for c in ("timestamp_int", "expirDate", "strike", *INPUTS)}
                    for r in frame.to_dict("records")]
            self.price[s] = mine[0]["stockPrice"]
            volume = defaultdict(list)
            for r in mine:
                key = (r["expirDate"], r["strike"])
                self.rows.append((s, r["timestamp_int"], key))
                for c in INPUTS:
                    self.contract[c][key][s] = r[c]
                volume[key[0]].append(r["callVolume"] or 0.0)
            for r in sorted(mine, key=lambda r: r["strike"]):  # lowest strike wins ties
                e, d = r["expirDate"], r["distance_to_atm"]
                total = math.fsum(volume[e])
                if total > 0:
                    self.share[e, r["strike"]][s] = None if r["callVolume"] is None else r["callVolume"] / total
                if d is None:
                    continue
                best = self.atm[e].get(s)
                if best is None or abs(d) < abs(best["distance_to_atm"]):
                    self.atm[e][s] = r
                if d in OFFSETS:
                    self.node[e, int(d)].setdefault(s, r)


def _series(table, column):
    return {s: r[column] for s, r in table.items()}


def _z_with_current(series, s, n, queue):
    """Current value against the last n minutes and itself (S4)."""
    if queue < n or series.get(s) is None:
        return None
    seen = [series[t] for t in range(s - n, s + 1) if series.get(t) is not None]
    sd = _spread(seen)
    return None if sd is None or sd < 1e-6 else (series[s] - _mean(seen)) / sd


def _z_of_history(series, s, n, queue):
    """Current value against the last n minutes without itself (S4)."""
    if queue < n or series.get(s) is None:
        return None
    seen = [series[t] for t in range(s - n, s) if series.get(t) is not None]
    sd = _spread(seen)
    return None if sd is None or not sd > 1e-6 else (series[s] - _mean(seen)) / sd


def _change(series, s, k, queue):
    return _minus(series.get(s), series.get(s - k)) if queue >= k else None


def _underlying(p, s, queue):
    out = {}
    ratio = {k: _log_ratio(p.price[s], p.price[s - k]) if queue >= k else None for k in (1, 5, 15, 30)}
    for k in (1, 5, 15):
        out[f"UnderlyingReturn_L{k}"] = ratio[k]
    for k in (5, 15, 30):
        out[f"UnderlyingCumReturn_{k}"] = ratio[k]
    for n in (5, 15, 30):
        path = [p.price[t] for t in range(s - n, s + 1)] if queue >= n else None
        whole = path is not None and None not in path
        out[f"UnderlyingSMA_{n}"] = _mean(path) if whole else None
        if whole:
            level, weight = path[0], 2 / (n + 1)
            for x in path[1:]:
                level += weight * (x - level)
        out[f"UnderlyingEMA_{n}"] = level if whole else None
        steps = [r for r in map(_log_ratio, path[1:], path)if r is not None] if path else []
        out[f"UnderlyingVol_{n}"] = math.sqrt(math.fsum(r * r for r in steps)) if steps else None
    return out


def _expiry(p, e, s, queue):
    out = {}
    for column, name in (("CallIVMid", "CallIV"), ("CallSpreadPct", "CallSpreadPct"), ("CallGamma", "CallGamma")):
        v = _series(p.atm[e], column)
        for k in (1, 5, 15):
            out[f"ATM_{name}Change_L{k}"] = _change(v, s, k, queue)
    iv = _series(p.atm[e], "CallIVMid")
    for n in (5, 15, 30):
        out[f"ATM_CallIVZ_{n}"] = _z_with_current(iv, s, n, queue)
    at_money = _series(p.node[e, 0], "CallIVMid").get(s)
    for o in OFFSETS:
        iv, spread = _series(p.node[e, o], "CallIVMid"), _series(p.node[e, o], "CallSpreadPct")
        known = iv.get(s) is not None  # without a volatility the offset has no features at all
        for k in (1, 5):
            out[f"IV_offsetChange_{o}_L{k}"] = _change(iv, s, k, queue)
        for n in (5, 15):
            out[f"IV_offsetZ_{o}_{n}"] = _z_with_current(iv, s, n, queue)
            out[f"SpreadPct_offsetZ_{o}_{n}"] = _z_with_current(spread, s, n, queue) if known else None
        out[f"IV_SkewToATM_{o}"] = _minus(iv.get(s), at_money)
    return out


def _contract(p, key, s, queue):
    out = {}
    share = p.share[key]
    out["VolumeShare_Expiry"] = share.get(s)
    for n in (15, 30):
        seen = [share[t] for t in range(s - n, s + 1) if share.get(t) is not None] if queue >= n else []
        out[f"VolumeShare_ExpirySMA_{n}"] = _mean(seen) if seen else None
    for name in ("IV", "Volume", "OI"):
        for k in (5, 15):
            out[f"{name}Percentile_Change_L{k}"] = _change(p.contract[f"{name}Percentile_Expiry"][key], s, k, queue)
    for leg in ("Call", "Put"):
        mid, iv, volume = (p.contract[c][key] for c in (f"{leg}Mid", f"{leg}IVMid", f"{leg.lower()}Volume"))
        for k in (1, 2, 3):
            out[f"{leg}MidReturn_L{k}"] = _log_ratio(mid.get(s), mid.get(s - k)) if queue >= k else None
        out[f"{leg}IVChange_L1"] = _change(iv, s, 1, queue)
        out[f"{leg}SpreadPctChange_L1"] = _change(p.contract[f"{leg}SpreadPct"][key], s, 1, queue)
        for n in (3, 5):
            for name, series in (("Mid", mid), ("IV", iv), ("Volume", volume)):
                out[f"{leg}{name}Z_{n}"] = _z_of_history(series, s, n, queue)
    return out


def _feature_names():
    p = Panel([pd.DataFrame([{c: 1.0 for c in ("timestamp_int", "expirDate", "strike", *INPUTS)}])])
    return [*_underlying(p, 1, 0), *_expiry(p, 1.0, 1, 0), *_contract(p, (1.0, 1.0), 1, 0)]


ALL_FEATURES = _feature_names()


def simulate(minutes: list[pd.DataFrame], window_size: int = 300) -> pd.DataFrame:
    """minutes: per-minute frames in time order (each with timestamp_int)."""
    p = Panel(minutes)
    per_minute, per_expiry, out = {}, {}, []
    for s, stamp, key in p.rows:
        queue = min(s - 1, window_size)
        if s not in per_minute:
            per_minute[s] = _underlying(p, s, queue)
        if (s, key[0]) not in per_expiry:
            per_expiry[s, key[0]] = _expiry(p, key[0], s, queue)
        out.append({"timestamp_int": stamp, "expirDate": key[0], "strike": key[1], **per_minute[s], **per_expiry[s, key[0]], **_contract(p, key, s, queue)})
    frame = pd.DataFrame(out)
    for c in ALL_FEATURES:
        frame[c] = np.round(np.round(frame[c].astype(float), 4), 4)
    return frame
