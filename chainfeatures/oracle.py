"""Independent SQL formulations of the operators, for the DuckDB cross-check.

These are NOT how the engine computes: look-backs are written as self-joins
on ``minute_seq = s - k`` and range joins on ``minute_seq BETWEEN s - n AND
s - 1`` over the derived chain, nodes are picked with ``row_number``.  Every
string is plain SQL over the registered test tables.
"""

from __future__ import annotations

from chainfeatures.config import DEFAULT_FEATURE_HASH, OFFSETS

# -- shared CTEs ---------------------------------------------------------------

CHAIN_CTE = """
day_price AS (
  SELECT l_shipdate,
         CASE WHEN day(l_shipdate) = 13 THEN 0.0 ELSE max(l_extendedprice) / 100 END AS stockPrice
  FROM lineitem GROUP BY l_shipdate),
cells AS (
  SELECT l_shipdate, l_returnflag, l_linenumber,
         CASE WHEN max(l_tax) = 0 THEN 0.0 ELSE max(l_extendedprice) / 1000 END AS CallMid,
         min(l_extendedprice) / 1000 AS PutMid,
         max(l_extendedprice) / max(l_quantity) / 10000 AS CallIVMid,
         min(l_extendedprice) / max(l_quantity) / 10000 AS PutIVMid,
         nullif(max(l_discount), 0) AS CallSpreadPct,
         nullif(min(l_discount), 0) AS PutSpreadPct,
         max(l_tax) AS CallGamma,
         CAST(sum(l_quantity) AS DOUBLE) AS callVolume,
         CAST(count(*) AS DOUBLE) AS putVolume,
         CAST(sum(l_partkey % 100) AS BIGINT) AS oi_raw
  FROM lineitem GROUP BY l_shipdate, l_returnflag, l_linenumber),
chain AS (
  SELECT CAST(strftime(c.l_shipdate, '%Y%m%d%H%M') AS BIGINT) AS timestamp_int,
         strftime(c.l_shipdate, '%Y%m%d') AS date,
         strftime(c.l_shipdate, '%H%M') AS minute,
         c.l_returnflag AS expirDate,
         CAST(c.l_linenumber AS DOUBLE) AS strike,
         c.l_linenumber - 4 AS distance_to_atm,
         d.stockPrice, c.CallMid, c.PutMid, c.CallIVMid, c.PutIVMid, c.CallSpreadPct, c.PutSpreadPct,
         c.CallGamma, c.callVolume, c.putVolume,
         percent_rank() OVER (PARTITION BY c.l_shipdate, c.l_returnflag ORDER BY c.CallIVMid) AS IVPercentile_Expiry,
         percent_rank() OVER (PARTITION BY c.l_shipdate, c.l_returnflag ORDER BY c.callVolume) AS VolumePercentile_Expiry,
         percent_rank() OVER (PARTITION BY c.l_shipdate, c.l_returnflag ORDER BY c.oi_raw) AS OIPercentile_Expiry
  FROM cells c JOIN day_price d USING (l_shipdate)),
spine AS (
  SELECT timestamp_int, stockPrice, row_number() OVER (ORDER BY timestamp_int) AS minute_seq
  FROM (SELECT timestamp_int, min(stockPrice) AS stockPrice FROM chain GROUP BY timestamp_int)),
p AS (SELECT c.*, s.minute_seq FROM chain c JOIN spine s USING (timestamp_int))"""

CHAIN_COLUMNS = (
    "timestamp_int", "date", "minute", "expirDate", "strike", "distance_to_atm", "stockPrice",
    "CallMid", "PutMid", "CallIVMid", "PutIVMid", "CallSpreadPct", "PutSpreadPct", "CallGamma",
    "callVolume", "putVolume", "IVPercentile_Expiry", "VolumePercentile_Expiry", "OIPercentile_Expiry",
)
DOUBLE_INPUTS = tuple(c for c in CHAIN_COLUMNS
                      if c not in ("timestamp_int", "date", "minute", "expirDate", "distance_to_atm"))


def r4(expr: str, d: int = 4) -> str:
    """Half-even rounding to d places, the same two IEEE operations as NumPy."""
    return f"(round_even(({expr}) * {float(10 ** d)}, 0) / {float(10 ** d)} + 0.0)"


def q(name: str) -> str:
    return f'"{name}"'


def with_chain(body: str, extra_ctes: str = "") -> str:
    ctes = CHAIN_CTE + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


def gate(alias: str, n: int) -> str:
    return f"(least({alias}.minute_seq - 1, 300) >= {n})"


# -- nodes ------------------------------------------------------------------------

ATM_NODE_CTE = """
atm AS (
  SELECT expirDate, minute_seq, timestamp_int, CallIVMid AS iv, CallSpreadPct AS sp, CallGamma AS gm
  FROM (SELECT p.*, row_number() OVER (PARTITION BY minute_seq, expirDate
                                       ORDER BY abs(distance_to_atm), strike) AS rn
        FROM p WHERE distance_to_atm IS NOT NULL)
  WHERE rn = 1)"""


def _offset_node_cte() -> str:
    cols = []
    for o in OFFSETS:
        t = _tag(o)
        cols.append(f"max(CASE WHEN distance_to_atm = {o} THEN CallIVMid END) AS iv_{t}")
        cols.append(f"max(CASE WHEN distance_to_atm = {o} THEN CallSpreadPct END) AS sp_{t}")
    return f"""
off_first AS (
  SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY minute_seq, expirDate, distance_to_atm
                                                ORDER BY strike) AS rn FROM p) WHERE rn = 1),
offn AS (
  SELECT minute_seq, expirDate, {', '.join(cols)}
  FROM off_first GROUP BY minute_seq, expirDate)"""


def _tag(o: int) -> str:
    return f"m{-o}" if o < 0 else f"p{o}"


# -- per-family SQL ------------------------------------------------------------------

def contract_sql(features=None, raw: bool = False):
    legs = ("Call", "Put")
    zparts, sel = [], []
    for leg in legs:
        vol = f"{leg.lower()}Volume"
        for n in (3, 5):
            for col, tag in ((f"{leg}Mid", "mid"), (f"{leg}IVMid", "iv"), (vol, "vol")):
                zparts.append(f"avg(h.{col}) FILTER (WHERE h.minute_seq >= c.minute_seq - {n}) AS {leg}_{tag}_m{n}")
                zparts.append(f"stddev_samp(h.{col}) FILTER (WHERE h.minute_seq >= c.minute_seq - {n}) AS {leg}_{tag}_s{n}")
    zcte = f"""
zc AS (
  SELECT c.timestamp_int, c.expirDate, c.strike, {', '.join(zparts)}
  FROM p c LEFT JOIN p h ON h.expirDate = c.expirDate AND h.strike = c.strike
       AND h.minute_seq BETWEEN c.minute_seq - 5 AND c.minute_seq - 1
  GROUP BY c.timestamp_int, c.expirDate, c.strike)"""
    for leg in legs:
        mid, iv, sp, vol = f"{leg}Mid", f"{leg}IVMid", f"{leg}SpreadPct", f"{leg.lower()}Volume"
        for k in (1, 2, 3):
            sel.append((f"{leg}MidReturn_L{k}",
                        f"CASE WHEN {gate('c', k)} AND c.{mid} > 0 AND l{k}.{mid} > 0 THEN ln(c.{mid} / l{k}.{mid}) END"))
        for n in (3, 5):
            sel.append((f"{leg}MidZ_{n}",
                        f"CASE WHEN {gate('c', n)} AND z.{leg}_mid_s{n} > 1e-6 THEN (c.{mid} - z.{leg}_mid_m{n}) / z.{leg}_mid_s{n} END"))
        sel.append((f"{leg}IVChange_L1", f"CASE WHEN {gate('c', 1)} THEN c.{iv} - l1.{iv} END"))
        for n in (3, 5):
            sel.append((f"{leg}IVZ_{n}",
                        f"CASE WHEN {gate('c', n)} AND z.{leg}_iv_s{n} > 1e-6 THEN (c.{iv} - z.{leg}_iv_m{n}) / z.{leg}_iv_s{n} END"))
        for n in (3, 5):
            sel.append((f"{leg}VolumeZ_{n}",
                        f"CASE WHEN {gate('c', n)} AND z.{leg}_vol_s{n} > 1e-6 THEN (c.{vol} - z.{leg}_vol_m{n}) / z.{leg}_vol_s{n} END"))
        sel.append((f"{leg}SpreadPctChange_L1", f"CASE WHEN {gate('c', 1)} THEN c.{sp} - l1.{sp} END"))
    if features is not None:
        sel = [s for s in sel if s[0] in features]
    body = f"""SELECT c.timestamp_int, c.expirDate, c.strike,
  {', '.join(f'{r4(e)} AS {q(n)}' for n, e in sel)}
FROM p c
LEFT JOIN p l1 ON l1.expirDate = c.expirDate AND l1.strike = c.strike AND l1.minute_seq = c.minute_seq - 1
LEFT JOIN p l2 ON l2.expirDate = c.expirDate AND l2.strike = c.strike AND l2.minute_seq = c.minute_seq - 2
LEFT JOIN p l3 ON l3.expirDate = c.expirDate AND l3.strike = c.strike AND l3.minute_seq = c.minute_seq - 3
JOIN zc z ON z.timestamp_int = c.timestamp_int AND z.expirDate = c.expirDate AND z.strike = c.strike"""
    return (zcte, body) if raw else with_chain(body, zcte)


CONTRACT_FAMILIES = {
    "contract_mid_return": ("CallMidReturn_L1", "CallMidReturn_L2", "CallMidReturn_L3",
                            "PutMidReturn_L1", "PutMidReturn_L2", "PutMidReturn_L3"),
    "contract_iv_change": ("CallIVChange_L1", "PutIVChange_L1"),
    "contract_spread_change": ("CallSpreadPctChange_L1", "PutSpreadPctChange_L1"),
    "contract_mid_zscore": ("CallMidZ_3", "CallMidZ_5", "PutMidZ_3", "PutMidZ_5"),
    "contract_iv_zscore": ("CallIVZ_3", "CallIVZ_5", "PutIVZ_3", "PutIVZ_5"),
    "contract_volume_zscore": ("CallVolumeZ_3", "CallVolumeZ_5", "PutVolumeZ_3", "PutVolumeZ_5"),
}


def cross_sql(features=None, raw: bool = False):
    extra = """
tot AS (SELECT minute_seq, expirDate, sum(callVolume) AS total FROM p GROUP BY minute_seq, expirDate),
sh AS (SELECT p.*, CASE WHEN t.total > 0 THEN p.callVolume / t.total END AS share
       FROM p JOIN tot t USING (minute_seq, expirDate)),
sma AS (
  SELECT c.timestamp_int, c.expirDate, c.strike,
         avg(h.share) FILTER (WHERE h.minute_seq >= c.minute_seq - 15) AS sma15,
         avg(h.share) AS sma30
  FROM sh c LEFT JOIN sh h ON h.expirDate = c.expirDate AND h.strike = c.strike
       AND h.minute_seq BETWEEN c.minute_seq - 30 AND c.minute_seq
  GROUP BY c.timestamp_int, c.expirDate, c.strike)"""
    sel = []
    for prefix, col in (("IVPercentile", "IVPercentile_Expiry"), ("VolumePercentile", "VolumePercentile_Expiry"),
                        ("OIPercentile", "OIPercentile_Expiry")):
        for k in (5, 15):
            sel.append((f"{prefix}_Change_L{k}", f"CASE WHEN {gate('c', k)} THEN c.{col} - l{k}.{col} END"))
    sel.append(("VolumeShare_Expiry", "c.share"))
    sel.append(("VolumeShare_ExpirySMA_15", f"CASE WHEN {gate('c', 15)} THEN m.sma15 END"))
    sel.append(("VolumeShare_ExpirySMA_30", f"CASE WHEN {gate('c', 30)} THEN m.sma30 END"))
    if features is not None:
        sel = [s for s in sel if s[0] in features]
    body = f"""SELECT c.timestamp_int, c.expirDate, c.strike,
  {', '.join(f'{r4(e)} AS {q(n)}' for n, e in sel)}
FROM sh c
LEFT JOIN sh l5 ON l5.expirDate = c.expirDate AND l5.strike = c.strike AND l5.minute_seq = c.minute_seq - 5
LEFT JOIN sh l15 ON l15.expirDate = c.expirDate AND l15.strike = c.strike AND l15.minute_seq = c.minute_seq - 15
JOIN sma m ON m.timestamp_int = c.timestamp_int AND m.expirDate = c.expirDate AND m.strike = c.strike"""
    return (extra, body) if raw else with_chain(body, extra)


CROSS_FAMILIES = {
    "volume_share": ("VolumeShare_Expiry",),
    "percentile_change": ("IVPercentile_Change_L5", "IVPercentile_Change_L15", "VolumePercentile_Change_L5",
                          "VolumePercentile_Change_L15", "OIPercentile_Change_L5", "OIPercentile_Change_L15"),
    "volume_share_sma": ("VolumeShare_ExpirySMA_15", "VolumeShare_ExpirySMA_30"),
}


def _zinc(cur: str, m: str, s: str, cnt: str, n: int, alias: str = "c") -> str:
    return (f"CASE WHEN {gate(alias, n)} AND {cur} IS NOT NULL AND {cnt} >= 2 AND {s} >= 1e-6 "
            f"THEN ({cur} - {m}) / {s} END")


def atm_sql(features=None, per_row: bool = True, raw: bool = False):
    zparts = []
    for n in (5, 15, 30):
        flt = f"FILTER (WHERE h.minute_seq >= c.minute_seq - {n})"
        zparts += [f"avg(h.iv) {flt} AS m{n}", f"stddev_samp(h.iv) {flt} AS s{n}", f"count(h.iv) {flt} AS n{n}"]
    extra = ATM_NODE_CTE + f""",
az AS (
  SELECT c.minute_seq, c.expirDate, {', '.join(zparts)}
  FROM atm c JOIN atm h ON h.expirDate = c.expirDate
       AND h.minute_seq BETWEEN c.minute_seq - 30 AND c.minute_seq
  GROUP BY c.minute_seq, c.expirDate)"""
    sel = []
    for col, name in (("iv", "CallIV"), ("sp", "CallSpreadPct"), ("gm", "CallGamma")):
        for k in (1, 5, 15):
            sel.append((f"ATM_{name}Change_L{k}",
                        f"CASE WHEN {gate('c', k)} AND c.{col} IS NOT NULL THEN c.{col} - l{k}.{col} END"))
    for n in (5, 15, 30):
        sel.append((f"ATM_CallIVZ_{n}", _zinc("c.iv", f"z.m{n}", f"z.s{n}", f"z.n{n}", n)))
    order = ("ATM_CallIVChange_L1", "ATM_CallIVChange_L5", "ATM_CallIVChange_L15", "ATM_CallIVZ_5",
             "ATM_CallIVZ_15", "ATM_CallIVZ_30", "ATM_CallSpreadPctChange_L1", "ATM_CallSpreadPctChange_L5",
             "ATM_CallSpreadPctChange_L15", "ATM_CallGammaChange_L1", "ATM_CallGammaChange_L5",
             "ATM_CallGammaChange_L15")
    d = dict(sel)
    names = [n for n in order if features is None or n in features]
    node = f"""SELECT c.minute_seq, c.expirDate, {', '.join(f'{d[n]} AS {q(n)}' for n in names)}
FROM atm c
LEFT JOIN atm l1 ON l1.expirDate = c.expirDate AND l1.minute_seq = c.minute_seq - 1
LEFT JOIN atm l5 ON l5.expirDate = c.expirDate AND l5.minute_seq = c.minute_seq - 5
LEFT JOIN atm l15 ON l15.expirDate = c.expirDate AND l15.minute_seq = c.minute_seq - 15
JOIN az z ON z.expirDate = c.expirDate AND z.minute_seq = c.minute_seq"""
    if not per_row:
        return with_chain(node, extra)
    body = f"""SELECT p.timestamp_int, p.expirDate, p.strike, {', '.join(f'{r4("f." + q(n))} AS {q(n)}' for n in names)}
FROM p LEFT JOIN ({node}) f ON f.expirDate = p.expirDate AND f.minute_seq = p.minute_seq"""
    return (extra, body) if raw else with_chain(body, extra)


def offset_names(o: int) -> tuple[str, ...]:
    return (f"IV_offsetChange_{o}_L1", f"IV_offsetChange_{o}_L5", f"IV_offsetZ_{o}_5", f"IV_offsetZ_{o}_15",
            f"IV_SkewToATM_{o}", f"SpreadPct_offsetZ_{o}_5", f"SpreadPct_offsetZ_{o}_15")


def offset_sql(features=None, raw: bool = False):
    zparts = []
    for o in OFFSETS:
        t = _tag(o)
        for n in (5, 15):
            flt = f"FILTER (WHERE h.minute_seq >= c.minute_seq - {n})"
            for v in ("iv", "sp"):
                zparts += [f"avg(h.{v}_{t}) {flt} AS {v}_{t}_m{n}", f"stddev_samp(h.{v}_{t}) {flt} AS {v}_{t}_s{n}",
                           f"count(h.{v}_{t}) {flt} AS {v}_{t}_n{n}"]
    extra = _offset_node_cte() + f""",
oz AS (
  SELECT c.minute_seq, c.expirDate, {', '.join(zparts)}
  FROM offn c JOIN offn h ON h.expirDate = c.expirDate
       AND h.minute_seq BETWEEN c.minute_seq - 15 AND c.minute_seq
  GROUP BY c.minute_seq, c.expirDate)"""
    sel = []
    for o in OFFSETS:
        t = _tag(o)
        iv, sp = f"c.iv_{t}", f"c.sp_{t}"
        pres = f"{iv} IS NOT NULL"
        sel.append((f"IV_offsetChange_{o}_L1", f"CASE WHEN {pres} AND {gate('c', 1)} THEN {iv} - l1.iv_{t} END"))
        sel.append((f"IV_offsetChange_{o}_L5", f"CASE WHEN {pres} AND {gate('c', 5)} THEN {iv} - l5.iv_{t} END"))
        for n in (5, 15):
            sel.append((f"IV_offsetZ_{o}_{n}",
                        _zinc(iv, f"z.iv_{t}_m{n}", f"z.iv_{t}_s{n}", f"z.iv_{t}_n{n}", n)))
        sel.append((f"IV_SkewToATM_{o}", f"CASE WHEN {pres} THEN {iv} - c.iv_p0 END"))
        for n in (5, 15):
            sel.append((f"SpreadPct_offsetZ_{o}_{n}",
                        f"CASE WHEN {pres} THEN " + _zinc(sp, f"z.sp_{t}_m{n}", f"z.sp_{t}_s{n}", f"z.sp_{t}_n{n}", n)
                        + " END"))
    if features is not None:
        sel = [s for s in sel if s[0] in features]
    node = f"""SELECT c.minute_seq, c.expirDate, {', '.join(f'{e} AS {q(n)}' for n, e in sel)}
FROM offn c
LEFT JOIN offn l1 ON l1.expirDate = c.expirDate AND l1.minute_seq = c.minute_seq - 1
LEFT JOIN offn l5 ON l5.expirDate = c.expirDate AND l5.minute_seq = c.minute_seq - 5
JOIN oz z ON z.expirDate = c.expirDate AND z.minute_seq = c.minute_seq"""
    body = f"""SELECT p.timestamp_int, p.expirDate, p.strike, {', '.join(f'{r4("f." + q(n))} AS {q(n)}' for n, _ in sel)}
FROM p LEFT JOIN ({node}) f ON f.expirDate = p.expirDate AND f.minute_seq = p.minute_seq"""
    return (extra, body) if raw else with_chain(body, extra)


OFFSET_FAMILIES = {
    "offset_iv_change": tuple(n for o in OFFSETS for n in (f"IV_offsetChange_{o}_L1", f"IV_offsetChange_{o}_L5")),
    "offset_iv_zscore": tuple(n for o in OFFSETS for n in (f"IV_offsetZ_{o}_5", f"IV_offsetZ_{o}_15")),
    "offset_skew": tuple(f"IV_SkewToATM_{o}" for o in OFFSETS),
    "offset_spread_zscore": tuple(n for o in OFFSETS
                                  for n in (f"SpreadPct_offsetZ_{o}_5", f"SpreadPct_offsetZ_{o}_15")),
}

ATM_FAMILIES = {
    "atm_change": ("ATM_CallIVChange_L1", "ATM_CallIVChange_L5", "ATM_CallIVChange_L15",
                   "ATM_CallSpreadPctChange_L1", "ATM_CallSpreadPctChange_L5", "ATM_CallSpreadPctChange_L15",
                   "ATM_CallGammaChange_L1", "ATM_CallGammaChange_L5", "ATM_CallGammaChange_L15"),
    "atm_zscore": ("ATM_CallIVZ_5", "ATM_CallIVZ_15", "ATM_CallIVZ_30"),
}


def underlying_sql(features=None, per_row: bool = False, raw: bool = False):
    def lag_ret(k):
        return (f"CASE WHEN {gate('c', k)} AND c.stockPrice > 0 AND l{k}.stockPrice > 0 "
                f"THEN ln(c.stockPrice / l{k}.stockPrice) END")

    parts = []
    for n in (5, 15, 30):
        flt = f"FILTER (WHERE h.minute_seq >= c.minute_seq - {n})"
        parts += [f"avg(h.stockPrice) {flt} AS sma{n}", f"count(h.stockPrice) {flt} AS cnt{n}",
                  f"list(h.stockPrice ORDER BY h.minute_seq) {flt} AS pts{n}"]
        sflt = f"FILTER (WHERE h.minute_seq >= c.minute_seq - {n} + 1)"
        parts += [f"sum(h.sq) {sflt} AS ssq{n}", f"sum(h.used) {sflt} AS used{n}", f"sum(h.bad) {sflt} AS bad{n}"]
    extra = f"""
steps AS (
  SELECT s.minute_seq, s.stockPrice, s.timestamp_int,
         CASE WHEN coalesce(pr.stockPrice <= 0, false) OR coalesce(s.stockPrice <= 0, false) THEN 0 ELSE 1 END AS used,
         CASE WHEN coalesce(pr.stockPrice <= 0, false) OR coalesce(s.stockPrice <= 0, false) THEN NULL
              ELSE ln(s.stockPrice / pr.stockPrice) * ln(s.stockPrice / pr.stockPrice) END AS sq,
         CASE WHEN NOT (coalesce(pr.stockPrice <= 0, false) OR coalesce(s.stockPrice <= 0, false))
                   AND (s.stockPrice IS NULL OR pr.stockPrice IS NULL) THEN 1 ELSE 0 END AS bad
  FROM spine s LEFT JOIN spine pr ON pr.minute_seq = s.minute_seq - 1),
uw AS (
  SELECT c.minute_seq, {', '.join(parts)}
  FROM steps c JOIN steps h ON h.minute_seq BETWEEN c.minute_seq - 30 AND c.minute_seq
  GROUP BY c.minute_seq)"""

    def price_sum(xs, m):
        # The order of additions decides means of 16 cent prices that end in a half at the fourth place.  Under eight
        # prices: as they come.  Else eight running sums over every eighth price, added pairwise, then the rest as they come.
        if m < 8:
            return f"list_reduce({xs}, lambda a, b: a + b)"
        rounds = m // 8
        lane = f"list_reduce(list_transform(range({rounds}), lambda k: {xs}[8 * k + j + 1]), lambda a, b: a + b)"
        lanes = f"list_transform(range(8), lambda j: {lane})"
        for width in (4, 2, 1):
            lanes = f"list_transform(range({width}), lambda i{width}: ({lanes})[2 * i{width} + 1] + ({lanes})[2 * i{width} + 2])"
        return f"list_reduce(list_concat({lanes}, {xs}[{8 * rounds + 1}:]), lambda a, b: a + b)"

    def ema(n):
        com = (n - 1) / 2.0
        a = 1.0 / (1.0 + com)
        dcy = 1.0 - a
        # Recursive mean without missing prices (the derived chain has none).
        dl, al = f"CAST('{dcy!r}' AS DOUBLE)", f"CAST('{a!r}' AS DOUBLE)"
        return (f"CASE WHEN {gate('c', n)} THEN list_reduce(w.pts{n}, lambda m, x: CASE WHEN m != x THEN "
                f"({dl} * m + {al} * x) / ({dl} + {al}) ELSE m END) END")

    sel = []
    for k in (1, 5, 15):
        sel.append((f"UnderlyingReturn_L{k}", lag_ret(k)))
    for k in (5, 15, 30):
        sel.append((f"UnderlyingCumReturn_{k}", lag_ret(k)))
    for n in (5, 15, 30):
        total = price_sum(f"w.pts{n}", n + 1)
        sel.append((f"UnderlyingSMA_{n}", f"CASE WHEN {gate('c', n)} AND w.cnt{n} = {n + 1} THEN {total} / {n + 1} END"))
    for n in (5, 15, 30):
        sel.append((f"UnderlyingEMA_{n}", ema(n)))
    for n in (5, 15, 30):
        sel.append((f"UnderlyingVol_{n}",
                    f"CASE WHEN {gate('c', n)} AND w.bad{n} = 0 AND w.used{n} > 0 THEN sqrt(w.ssq{n}) END"))
    if features is not None:
        sel = [s for s in sel if s[0] in features]
    node = f"""SELECT c.minute_seq, c.timestamp_int, {', '.join(f'{e} AS {q(n)}' for n, e in sel)}
FROM steps c
LEFT JOIN spine l1 ON l1.minute_seq = c.minute_seq - 1
LEFT JOIN spine l5 ON l5.minute_seq = c.minute_seq - 5
LEFT JOIN spine l15 ON l15.minute_seq = c.minute_seq - 15
LEFT JOIN spine l30 ON l30.minute_seq = c.minute_seq - 30
JOIN uw w ON w.minute_seq = c.minute_seq"""
    if per_row:
        body = f"""SELECT p.timestamp_int, p.expirDate, p.strike, {', '.join(f'{r4("f." + q(n))} AS {q(n)}' for n, _ in sel)}
FROM p JOIN ({node}) f ON f.minute_seq = p.minute_seq"""
    else:
        body = f"""SELECT f.timestamp_int, {', '.join(f'{r4("f." + q(n))} AS {q(n)}' for n, _ in sel)}
FROM ({node}) f"""
    return (extra, body) if raw else with_chain(body, extra)


UNDERLYING_FAMILIES = {
    "underlying_return": ("UnderlyingReturn_L1", "UnderlyingReturn_L5", "UnderlyingReturn_L15"),
    "underlying_cum_return": ("UnderlyingCumReturn_5", "UnderlyingCumReturn_15", "UnderlyingCumReturn_30"),
    "underlying_sma": ("UnderlyingSMA_5", "UnderlyingSMA_15", "UnderlyingSMA_30"),
    "underlying_ema": ("UnderlyingEMA_5", "UnderlyingEMA_15", "UnderlyingEMA_30"),
    "underlying_vol": ("UnderlyingVol_5", "UnderlyingVol_15", "UnderlyingVol_30"),
}


SECTION_SQL = (
    # output order: sections by name
    ("section_atm", atm_sql),
    ("section_contract", contract_sql),
    ("section_cross_sectional", cross_sql),
    ("section_offset", offset_sql),
    ("section_underlying", lambda features=None, raw=False: underlying_sql(features, per_row=True, raw=raw)),
)


def features_sql(sections=None, input_precision: int = 4) -> str:
    """Input columns (rounded) plus the features of the given sections, per row."""
    from chainfeatures.plans.registry import create_default_registry

    reg = create_default_registry()
    extras, joins, cols = [], [], []
    for i, (name, fn) in enumerate(SECTION_SQL):
        if sections is not None and name not in sections:
            continue
        extra, body = fn(None, raw=True)
        extras.append(extra)
        joins.append(f"JOIN f{i} ON f{i}.timestamp_int = p.timestamp_int AND f{i}.expirDate = p.expirDate "
                     f"AND f{i}.strike = p.strike")
        extras.append(f"\nf{i} AS ({body})")
        cols += [f"f{i}.{q(n)}" for n in reg.sections[name].feature_names]
    inputs = [r4(f"p.{c}", input_precision) + f" AS {c}" if c in DOUBLE_INPUTS else f"p.{c}"
              for c in CHAIN_COLUMNS]
    body = f"SELECT {', '.join(inputs + cols)}\nFROM p\n" + "\n".join(joins)
    return with_chain(body, ",".join(extras))


# -- object names from events ------------------------------------------------------------

NAMES_CTE = r"""
ev AS (
  SELECT event_id, ts, strftime(ts, '%Y%m%d%H%M') AS stamp, strftime(ts, '%Y%m%d') AS day,
         CAST((event_id // 7) % 4 AS INTEGER) AS kind
  FROM events),
nm AS (
  SELECT event_id, day,
         CASE WHEN event_id % 7 = 0 THEN
           CASE kind WHEN 0 THEN 'xstrikes_' || stamp || '.parquet'
                     WHEN 1 THEN 'strikes_' || substr(stamp, 1, 4) || '13' || substr(stamp, 7, 6) || '.parquet'
                     WHEN 2 THEN 'strikes_' || substr(stamp, 1, 8) || '24' || substr(stamp, 11, 2) || '.parquet'
                     ELSE 'strikes_' || stamp || '.parquet.tmp' END
         ELSE 'strikes_' || stamp || '.parquet' END AS name
  FROM ev),
nk AS (SELECT event_id, name, 'one-minute/' || day || '/' || name AS key FROM nm),
parsed AS (
  SELECT nk.*, regexp_matches(name, '^strikes_(\d{8})(\d{4})\.parquet$') AS m,
         regexp_extract(name, '^strikes_(\d{8})(\d{4})\.parquet$', 1) AS d,
         regexp_extract(name, '^strikes_(\d{8})(\d{4})\.parquet$', 2) AS hm
  FROM nk),
tk AS (
  SELECT event_id, name, key,
         coalesce(m AND try_strptime(d, '%Y%m%d') IS NOT NULL AND TRY_CAST(substr(d, 1, 4) AS INTEGER) >= 1
                  AND TRY_CAST(substr(hm, 1, 2) AS INTEGER) BETWEEN 0 AND 23
                  AND TRY_CAST(substr(hm, 3, 2) AS INTEGER) BETWEEN 0 AND 59, false) AS valid,
         d, hm
  FROM parsed),
named AS (
  SELECT event_id, name, key, valid,
         CASE WHEN valid THEN d END AS date, CASE WHEN valid THEN hm END AS minute,
         CASE WHEN valid THEN CAST(d || hm AS BIGINT) END AS timestamp_int
  FROM tk)"""


def _suffix(k: str) -> str:
    return f"(CASE WHEN strpos({k}, '/') > 0 THEN substr({k}, strpos({k}, '/') + 1) ELSE {k} END)"


def _date_folder(s: str) -> str:
    return f"(CASE WHEN len(string_split({s}, '/')) >= 2 THEN string_split({s}, '/')[1] ELSE 'unknown' END)"


WORK_CTE = NAMES_CTE + f""",
listed AS (SELECT * FROM named WHERE ends_with(key, '.parquet')),
processed AS (SELECT * FROM named WHERE valid AND CAST(substr(minute, 3, 2) AS INTEGER) % 3 = 0),
src AS (SELECT DISTINCT {_suffix('key')} AS key_suffix FROM listed),
dst AS (SELECT DISTINCT {_suffix('key')} AS key_suffix FROM processed),
todo AS (SELECT key_suffix, {_date_folder('key_suffix')} AS date FROM src
         WHERE key_suffix NOT IN (SELECT key_suffix FROM dst))"""


def names_sql(body: str, ctes: str = NAMES_CTE) -> str:
    return f"WITH {ctes}\n{body}"


TIME_KEY_SQL = names_sql("SELECT event_id, name, date, minute, timestamp_int, valid FROM named")
TIME_KEY_VALID_SQL = names_sql("SELECT event_id, name, timestamp_int FROM named WHERE valid")
SESSION_POSITION_SQL = names_sql("""SELECT event_id,
  CAST(substr(minute, 1, 2) AS INTEGER) * 60 + CAST(substr(minute, 3, 2) AS INTEGER) - 570 AS sequence_number,
  CAST(substr(minute, 1, 2) AS INTEGER) AS hour, CAST(substr(minute, 3, 2) AS INTEGER) AS minute_of_hour
FROM named WHERE valid""")

PATH_PARTS_SQL = names_sql(f"""SELECT event_id, uri,
  CASE WHEN ok THEN substr(rest, 1, strpos(rest, '/') - 1) END AS bucket,
  CASE WHEN ok THEN substr(rest, strpos(rest, '/') + 1) END AS key,
  ok AS uri_valid,
  {_suffix("coalesce(CASE WHEN ok THEN substr(rest, strpos(rest, '/') + 1) END, uri)")} AS key_suffix,
  {_date_folder(_suffix("coalesce(CASE WHEN ok THEN substr(rest, strpos(rest, '/') + 1) END, uri)"))} AS date_folder
FROM (SELECT event_id, uri, substr(uri, 6) AS rest,
             coalesce(starts_with(uri, 's3://') AND strpos(substr(uri, 6), '/') > 0, false) AS ok
      FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN key
                                  WHEN event_id % 11 = 1 THEN 's3://source-bucket'
                                  ELSE 's3://source-bucket/' || key END AS uri FROM named))""")

UNPROCESSED_SQL = names_sql("SELECT key_suffix, date FROM todo", WORK_CTE)

WORKLIST_SQL = names_sql("""SELECT date, CAST(dense_rank() OVER (ORDER BY date) AS INTEGER) AS date_order,
  uri, CAST(row_number() OVER (PARTITION BY date ORDER BY uri) AS INTEGER) AS position,
  count(*) OVER (PARTITION BY date) AS files_in_date
FROM (SELECT date, 's3://source-bucket/one-minute/' || key_suffix AS uri FROM todo)""", WORK_CTE)

HISTORY_CONTEXT_SQL = names_sql("""SELECT timestamp_int, context_timestamp_int, CAST(back AS INTEGER) AS back FROM (
  SELECT t.timestamp_int, a.timestamp_int AS context_timestamp_int,
         row_number() OVER (PARTITION BY t.timestamp_int ORDER BY a.timestamp_int DESC) AS back
  FROM (SELECT DISTINCT n.timestamp_int FROM todo JOIN named n
          ON n.valid AND todo.key_suffix = substr(n.key, strpos(n.key, '/') + 1)) t
  JOIN (SELECT DISTINCT timestamp_int FROM listed WHERE valid) a
    ON a.timestamp_int < t.timestamp_int
   AND CAST(strptime(CAST(a.timestamp_int // 10000 AS VARCHAR), '%Y%m%d') AS DATE)
       >= CAST(strptime(CAST(t.timestamp_int // 10000 AS VARCHAR), '%Y%m%d') AS DATE) - INTERVAL 5 DAY)
WHERE back <= 60""", WORK_CTE)

CHRONOLOGY_SQL = """SELECT event_id, batch, timestamp_int,
  coalesce(timestamp_int > max(timestamp_int) OVER (PARTITION BY batch ORDER BY event_id
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS accepted
FROM (SELECT event_id, strftime(ts, '%Y%m%d') AS batch,
             CAST(strftime(ts + to_minutes(CAST((event_id * 7919) % 5 - 2 AS BIGINT)), '%Y%m%d%H%M') AS BIGINT) AS timestamp_int
      FROM events)"""

RUN_SUMMARY_SQL = names_sql("""SELECT * FROM summary""", WORK_CTE + """,
o AS (
  SELECT todo.date, coalesce(n.valid, false) AS ok
  FROM todo LEFT JOIN (SELECT DISTINCT substr(key, strpos(key, '/') + 1) AS key_suffix, valid FROM named) n
    ON n.key_suffix = todo.key_suffix),
pd AS (SELECT date, count(*) FILTER (WHERE ok) AS completed, count(*) FILTER (WHERE NOT ok) AS failed FROM o GROUP BY date),
allrows AS (
  SELECT date, completed, failed, 1 AS dates, CASE WHEN failed > 0 THEN 1 ELSE 0 END AS failed_dates FROM pd
  UNION ALL
  SELECT NULL, sum(completed), sum(failed), count(*), count(*) FILTER (WHERE failed > 0) FROM pd),
summary AS (
SELECT date, CAST(completed AS BIGINT) AS completed, CAST(failed AS BIGINT) AS failed,
       CAST(dates AS BIGINT) AS dates, CAST(failed_dates AS BIGINT) AS failed_dates,
       CASE WHEN failed = 0 THEN 'success' ELSE 'partial' END AS status,
       (dates - failed_dates) * 100.0 / dates AS success_rate
FROM allrows)""")


# -- chain-level queries ------------------------------------------------------------

SNAPSHOT_SCAN_SQL = with_chain(f"SELECT {', '.join(CHAIN_COLUMNS)} FROM chain")

SNAPSHOT_QUALITY_SQL = with_chain("""SELECT timestamp_int, rows, null_key_rows, duplicate_keys, error IS NULL AS valid, error,
  CASE WHEN error IS NOT NULL THEN 'ValueError' END AS error_type
FROM (SELECT *, CASE WHEN null_key_rows > 0 THEN 'Null expirDate or strike'
                     WHEN duplicate_keys > 0 THEN 'Duplicate (expirDate, strike)'
                     WHEN hi > lo THEN 'Several stockPrice values' END AS error
  FROM (SELECT timestamp_int, CAST(sum(n) AS BIGINT) AS rows,
          CAST(sum(CASE WHEN expirDate IS NULL OR strike IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_key_rows,
          CAST(count(*) FILTER (WHERE n > 1 AND expirDate IS NOT NULL AND strike IS NOT NULL) AS BIGINT) AS duplicate_keys,
          min(lo) AS lo, max(hi) AS hi
        FROM (SELECT timestamp_int, expirDate, strike, count(*) AS n, min(stockPrice) AS lo, max(stockPrice) AS hi FROM spoilt GROUP BY 1, 2, 3)
        GROUP BY timestamp_int))""", """
odd AS (
  SELECT * REPLACE (CASE WHEN substr(date, 7, 2) = '12' AND strike = 1 THEN NULL ELSE expirDate END AS expirDate,
                    CASE WHEN substr(date, 7, 2) = '14' THEN stockPrice + strike ELSE stockPrice END AS stockPrice) FROM chain),
spoilt AS (SELECT * FROM odd UNION ALL SELECT * FROM odd WHERE substr(date, 7, 2) = '11')""")

_MINUTES = "(SELECT timestamp_int, min(date) AS date, min(minute) AS minute, count(*) AS n FROM chain GROUP BY timestamp_int)"
FILE_LISTING_SQL = with_chain(f"SELECT date AS date_folder, CAST(timestamp_int AS VARCHAR) AS stamp, true AS has_bytes, true AS has_time FROM {_MINUTES}")
#: Per minute: how many minutes hold the same rows (files that are alike byte for byte).
_ALIKE = f"""(SELECT timestamp_int, date, minute, count(*) OVER (PARTITION BY content) AS files_alike FROM (
  SELECT timestamp_int, date, minute, string_agg(concat_ws('|', {", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in CHAIN_COLUMNS[3:])}), ';'
    ORDER BY expirDate, strike) AS content FROM chain GROUP BY timestamp_int, date, minute))"""
FILE_CHECKSUM_SQL = with_chain(f"SELECT date AS date_folder, CAST(timestamp_int AS VARCHAR) AS stamp, true AS is_md5, files_alike FROM {_ALIKE}")
OBJECT_CHECKSUM_SQL = with_chain(f"SELECT date AS date_folder, CAST(timestamp_int AS VARCHAR) AS stamp, true AS is_composite, files_alike FROM {_ALIKE}")
FILE_FOOTER_SQL = with_chain(f"""SELECT date AS date_folder, CAST(timestamp_int AS VARCHAR) AS stamp, n AS rows,
  CAST({len(CHAIN_COLUMNS) - 3} AS INTEGER) AS n_fields, CAST(NULL AS VARCHAR) AS failure FROM {_MINUTES}""")
LINEAGE_SQL = with_chain(f"""SELECT files_alike, timestamp_int, date, minute, '{DEFAULT_FEATURE_HASH}' AS feature_version_hash,
  true AS has_checksum, true AS utc FROM {_ALIKE}""")
_DAY = "CAST(substr(date, 7, 2) AS INTEGER)"
SNAPSHOT_SCAN_MIXED_SQL = with_chain(f"""SELECT timestamp_int, expirDate, strike, stockPrice, CallMid,
  CASE WHEN {_DAY} % 3 <> 0 THEN PutMid END AS PutMid, callVolume, CASE WHEN {_DAY} % 5 = 0 THEN 'x' || expirDate END AS extra
FROM chain WHERE {_DAY} % 11 <> 0""")
PLUGIN_SQL = with_chain(f"""SELECT c.timestamp_int, c.expirDate, c.strike, {r4('c.CallMid - c.PutMid')} AS PutGap,
  CASE WHEN c.minute_seq > 2 THEN {r4('(c.CallMid - c.PutMid) - (l.CallMid - l.PutMid)')} END AS PutGapChange_L2
FROM p c LEFT JOIN p l ON l.expirDate = c.expirDate AND l.strike = c.strike AND l.minute_seq = c.minute_seq - 2""")

HISTORY_SECTION_SQL = with_chain(f"""SELECT timestamp_int, expirDate, strike,
  CASE WHEN minute_seq > 5 THEN {r4('mids[(len(mids) + 1) // 2]')} END AS CallMidMedian_5
FROM (SELECT c.timestamp_int, c.expirDate, c.strike, c.minute_seq, list(h.CallMid ORDER BY h.CallMid) FILTER (WHERE h.CallMid IS NOT NULL) AS mids
  FROM p c LEFT JOIN p h ON h.expirDate = c.expirDate AND h.strike = c.strike AND h.minute_seq BETWEEN c.minute_seq - 5 AND c.minute_seq
  GROUP BY ALL)""")


def live_sql() -> str:
    """Features of the newest minute, computed over its own five days only."""
    text = features_sql()
    head = "FROM cells c JOIN day_price d USING (l_shipdate))"
    assert head in text
    text = text.replace(head, head[:-1] + " WHERE c.l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 5 DAY)")
    return f"SELECT * FROM ({text}) WHERE timestamp_int = (SELECT CAST(strftime(max(l_shipdate), '%Y%m%d%H%M') AS BIGINT) FROM lineitem)"


MINUTE_SPINE_SQL = with_chain("SELECT timestamp_int, CAST(minute_seq AS BIGINT) AS minute_seq, stockPrice FROM spine")
QUEUE_SIZE_SQL = with_chain("""SELECT timestamp_int, CAST(minute_seq AS BIGINT) AS minute_seq,
  CAST(least(minute_seq - 1, 300) AS BIGINT) AS available, CAST(least(minute_seq, 300) AS BIGINT) AS queue_size FROM spine""")
LAST_N_SQL = with_chain("""SELECT c.timestamp_int, w.timestamp_int AS window_timestamp_int,
  CAST(c.minute_seq - w.minute_seq AS INTEGER) AS back
FROM spine c JOIN spine w ON w.minute_seq BETWEEN c.minute_seq - 5 AND c.minute_seq - 1""")
POSITIONAL_LAG_SQL = with_chain("""SELECT c.timestamp_int, c.expirDate, c.strike,
  CASE WHEN c.minute_seq - 1 >= 1 THEN l1.CallIVMid END AS CallIVMid_lag1,
  CASE WHEN c.minute_seq - 1 >= 5 THEN l5.CallIVMid END AS CallIVMid_lag5,
  CASE WHEN c.minute_seq - 1 >= 3 THEN l3.PutMid END AS PutMid_lag3
FROM p c
LEFT JOIN p l1 ON l1.expirDate = c.expirDate AND l1.strike = c.strike AND l1.minute_seq = c.minute_seq - 1
LEFT JOIN p l5 ON l5.expirDate = c.expirDate AND l5.strike = c.strike AND l5.minute_seq = c.minute_seq - 5
LEFT JOIN p l3 ON l3.expirDate = c.expirDate AND l3.strike = c.strike AND l3.minute_seq = c.minute_seq - 3""")

ATM_NODE_SQL = with_chain("""SELECT n.timestamp_int, n.expirDate, a.iv AS atm_CallIVMid, a.sp AS atm_CallSpreadPct,
  a.gm AS atm_CallGamma
FROM (SELECT DISTINCT timestamp_int, minute_seq, expirDate FROM p) n
LEFT JOIN atm a ON a.expirDate = n.expirDate AND a.minute_seq = n.minute_seq""", ATM_NODE_CTE)


def _offset_node_sql() -> str:
    cols = []
    for o in OFFSETS:
        t = _tag(o)
        cols += [f"o.iv_{t} AS CallIVMid_{t}", f"o.sp_{t} AS CallSpreadPct_{t}"]
    return with_chain(f"""SELECT s.timestamp_int, o.expirDate, {', '.join(cols)}
FROM offn o JOIN spine s USING (minute_seq)""", _offset_node_cte())


OFFSET_NODE_SQL = _offset_node_sql()


def round_numerics_sql(d: int = 3) -> str:
    cols = [r4(c, d) + f" AS {c}" if c in DOUBLE_INPUTS else c for c in CHAIN_COLUMNS]
    return with_chain(f"SELECT {', '.join(cols)} FROM chain")


def coverage_sql() -> str:
    from chainfeatures.plans.registry import create_default_registry

    pairs = create_default_registry().feature_sections()
    parts = [f"SELECT '{f}' AS feature, '{s}' AS section, count(*) AS rows, count({q(f)}) AS non_null, "
             f"min({q(f)}) AS min_value, max({q(f)}) AS max_value FROM enriched" for f, s in pairs]
    body = features_sql()
    return f"WITH enriched AS ({body})\n" + "\nUNION ALL\n".join(parts)


def incremental_sql() -> str:
    return (f"SELECT * FROM ({features_sql()}) f "
            f"WHERE CAST(substr(f.date, 7, 2) AS INTEGER) % 3 <> 0")


LIVE_METADATA_SQL = with_chain(f"""SELECT {len(CHAIN_COLUMNS) - 3 + 93} AS feature_count,
  count(*) AS row_count, min(date) AS date, min(minute) AS minute, {r4('min(stockPrice)')} AS stock_price,
  '0613f3add0197063' AS feature_version_hash,
  CAST(least(1 + (SELECT count(*) FROM (
        SELECT s.timestamp_int FROM spine s, (SELECT max(timestamp_int) AS t FROM spine) x
        WHERE s.timestamp_int < x.t
          AND CAST(strptime(CAST(s.timestamp_int // 10000 AS VARCHAR), '%Y%m%d') AS DATE)
              >= CAST(strptime(CAST(x.t // 10000 AS VARCHAR), '%Y%m%d') AS DATE) - INTERVAL 5 DAY
        ORDER BY s.timestamp_int DESC LIMIT 60)), 300) AS BIGINT) AS history_minutes_loaded
FROM chain WHERE timestamp_int = (SELECT max(timestamp_int) FROM chain)""")
