"""The full feature plan (all enabled sections), as one lazy DataFrame.

Shape of the physical plan (see README "Plan"):

* minute spine: distinct minutes, two-level numbering -> checkpointed (tiny)
* panel rows get ``minute_seq`` by a broadcast join with the spine (size checked)
* rows are cut into time blocks with a halo of the deepest look-back and
  hash-partitioned ONCE by (expirDate, block)
* node values per (expirDate, minute) are aggregated map-side, blocked the same
  way, and their rolling features computed over (expirDate, block)
* the node join on (expirDate, block, minute_seq) and the contract window over
  (expirDate, block, strike) both reuse the panel's partitioning: no further
  shuffle of the panel
* per-minute (underlying) features come from the spine by broadcast
* halo copies are dropped; features are rounded half-even
"""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfeatures.config import OPTIONAL_COLUMNS, REQUIRED_COLUMNS, SECTION_PRECISION, FeatureParams
from chainfeatures.functions.frames import SEQ
from chainfeatures.functions.rounding import half_even_sql
from chainfeatures.operators import timeline
from chainfeatures.operators.nodes import exact_order
from chainfeatures.plans.registry import Context, FeatureRegistry, create_default_registry

KEYS = ("expirDate", "block", SEQ)


def expr(e) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def staged_select(df: DataFrame, ctx: Context, build, tag: str) -> DataFrame:
    """Add the columns returned by ``build(staged_ctx) -> {name: expr}`` in two
    projections: first every distinct windowed aggregate they use (once),
    then the expressions themselves; the helper columns are dropped."""
    sink: dict = {}
    cols = build(ctx.staged(sink, tag))
    if sink:
        df = df.select("*", *[F.expr(text).alias(name) for text, name in sink.items()])
    df = df.select("*", *[expr(c).alias(n) for n, c in cols.items()])
    return df.drop(*sink.values()) if sink else df


def normalise_panel(panel: DataFrame) -> DataFrame:
    """NaN -> null in floating columns (Spark aggregates propagate NaN, the
    reference treats it as missing); float -> double; absent optional inputs
    -> null doubles."""
    cols = []
    for f in panel.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.expr(f"nanvl(CAST(`{f.name}` AS DOUBLE), CAST(NULL AS DOUBLE))").alias(f.name)
        cols.append(c)
    present = set(panel.columns)
    for name in OPTIONAL_COLUMNS:
        if name not in present:
            cols.append(F.lit(None).cast("double").alias(name))
    return panel.select(cols)


def build_spine(panel: DataFrame, checkpoint: bool = True) -> tuple[DataFrame, int | None]:
    """Spine of a panel, materialised in the shared checkpoint folder so the
    panel scan behind it is not repeated and lineage stays short; returns the
    row count used for the broadcast and block-size decisions."""
    spine = timeline.minute_spine(panel)
    if not checkpoint:
        return spine, None
    from chainfeatures.session import materialize
    spine = materialize(spine)
    return spine, spine.count()


def block_size(params: FeatureParams, spine_rows: int | None, parallelism: int, halo: int) -> int:
    """Time-block length in minutes.

    Explicit ``params.block_minutes`` wins.  Otherwise about two blocks per
    core over the history, between 8 halos (halo copies <= 12.5 % of rows) and
    4096 minutes (~10 trading days: bounded rows per (expiry, block) key).
    """
    if params.block_minutes:
        return params.block_minutes
    lo, hi = max(8 * halo, 64), 4096
    if not spine_rows:
        return hi
    want = math.ceil(spine_rows / max(2 * parallelism, 1))
    return int(min(hi, max(lo, 2 ** math.ceil(math.log2(max(want, 1))))))


def _partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def compute_features(panel: DataFrame, registry: FeatureRegistry | None = None,
                     params: FeatureParams | None = None, spine: DataFrame | None = None,
                     spine_rows: int | None = None, keep: Column | None = None,
                     round_output: bool = True, store_nodes: bool = True) -> DataFrame:
    """Input columns plus every enabled feature, one row per input row.

    ``panel`` needs ``timestamp_int`` and the required snapshot columns.
    ``spine`` (optional) supplies global positions when ``panel`` is only a
    slice of the history (incremental runs); ``keep`` then selects the rows to
    return, the others served as look-back context.  ``store_nodes=False`` aggregates the nodes twice
    instead of writing them: for a few minutes that is the cheaper way.
    """
    reg = registry or create_default_registry()
    missing = [c for c in ("timestamp_int",) + REQUIRED_COLUMNS if c not in panel.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    reserved = {SEQ, "block", "is_halo"} & set(panel.columns)
    if reserved or any(c.startswith("_") for c in panel.columns if c not in ("_metadata",)):
        raise ValueError(f"Input columns clash with engine columns: {sorted(reserved) or 'leading underscore'}")
    params = params or FeatureParams()
    spark = panel.sparkSession
    halo = max(reg.max_lookback(), 1)
    ctx = Context(params=params)
    sections = reg.active_sections()
    validate_sections(sections, ctx, panel.columns)
    in_cols = list(panel.columns)
    p = normalise_panel(panel)
    fields = {f.name: f.dataType for f in p.schema.fields}

    if spine is None:
        spine, spine_rows = build_spine(p)
    block = block_size(params, spine_rows, spark.sparkContext.defaultParallelism, halo)
    if halo >= block:
        raise ValueError("block_minutes must exceed the deepest look-back")
    nparts = _partitions(spark)

    # --- minute level (spine) ---------------------------------------------
    minute_feats = _minute_level(spine, sections, ctx, block, halo, nparts)

    # --- rows, blocked and partitioned once ---------------------------------
    # An explicit partition count: the window stage is CPU-heavy per row, so
    # AQE must not fold it into a few tasks on the strength of a small shuffle.
    rows = timeline.attach_seq(p, spine, spine_rows)
    rows = timeline.with_blocks(rows, block, halo).repartition(nparts, "expirDate", "block")

    # --- node level ---------------------------------------------------------
    # The contract window is handed only the node values that its inputs use; the node
    # features join after it, when halo rows and context rows are gone.  The joins keep the
    # partitioning and, being hash joins, need no further sort of the panel.
    contract_secs = [s for _, s in sections if s.level == "contract"]
    node_secs = [s for _, s in sections if s.level == "node"]
    inputs = {n for s in contract_secs for n in s.node_aggs(ctx)}
    node_aggs = {}
    for _, s in sections:
        node_aggs.update(s.node_aggs(ctx))
    integral = isinstance(fields["distance_to_atm"], T.IntegralType)
    nodes = None
    if node_aggs:
        base = timeline.attach_seq(p, spine, spine_rows)
        nodes = base.groupBy("expirDate", SEQ).agg(*[expr(exact_order(c, integral)).alias(n) for n, c in node_aggs.items()])
        if inputs and node_secs and store_nodes:  # read twice below; stored, so that the panel is aggregated once
            from chainfeatures.session import materialize
            nodes = materialize(nodes)
        nodes = timeline.with_blocks(nodes, block, halo).repartition(nparts, "expirDate", "block")
    if inputs:
        rows = rows.join(nodes.select(*KEYS, *sorted(inputs)).hint("shuffle_hash"), list(KEYS), "left")

    # --- contract level: one window pass -------------------------------------
    rows = staged_select(rows, ctx, lambda c: {n: e for s in contract_secs for n, e in s.row_inputs(c).items()},
                         "ci_")
    if contract_secs:
        rows = staged_select(rows, ctx, lambda c: {n: e for s in contract_secs for n, e in s.columns(c).items()},
                             "cf_")
    history_secs = [s for _, s in sections if s.level == "history"]
    own_history = _history_level(rows, history_secs, params) if history_secs else None
    rows = rows.filter(~F.col("is_halo"))
    if keep is not None:
        rows = rows.filter(keep)
    if own_history is not None:
        rows = rows.join(own_history.hint("shuffle_hash"), [*KEYS, "strike"], "left")
    if node_secs:
        nodes = staged_select(nodes, ctx, lambda c: {n: e for s in node_secs for n, e in s.columns(c).items()}, "nf_")
        node_feats = [n for s in node_secs for n in s.columns(ctx)]
        nodes = nodes.filter(~F.col("is_halo")).select(*KEYS, *[F.col(f"`{n}`") for n in node_feats])
        rows = rows.join(nodes.hint("shuffle_hash"), list(KEYS), "left")

    if minute_feats is not None:
        small = spine_rows is not None and spine_rows <= timeline.SPINE_BROADCAST_MAX_ROWS
        rows = rows.join(F.broadcast(minute_feats) if small else minute_feats, SEQ, "left")

    features = reg.get_active_features()
    if round_output:
        out = [F.expr(half_even_sql(f"`{c}`", params.precision)).alias(c)
               if isinstance(fields[c], T.DoubleType) else F.col(f"`{c}`") for c in in_cols]
        out += [F.expr(half_even_sql(half_even_sql(f"CAST(`{n}` AS DOUBLE)", SECTION_PRECISION),
                                     params.precision)).alias(n) for n in features]
    else:
        out = [F.col(f"`{c}`") for c in in_cols] + [F.col(f"`{n}`").cast("double").alias(n) for n in features]
    return rows.select(out)


def _history_level(rows: DataFrame, secs: list, params: FeatureParams) -> DataFrame:
    """Keys and features of the history sections: grouped by the partitioning that the rows already have.

    A section's code travels by value, so the module that defines it need not be installed on the executors."""
    for s in secs:
        if type(s).__module__ in sys.modules and type(s).__module__ != "__main__":
            cloudpickle.register_pickle_by_value(sys.modules[type(s).__module__])
    inputs = sorted({c for s in secs for c in s.inputs} - {SEQ, "strike", "is_halo", "block", "expirDate"})
    names = [n for s in secs for n in s.feature_names]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in (*KEYS, "strike")), *(f"`{n}` double" for n in names)])

    def run(pdf):
        pdf = pdf.sort_values([SEQ, "strike"], kind="stable").reset_index(drop=True)
        out = pdf[[*KEYS, "strike"]].copy()
        for s in secs:
            got = s.history(pdf, params)
            if sorted(got.columns) != sorted(s.feature_names) or len(got) != len(pdf):
                raise ValueError(f"section '{s.name}' declares {sorted(s.feature_names)} but produces {sorted(got.columns)} in {len(got)} of {len(pdf)} rows")
            for n in s.feature_names:
                out[n] = got[n].astype("float64")
        return out[~pdf["is_halo"]]

    got = rows.select(*KEYS, "strike", "is_halo", *[F.col(f"`{c}`") for c in inputs]).groupBy("expirDate", "block").applyInPandas(run, schema)
    return got.select(*KEYS, "strike", *[F.expr(f"nanvl(`{n}`, CAST(NULL AS DOUBLE))").alias(n) for n in names])


def _minute_level(spine: DataFrame, sections, ctx: Context, block: int, halo: int, nparts: int) -> DataFrame | None:
    """Features of the enabled minute-level sections, one row per spine position."""
    secs = [s for _, s in sections if s.level == "minute"]
    if not secs:
        return None
    ms = timeline.with_blocks(spine.select(SEQ, "stockPrice"), block, halo).repartition(nparts, "block")
    for i, s in enumerate(secs):
        ms = staged_select(ms, ctx, s.row_inputs, f"mi{i}_")
    ms = staged_select(ms, ctx, lambda c: {n: e for s in secs for n, e in s.columns(c).items()}, "mf_")
    return ms.filter(~F.col("is_halo")).select(SEQ, *[F.col(f"`{n}`") for s in secs for n in s.feature_names])


def minute_features(panel: DataFrame, registry: FeatureRegistry | None = None,
                    params: FeatureParams | None = None) -> DataFrame:
    """timestamp_int and the minute-level features, one row per minute: the panel is only read for
    its spine."""
    reg, params = registry or create_default_registry(), params or FeatureParams()
    ctx, halo = Context(params=params), max(reg.max_lookback(), 1)
    spine, n = build_spine(normalise_panel(panel.select("timestamp_int", "stockPrice")))
    spark = panel.sparkSession
    block = block_size(params, n, spark.sparkContext.defaultParallelism, halo)
    feats = _minute_level(spine, reg.active_sections(), ctx, block, halo, _partitions(spark))
    names = [c for c in feats.columns if c != SEQ]
    rounded = [F.expr(half_even_sql(half_even_sql(f"CAST(`{c}` AS DOUBLE)", SECTION_PRECISION), params.precision)).alias(c) for c in names]
    return spine.select("timestamp_int", SEQ).join(feats, SEQ).select("timestamp_int", *rounded)


def validate_sections(sections, ctx: Context, input_columns) -> None:
    """Each section must produce exactly the features it declares, and no
    feature may shadow an input column or another section's feature."""
    seen = set(input_columns)
    for name, s in sections:
        got = list(s.feature_names if s.level == "history" else s.columns(ctx).keys())
        if sorted(got) != sorted(s.feature_names):
            raise ValueError(f"section '{name}' declares {sorted(s.feature_names)} but produces {sorted(got)}")
        clash = seen & set(got)
        if clash:
            raise ValueError(f"section '{name}': feature names already used: {sorted(clash)}")
        seen |= set(got)


def node_table(panel: DataFrame, registry: FeatureRegistry | None = None,
               params: FeatureParams | None = None) -> DataFrame:
    """(timestamp_int, expirDate) rows with the node aggregates, unblocked
    (for inspection and the node-level queries)."""
    reg = registry or create_default_registry()
    ctx = Context(params=params or FeatureParams())
    p = normalise_panel(panel)
    aggs = {}
    for _, s in reg.active_sections():
        aggs.update(s.node_aggs(ctx))
    integral = isinstance(p.schema["distance_to_atm"].dataType, T.IntegralType)
    return p.groupBy("timestamp_int", "expirDate").agg(*[expr(exact_order(c, integral)).alias(n) for n, c in aggs.items()])
