"""Parameters and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must equal the reference's for identical results) -------
# Required snapshot columns; a minute lacking any of them is rejected.
REQUIRED_COLUMNS = ("stockPrice", "expirDate", "strike", "distance_to_atm")
# Optional numeric inputs read by the feature sections (absent -> null).
OPTIONAL_COLUMNS = (
    "CallMid", "PutMid", "CallIVMid", "PutIVMid", "CallSpreadPct", "PutSpreadPct",
    "CallGamma", "callVolume", "putVolume",
    "IVPercentile_Expiry", "VolumePercentile_Expiry", "OIPercentile_Expiry",
)
# Snapshot file name: strikes_YYYYMMDDHHMM.parquet
FILE_NAME_PATTERN = r"^strikes_(\d{8})(\d{4})\.parquet$"
# Market open used by the session position: 09:30.
MARKET_OPEN_HOUR = 9
MARKET_OPEN_MINUTE = 30
# Rolling queue capacity (minutes kept) and history preload for live/incremental runs.
HISTORY_WINDOW_SIZE = 300
HISTORY_PRELOAD_MINUTES = 60
HISTORY_PRELOAD_DAYS = 5
# Decimal places for the section rounding and the final numeric rounding.
SECTION_PRECISION = 4
NUMERIC_PRECISION = 4
# Z-score guards: include-current z needs std >= 1e-6, history-only z needs std > 1e-6.
STD_FLOOR = 1e-6
# Offsets (distance_to_atm) of the relative-moneyness section.
OFFSETS = (-2, -1, 0, 1, 2)
# Feature-set hash of the default 93 features (first 16 hex of SHA-256).
DEFAULT_FEATURE_HASH = "0613f3add0197063"
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureParams:
    """Run parameters.

    ``block_minutes`` is the engine's own knob: panel windows are partitioned by
    (key, minute_seq block) with a halo of the deepest look-back of the enabled
    sections, so that no window partition grows with the length of the history
    and a hot key spreads over many tasks.  The live/incremental preload limits
    (60 minutes, 5 days) are arguments of ``plans.jobs.run_live``.
    """

    precision: int = NUMERIC_PRECISION
    window_size: int = HISTORY_WINDOW_SIZE
    block_minutes: int | None = None  # None: sized from the spine (pipeline.block_size)

    def __post_init__(self):
        if self.block_minutes is not None and self.block_minutes < 2:
            raise ValueError("block_minutes must be at least 2")
        if self.window_size <= 0 or self.precision < 0:
            raise ValueError("window_size must be positive and precision non-negative")
