"""Feature sections (the extension surface) and the registry that enables them.

A section declares ``feature_names`` and the level it computes at:

* ``minute``   -- one value per minute, on the minute spine (window ``ctx.minute_window``)
* ``node``     -- one value per (minute, expiry), on the node table (``ctx.node_window``);
                  broadcast to every row of that expiry and minute
* ``contract`` -- one value per row, over the contract's history (``ctx.contract_window``)

* ``history``  -- one value per row, by code of the section's own over the history of one expiry
                  (``HistorySection``), for what windows cannot say

The first three return expressions (Spark SQL text or Columns), never DataFrames, so all
sections of one level share a single window pass.  Optional hooks:
``node_aggs`` (per (minute, expiry) aggregates it needs, e.g. the ATM row) and
``row_inputs`` (per-row columns the window must see, e.g. a volume share).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column

from chainfeatures.config import FeatureParams
from chainfeatures.functions import frames
from chainfeatures.functions.frames import Frames

Expr = "str | Column"


@dataclass(frozen=True)
class Context:
    params: FeatureParams
    minute: Frames = Frames("block")
    node: Frames = Frames("expirDate", "block")
    contract: Frames = Frames("expirDate", "block", "strike")

    def gate(self, n: int) -> str:
        return frames.gate(n, self.params.window_size)

    def staged(self, sink: dict, tag: str) -> "Context":
        """A copy whose frames register their window aggregates in ``sink``."""
        return Context(params=self.params, minute=self.minute.staged(sink, tag),
                       node=self.node.staged(sink, tag), contract=self.contract.staged(sink, tag))


class FeatureSection:
    """Base class for a feature section; subclasses set ``name``, ``level``,
    ``feature_names`` and implement ``columns``."""

    name: str = ""
    level: str = "contract"
    feature_names: tuple[str, ...] = ()
    lookback: int = 0  # deepest look-back in minute positions

    def node_aggs(self, ctx: Context) -> dict[str, Expr]:
        return {}

    def row_inputs(self, ctx: Context) -> dict[str, Expr]:
        return {}

    def columns(self, ctx: Context) -> dict[str, Expr]:
        raise NotImplementedError


class HistorySection(FeatureSection):
    """A section with free access to the history: ``history`` is called once for every expiry and time block.

    ``inputs`` are the columns it reads.  Work is grouped like the windows, by (expirDate, block): a group holds the rows
    of one expiry in a block of minutes and the ``lookback`` positions before it, so it is bounded however long
    the history is, and a hot expiry is many groups.  Keys must be unique in a minute, as validation asks."""

    level = "history"
    inputs: tuple[str, ...] = ()

    def columns(self, ctx: Context) -> dict[str, Expr]:
        return {}

    def history(self, rows, params: FeatureParams):
        """``rows``: pandas, by minute_seq and strike, with ``minute_seq, strike, is_halo`` and the inputs; rows with
        ``is_halo`` are look-back only.  Returns the features as a pandas frame with the same index."""
        raise NotImplementedError


class FeatureRegistry:
    """Registered sections plus the enabled subset.  Sections run in name
    order (the order of the output columns)."""

    def __init__(self):
        self.sections: dict[str, FeatureSection] = {}
        self.enabled: set[str] = set()

    def register_section(self, name: str, section: FeatureSection) -> "FeatureRegistry":
        if section.level not in ("minute", "node", "contract", "history"):
            raise ValueError(f"section '{name}': unknown level '{section.level}'")
        self.sections[name] = section
        return self

    def enable_section(self, name: str) -> "FeatureRegistry":
        if name not in self.sections:
            raise ValueError(f"unknown section '{name}': register it first")
        self.enabled.add(name)
        return self

    def disable_section(self, name: str) -> "FeatureRegistry":
        self.enabled.discard(name)
        return self

    def active_sections(self) -> list[tuple[str, FeatureSection]]:
        return [(n, self.sections[n]) for n in sorted(self.enabled)]

    def get_active_features(self) -> list[str]:
        return [f for _, s in self.active_sections() for f in s.feature_names]

    def feature_sections(self) -> list[tuple[str, str]]:
        """(feature, section) pairs in output order."""
        return [(f, n) for n, s in self.active_sections() for f in s.feature_names]

    def compute_version_hash(self) -> str:
        return version_hash(self.get_active_features())

    def max_lookback(self) -> int:
        return max([s.lookback for _, s in self.active_sections()] + [1])

    def copy(self) -> "FeatureRegistry":
        r = FeatureRegistry()
        r.sections = dict(self.sections)
        r.enabled = set(self.enabled)
        return r


def version_hash(features) -> str:
    """First 16 hex digits of SHA-256 over the sorted, comma-joined names."""
    return hashlib.sha256(",".join(sorted(features)).encode("utf-8")).hexdigest()[:16]


def create_default_registry() -> FeatureRegistry:
    from chainfeatures.operators.atm import AtmSection
    from chainfeatures.operators.contract import ContractSection
    from chainfeatures.operators.cross_section import CrossSection
    from chainfeatures.operators.offset import OffsetSection
    from chainfeatures.operators.underlying import UnderlyingSection

    reg = FeatureRegistry()
    for name, section in (("section_underlying", UnderlyingSection()),
                          ("section_atm", AtmSection()),
                          ("section_offset", OffsetSection()),
                          ("section_cross_sectional", CrossSection()),
                          ("section_contract", ContractSection())):
        reg.register_section(name, section)
        reg.enable_section(name)
    return reg

