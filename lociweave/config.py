"""Parameter sets.  The default values are fixed values of the method."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeatureRules:
    min_graph_coverage: float = 0.95
    flank_bp: int = 1000


@dataclass(frozen=True)
class HitRules:
    min_coverage: float = 0.5
    min_identity: float = 0.0
    tie_identity: float = 0.001
    tie_coverage: float = 0.01
    tie_aligned_bp: int = 10


@dataclass(frozen=True)
class LocusRules:
    anchor_k: int = 3
    max_mid_anchors: int | None = None  # all windows
    exact_ro: float = 0.95
    exact_size: float = 0.95
    exact_ctx: float = 0.80
    ro_min: float = 0.50
    ro_ctx: float = 0.30
    szro_ro: float = 0.20
    szro_size: float = 0.67
    szro_ctx: float = 0.50
    weak_seq_gate: float = 0.25
    kmer: int = 9
    ambiguity_margin: float = 0.25
    site_window_bp: int = 100


@dataclass(frozen=True)
class AlleleRules:
    identity: float = 0.80
    min_len_ratio: float = 0.80
    mode: str = "allpairs_clique"
    representative: str = "asm_seq_medoid"
    match: int = 2
    mismatch: int = -3
    gap_open: int = 5
    gap_extend: int = 2
    ends: str = "free"  # or "global": both sequences end to end, with the penalties of long sequences


@dataclass(frozen=True)
class CallRules:
    windows: tuple[int, ...] = (100, 1000, 10000)
    min_bp: int = 50
    min_fraction: float = 0.05
    margin: float = 0.02
    gap_penalty: float = 0.0
    repeat_power: float = 0.0
    span_tolerance: int = 10000
    placement_tolerance: int = 1000
    context_bp: int = 1_000_000
