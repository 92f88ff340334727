"""Settings of the extraction plans; literals fold into the plan when it is built."""

from __future__ import annotations

from dataclasses import dataclass, field

TEXT_FIELDS = ("dealer_name", "model_name")
NUMERIC_FIELDS = ("horse_power", "asset_cost")
VISUAL_FIELDS = ("signature", "stamp")
FIELDS = (*TEXT_FIELDS, *NUMERIC_FIELDS, *VISUAL_FIELDS)
#: Engines in canonical order; ties and "first value" rules follow it.
ENGINES = ("paddle", "deepseek")

# The default dealer list.
DEALERS = (
    "ABC Motors", "XYZ Tractors", "Mahindra Authorized Dealer", "John Deere Agri Services",
    "Swaraj Motors Pvt Ltd", "Sonalika Tractors", "TAFE Dealers", "New Holland India",
)


@dataclass(frozen=True)
class ConflictConfig:
    numeric: float = 0.05
    fuzzy: float = 90.0
    overlap: float = 0.70
    iou: float = 0.5


@dataclass(frozen=True)
class ConsensusConfig:
    weights: dict = field(default_factory=lambda: {"paddle": 0.55, "deepseek": 0.45})
    unknown_weight: float = 0.5
    penalty: float = 0.7


@dataclass(frozen=True)
class LadderConfig:
    mode: str = "full"
    tier1: float = 0.7
    slm: float = 0.6
    jaccard: float = 0.85
    prefilter: float = 90.0
    fallback: float = 0.5
    strict_compat: bool = True

    def __post_init__(self):
        if self.mode not in ("full", "cpu-lite"):
            raise ValueError(f"mode is full or cpu-lite, not {self.mode}")


@dataclass(frozen=True)
class VerifyConfig:
    density: tuple[float, float] = (0.05, 0.30)
    components: int = 5
    circularity: float = 0.5
    rectangularity: float = 0.7
    words: int = 10
    color: float = 0.1


@dataclass(frozen=True)
class CostConfig:
    # Price per call.
    prices: dict = field(default_factory=lambda: {"tier2_slm": 0.001, "tier3_vlm": 0.02})
    max_cost: float = 0.01
    max_latency: float = 30.0
    max_vlm_rate: float = 0.10
