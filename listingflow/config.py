"""Plain configuration: what a run wants, never what it found."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from .functions.numbers import Curve

# ---- Fixed values: key sets the scoring model and the search rules are defined over -------
FACTOR_KEYS = [
    "price", "space", "car_space", "commute", "drive",
    "walk_cafe", "walk_supermarket", "walk_gym", "suburb",
]
TRAVEL_MODES = ["walk", "drive", "transit"]
POI_KINDS = ["cafe", "supermarket", "gym"]
# -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Dealbreakers:
    hard_cap_pw: float
    min_beds: int
    min_baths: int
    require_car_space: bool
    max_commute_minutes: float


@dataclass(frozen=True)
class Walking:
    detour_factor: float
    speed_m_per_min: float
    poi_radius_m: float


@dataclass(frozen=True)
class Scoring:
    """Weights per factor, curves per curved factor, and the rules that filter after scoring."""

    weights: Mapping[str, float]
    curves: Mapping[str, Curve]
    dealbreakers: Dealbreakers
    target_price_pw: float
    preferred_suburbs: Sequence[str] = ()
    commute_origin: str = "office"

    def __post_init__(self):
        if set(self.weights) != set(FACTOR_KEYS):
            raise ValueError(f"weights must name exactly {FACTOR_KEYS}")


@dataclass(frozen=True)
class Envelope:
    """The widest question a capture may ask."""

    max_price_pw: float
    min_beds: int
    locations: Sequence[str] = ()
    exclude_keywords: Sequence[str] = ()


@dataclass(frozen=True)
class LocationRule:
    within_indicative_minutes: float | None = None
    within_km: float | None = None
    mode: str | None = None


@dataclass(frozen=True)
class SavedSearch:
    search_id: str
    origin: str
    mode: str
    max_minutes: float
    label: str = ""
    min_price_pw: float | None = None
    max_price_pw: float | None = None
    min_beds: int | None = None
    max_beds: int | None = None
    min_baths: int | None = None
    min_car_spaces: int | None = None
    property_types: Sequence[str] | None = None
    exclude_flagged: Sequence[str] = field(default_factory=tuple)
    locations: Sequence[str] | LocationRule | None = None

    @property
    def travel_key(self) -> str:
        return f"{self.origin}:{self.mode}"
