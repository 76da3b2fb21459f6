"""Configuration the registered queries run with."""

from __future__ import annotations

from listingflow.config import Dealbreakers, Envelope, LocationRule, SavedSearch, Scoring, Walking

SCORING = Scoring(
    weights={
        "price": 25, "space": 12, "car_space": 2, "commute": 27, "drive": 2,
        "walk_cafe": 8, "walk_supermarket": 8, "walk_gym": 6, "suburb": 10,
    },
    curves={
        "price": [(650, 100), (750, 50), (800, 0)],
        "space": [(55, 100), (40, 70), (30, 40), (20, 0)],
        "commute": [(10, 100), (20, 75), (30, 50), (45, 0)],
        "drive": [(10, 100), (40, 0)],
        "walk_cafe": [(5, 100), (10, 60), (20, 0)],
        "walk_supermarket": [(5, 100), (12, 50), (20, 0)],
        "walk_gym": [(8, 100), (15, 50), (20, 10)],
    },
    dealbreakers=Dealbreakers(
        hard_cap_pw=800, min_beds=1, min_baths=1, require_car_space=True, max_commute_minutes=30
    ),
    target_price_pw=650,
    preferred_suburbs=["nation-3-2003", "nation-12-2012"],
)
WALKING = Walking(detour_factor=1.35, speed_m_per_min=80.0, poi_radius_m=1200)
TRAVEL_SOURCE = "router"
KEYWORDS = ["studio", "room", "house boat", "st. cl"]
SEARCHES = [
    SavedSearch("walk-15", "office", "walk", 15, "Walk 15"),
    SavedSearch("walk-30", "office", "walk", 30, "Walk 30", max_price_pw=800, min_beds=1, exclude_flagged=("share_house",),
                locations=LocationRule(within_indicative_minutes=90)),
    SavedSearch("train-25", "office", "transit", 25, "Train 25", max_price_pw=750, min_price_pw=400, min_beds=2, max_beds=3,
                exclude_flagged=("share_house", "studio"), locations=LocationRule(within_indicative_minutes=45)),
    SavedSearch("train-40", "office", "transit", 40, "Train 40", min_baths=2, min_car_spaces=1,
                locations=LocationRule(within_km=20)),
    SavedSearch("drive-20", "office", "drive", 20, "Drive 20", property_types=("apartment", "unit"),
                exclude_flagged=("share_house", "no_price")),
    SavedSearch("drive-45", "office", "drive", 45, "Drive 45", min_price_pw=500,
                locations=("NATION_3 NSW 2003", "NATION_1 NSW 2001", "NATION_9 NSW 2009")),
    SavedSearch("walk-rule", "office", "walk", 50, "Walk by transit rule", max_beds=2,
                locations=LocationRule(within_indicative_minutes=30, within_km=15, mode="transit")),
    SavedSearch("home-10", "home", "walk", 10, "Never asked"),
]
LIMITS = Envelope(max_price_pw=900, min_beds=1)
BAD_SEARCHES = [
    SavedSearch("rich", "office", "walk", 15, max_price_pw=5000),
    SavedSearch("lost", "nowhere", "walk", 5),
    SavedSearch("away", "office", "walk", 15, locations=("Broken Hill NSW 2880", "NATION_1 NSW 2001", "Elsewhere NSW 2999")),
    SavedSearch("floor", "office", "drive", 15, min_beds=0),
    SavedSearch("fine", "office", "walk", 15, locations=LocationRule(within_km=10)),
]
