"""From normalised listings to published entries: one chain of projections and one dimension join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Scoring
from ..functions.text import feature_list, photo_paths, price_display, snippet
from ..operators.enrichment import listing_flags, with_enrichment
from ..operators.places import with_profile
from ..operators.scoring import score_listings
from ..operators.travel import EVIDENCE, merge_travel_maps, plain_travel

# Columns a caller brings along: history is passed in, never derived.
HISTORY = ["listing_state", "first_seen_run", "prev_pw", "delta_pw", "image_files", "agent_notes"]


def _with_evidence_fields(captured: Column, cached_leg: T.StructType) -> Column:
    """Captured legs widened to the cached shape: a capture carries no evidence of its own."""
    return F.transform_values(
        captured,
        lambda key, leg: F.struct(
            *[leg[name].alias(name) for name in ("minutes", "km", "mode", "precision")],
            *[F.lit(None).cast(cached_leg[name].dataType).alias(name) for name in EVIDENCE],
        ),
    )


def listing_entries(listings: DataFrame, profiles: DataFrame, scoring: Scoring, travel_source: str) -> DataFrame:
    """The published columns of every listing.

    ``listings``: normalised columns plus the HISTORY columns, ``cached_travel`` (map) and
    ``walkability`` (struct, null when nobody asked). ``captured_travel`` is kept beside the merged
    ``travel``: searches are decided on what the capture returned, display shows what is known.
    """
    leg = listings.schema["cached_travel"].dataType.valueType
    no_cache = F.create_map().cast(listings.schema["cached_travel"].dataType)
    merged = listings.withColumn("captured_travel", F.col("travel")).withColumn(
        "travel",
        merge_travel_maps(
            plain_travel(F.coalesce("cached_travel", no_cache)), _with_evidence_fields(F.col("travel"), leg)
        ),
    )
    enriched = with_enrichment(merged, scoring.commute_origin, travel_source)
    scored = score_listings(with_profile(enriched, profiles), scoring)
    photos = photo_paths(F.col("listing_id"), F.coalesce("image_files", F.array().cast("array<string>")))
    staged = scored.withColumn("photos", photos)
    flags = listing_flags(scoring.target_price_pw, F.col("enrichment"), F.size("photos"))
    return staged.select(
        "listing_id", "url", "address", "suburb", "postcode", "state", "suburb_key", "lat", "lon", "price_pw",
        price_display(F.col("price_text"), F.col("price_pw")).alias("price_display"),
        "beds", "baths", "car_spaces", "area_sqm", "area_source", "property_type",
        feature_list(F.col("features")).alias("features"),
        snippet(F.col("description")).alias("description_snippet"),
        F.struct(
            F.size("photos").alias("count"), F.get("photos", F.lit(0))["src"].alias("hero"), F.col("photos")
        ).alias("images"),
        "travel", "captured_travel", "listing_state", "first_seen_run",
        F.when(F.col("delta_pw").isNotNull(), F.struct("prev_pw", "delta_pw")).alias("price_change"),
        "enrichment", "scores", "agent_notes", flags.alias("flags"), "share_signals", "studio_signals",
    )
