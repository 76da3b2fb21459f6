"""The enrichment block of a listing: commute from its travel map, walkability from its cached POIs.

Four statuses: ``ok``; ``fallback`` (degraded, still scored); ``none_found`` (asked, nothing
there: a signal); ``unavailable`` (nobody knows: sits out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import POI_KINDS


def empty_place(with_chain: bool = False) -> Column:
    fields = [
        F.lit("unavailable").alias("status"),
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("double").alias("walk_minutes"),
        F.lit(None).cast("int").alias("distance_m"),
    ]
    if with_chain:
        fields.append(F.lit(None).cast("boolean").alias("is_major_chain"))
    return F.struct(*fields)


def empty_walkability() -> Column:
    return F.struct(*[empty_place(kind == "supermarket").alias(kind) for kind in POI_KINDS])


def commute_block(travel: Column, origin: str, source: str) -> Column:
    """``struct<walk, transit, drive>`` read from ``travel`` (map keyed ``origin:mode``).

    A transit entry keeps a null interchange count on purpose: a routed total has no legs, and
    an unknown count adds no penalty.
    """

    def leg(mode: str) -> Column:
        entry = F.try_element_at(travel, F.lit(f"{origin}:{mode}"))
        known = entry.isNotNull()
        status = (
            F.when(~known, F.lit("unavailable"))
            .when(entry["precision"] == "area", F.lit("fallback"))
            .otherwise(F.lit("ok"))
        )
        fields = [
            status.alias("status"),
            F.when(known, F.lit(source)).alias("source"),
            entry["minutes"].alias("minutes"),
        ]
        if mode == "transit":
            fields.append(F.lit(None).cast("int").alias("interchanges"))
        else:
            fields.append(entry["km"].alias("distance_km"))
        return F.struct(*fields)

    return F.struct(*[leg(mode).alias(mode) for mode in ("walk", "transit", "drive")])


def with_enrichment(listings: DataFrame, origin: str, source: str, travel: str = "travel",
                    walkability: str = "walkability") -> DataFrame:
    """Add ``enrichment{commute, walkability}``; a null cached walkability block stays unavailable. Of a cached block only
    the places are shown."""
    cached = F.col(walkability)
    places = F.when(cached.isNotNull(), F.struct(*[cached[kind].alias(kind) for kind in POI_KINDS]))
    return listings.withColumn(
        "enrichment",
        F.struct(
            commute_block(F.col(travel), origin, source).alias("commute"),
            F.coalesce(places, empty_walkability()).alias("walkability"),
        ),
    )


def unanswered(enrichment: Column) -> Column:
    """Names of unanswered questions. The commute is one question (walk or transit); drive is none."""
    commute, places = enrichment["commute"], enrichment["walkability"]
    no_commute = (commute["walk"]["status"] == "unavailable") & (commute["transit"]["status"] == "unavailable")
    names = [F.when(no_commute, F.lit("commute"))]
    names += [F.when(places[kind]["status"] == "unavailable", F.lit(kind)) for kind in POI_KINDS]
    return F.array_compact(F.array(*names))


# ---- Fixed values: flag names in published order, and the cheapness ratio ------------------
CHEAP_RATIO = 0.5
FLAGS = [
    "no_sqm", "no_price", "no_latlon", "enrichment_incomplete",
    "images_failed", "suspiciously_cheap", "share_house", "studio",
]
# -------------------------------------------------------------------------------------------


def listing_flags(target_price_pw: float, enrichment: Column | None = None, photo_count: Column | None = None) -> Column:
    """Flags over the columns of a normalised listing.

    Without ``enrichment`` or ``photo_count`` the flags that need them are left off. That partial
    answer may only exclude, never admit: filters reject on flags and never require one.
    """
    never = F.lit(False)
    raised = {
        "no_sqm": F.col("area_sqm").isNull(),
        "no_price": F.col("price_pw").isNull(),
        "no_latlon": F.col("lat").isNull() | F.col("lon").isNull(),
        "enrichment_incomplete": never if enrichment is None else F.size(unanswered(enrichment)) > 0,
        "images_failed": never if photo_count is None else photo_count == 0,
        "suspiciously_cheap": F.col("price_pw") < target_price_pw * CHEAP_RATIO,
        "share_house": F.size("share_signals") > 0,
        "studio": F.size("studio_signals") > 0,
    }
    return F.array_compact(F.array(*[F.when(raised[name], F.lit(name)) for name in FLAGS]))


def missing_enrichment(listings: DataFrame) -> DataFrame:
    """One row: which blocks answered for no listing at all (``missing``), and the note text about it."""

    def anyone(*statuses: Column) -> Column:
        known = [F.coalesce(s != "unavailable", F.lit(False)) for s in statuses]
        hit = known[0]
        for k in known[1:]:
            hit = hit | k
        return F.bool_or(hit)

    e = F.col("enrichment")
    answered = listings.agg(
        anyone(e["commute"]["walk"]["status"], e["commute"]["transit"]["status"]).alias("commute"),
        anyone(*[e["walkability"][kind]["status"] for kind in POI_KINDS]).alias("walkability"),
    )
    # bool_or over no rows is null: an empty run has nothing to report.
    missing = F.array_compact(
        F.array(
            F.when(~F.col("commute"), F.lit("a routed commute time")),
            F.when(~F.col("walkability"), F.lit("walkability")),
        )
    )
    return answered.select(missing.alias("missing")).withColumn("note", enrichment_note(F.col("missing")))


# ---- Fixed values: note wording ------------------------------------------------------------
NOTE_PREFIX = "No listing in this run has"
OLD_NOTE_PREFIX = "Enrichment has not run"
NOTE = (
    "%s %s, so the scoring factor%s sat out of every composite and confidence is lower than a fully enriched run's. "
    "Run the enrich stages and replay this run to fill %s in."
)
# -------------------------------------------------------------------------------------------


def enrichment_note(missing: Column) -> Column:
    many = F.size(missing) > 1
    which = F.when(many, F.lit("s that read them")).otherwise(F.lit(" that reads it"))
    what = F.when(many, F.lit("them")).otherwise(F.lit("it"))
    return F.when(F.size(missing) > 0, F.format_string(NOTE, F.lit(NOTE_PREFIX), F.array_join(missing, " or "), which, what))


def run_notes(note: Column, carried: Column) -> Column:
    """The note as it stands now, then every carried note that is not an earlier enrichment note."""
    kept = F.filter(
        F.coalesce(carried, F.array().cast("array<string>")),
        lambda n: ~(n.startswith(NOTE_PREFIX) | n.startswith(OLD_NOTE_PREFIX)),
    )
    return F.concat(F.array_compact(F.array(note)), kept)
