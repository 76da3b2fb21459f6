"""Capture rows: one row per listing, whatever passes returned it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import trimmed

# Capture rows carry: capture_id?, travel_key (null on the legacy flat form), group_pos, row_pos, listing_id, travel
POSITION = ["group_pos", "row_pos"]


def _position() -> Column:
    return F.struct(*POSITION)


def unique_listings(rows: DataFrame, facts: list[str]) -> DataFrame:
    """``listing_id``, the facts of its first occurrence, and ``travel``: per key the last measured time.

    Both aggregates combine on the map side, so a listing that fills a third of the capture
    shrinks to one row per input partition before the shuffle.
    """
    first = rows.groupBy("listing_id").agg(F.min_by(F.struct(*facts), _position()).alias("facts"))
    last = (
        rows.filter(F.col("travel_key").isNotNull() & F.col("travel").isNotNull())
        .groupBy("listing_id", "travel_key")
        .agg(F.max_by("travel", _position()).alias("leg"))
    )
    # One entry per pass and listing: bounded by the number of passes.
    maps = last.groupBy("listing_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("travel_key", "leg")))).alias("travel")
    )
    leg = rows.schema["travel"].dataType.simpleString()
    empty = F.create_map().cast(f"map<string,{leg}>")
    return first.join(maps, "listing_id", "left").select(
        "listing_id", "facts.*", F.coalesce("travel", empty).alias("travel")
    )


def group_totals(rows: DataFrame) -> DataFrame:
    """Listings per pass: ``travel_key, considered``; distinct inside a capture group, groups of one pass add up."""
    group = ["group_pos"] if "group_pos" in rows.columns else []
    return (
        rows.filter("travel_key is not null")
        .select(*group, "travel_key", "listing_id").distinct()
        .groupBy("travel_key").agg(F.count("*").alias("considered"))
    )


def returned_ids(rows: DataFrame) -> DataFrame:
    """Every id the capture returned, usable or not: what absence is tested against."""
    return rows.select("listing_id").distinct()


def blank_addresses(rows: DataFrame) -> DataFrame:
    """Listings whose address is blank in some row, with how many rows and where they start."""
    blank = rows.filter(F.coalesce(trimmed(F.col("address")), F.lit("")) == "")
    return blank.groupBy("listing_id").agg(
        F.count("*").alias("occurrences"), F.min(_position()).alias("first")
    ).select("listing_id", "occurrences", "first.group_pos", "first.row_pos")


def within_budget(rows: DataFrame, max_minutes: float) -> DataFrame:
    """Rows inside the travel budget. An unknown time is kept: it is no evidence of being far."""
    minutes = F.col("travel.minutes")
    return rows.filter(minutes.isNull() | (minutes <= max_minutes))


def over_budget(rows: DataFrame, max_minutes: float) -> DataFrame:
    """What the budget rejects: identity, position and time only."""
    return rows.filter(F.col("travel.minutes") > max_minutes).select(
        "listing_id", "url", "address", "suburb", "state", "postcode", "coords", "travel"
    )


def nearest_first(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.col("travel.minutes").asc_nulls_last(), F.col("listing_id"))


# ---- travel reports -----------------------------------------------------------------------

REPORT_COUNTS = [
    "listings", "routed", "building", "street", "area", "unresolved",
    "geocode_calls", "matrix_calls", "unique_buildings", "cached_buildings",
]
REPORT_LABELS = ["origin", "mode", "router", "geocoder"]


def accumulate_reports(pages: DataFrame, key: str) -> DataFrame:
    """Page reports to one per ``key``: first known label, summed counters; no report, no row.

    ``pages`` has ``page_pos``, the labels, the counters, and ``reported`` (false: the page had none).
    """
    seen = pages.filter("reported")
    return seen.groupBy(key).agg(
        *[
            F.min_by(name, F.when(F.col(name).isNotNull(), F.col("page_pos"))).alias(name)
            for name in REPORT_LABELS
        ],
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in REPORT_COUNTS],
    )


def travel_report(items: DataFrame, by: list[str]) -> DataFrame:
    """How well a pass was measured. ``items``: building, coords, travel (null when not routed)."""
    precision = F.col("travel.precision")
    routed = F.col("travel").isNotNull()
    per_building = items.groupBy(*by, "building").agg(
        F.count("*").alias("n"),
        F.count_if(routed).alias("routed"),
        *[F.count_if(routed & (precision == p)).alias(f"_{p}") for p in ("building", "street", "area")],
    )
    return per_building.groupBy(*by).agg(
        F.sum("n").alias("listings"),
        F.count("*").alias("unique_buildings"),
        F.sum("routed").alias("routed"),
        (F.sum("n") - F.sum("routed")).alias("unresolved"),
        *[F.sum(f"_{p}").alias(p) for p in ("building", "street", "area")],
    )


def funnel(listings: DataFrame, row_count: Column, excluded: Column, problem: Column, matched: Column) -> DataFrame:
    """Counts along a build in one pass: rows, unique, usable, excluded, matched."""
    usable = excluded.isNull() & problem.isNull()
    return listings.agg(
        F.sum(row_count).alias("captured"),
        F.count("*").alias("unique_listings"),
        F.count_if(usable).alias("usable"),
        F.count_if(excluded.isNotNull()).alias("excluded"),
        F.count_if(excluded.isNull() & problem.isNotNull()).alias("problems"),
        F.count_if(usable & matched).alias("matched"),
    )


def coverage(envelope: DataFrame, searched: DataFrame) -> DataFrame:
    """Envelope locations that no pass searched."""
    return envelope.join(searched.select("location").distinct(), "location", "left_anti")


def searched_locations(envelope: DataFrame, searched: DataFrame) -> DataFrame:
    """What a capture records as searched: nothing when coverage is full, else the locations covered."""
    missing = coverage(envelope, searched).agg(F.count("*")).scalar()
    return searched.select("location").distinct().filter(missing > 0)
