"""Source listings to normalised listings, or to a problem row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import matches, trimmed
from ..functions.signals import signal_names, with_evidence
from ..functions.text import (
    POSTCODE, address_tail, area_sqm, keyword_hit, property_type, sized_image_url, suburb_key, weekly_rent,
)

DEFAULT_STATE = "NSW"


def with_keyword_hit(rows: DataFrame, keywords: list[str]) -> DataFrame:
    """Add ``excluded_by``: the first keyword that hits the property type or address, else null."""
    return rows.withColumn("excluded_by", keyword_hit(F.col("propertyType"), F.col("address"), keywords))


def _place_columns(rows: DataFrame) -> DataFrame:
    tail = address_tail(F.coalesce("address", F.lit("")))

    def pick(name: str, default: str) -> Column:
        return trimmed(F.coalesce(F.col(name), tail[name], F.lit(default)))

    return rows.withColumns(
        {"_suburb": pick("suburb", ""), "_postcode": pick("postcode", ""), "_state": pick("state", DEFAULT_STATE)}
    )


def problem_reason() -> Column:
    """Why a row cannot become a listing; the first failing check names it."""
    unusable = F.concat(
        F.lit('unusable suburb/postcode ("'), F.col("_suburb"), F.lit('" '), F.col("_postcode"), F.lit(")")
    )
    return (
        F.when(F.coalesce("listing_id", F.lit("")) == "", F.lit("no listing id"))
        .when((F.col("_suburb") == "") | ~matches(F.col("_postcode"), POSTCODE), unusable)
        .when(trimmed(F.coalesce("address", F.lit(""))) == "", F.lit("no address"))
    )


def normalise(rows: DataFrame, url_base: str) -> DataFrame:
    """Typed columns beside ``problem`` (null when usable); one projection, split by the caller."""
    placed = with_evidence(
        _place_columns(rows), "description", "propertyType", "address", "price", "bedrooms"
    ).withColumn("problem", problem_reason())
    area = area_sqm(F.col("buildingSize"))
    return placed.select(
        F.coalesce(F.nullif("listing_id", F.lit("")), F.lit("(missing)")).alias("listing_id"),
        "problem",
        F.coalesce("url", F.concat(F.lit(url_base), "listing_id")).alias("url"),
        trimmed(F.col("address")).alias("address"),
        F.col("_suburb").alias("suburb"),
        F.col("_postcode").alias("postcode"),
        F.col("_state").alias("state"),
        suburb_key(F.col("_suburb"), F.col("_postcode")).alias("suburb_key"),
        F.col("coords.lat").alias("lat"),
        F.col("coords.lng").alias("lon"),
        weekly_rent(F.col("price")).alias("price_pw"),
        trimmed(F.coalesce("price", F.lit(""))).alias("price_text"),
        F.coalesce("bedrooms", F.lit(0)).alias("beds"),
        F.coalesce("bathrooms", F.lit(0)).alias("baths"),
        F.coalesce("carSpaces", F.lit(0)).alias("car_spaces"),
        area.alias("area_sqm"),
        F.when(area.isNotNull(), F.lit("listing_text")).alias("area_source"),
        property_type(F.col("propertyType")).alias("property_type"),
        F.array().cast("array<string>").alias("features"),
        F.coalesce("description", F.lit("")).alias("description"),
        signal_names(F.col("room_evidence")).alias("share_signals"),
        signal_names(F.col("studio_evidence")).alias("studio_signals"),
        "travel",
        F.transform(F.coalesce("images", F.array().cast("array<string>")), lambda u: sized_image_url(u))
        .alias("image_urls"),
        *[c for c in ("excluded_by",) if c in rows.columns],
    )


def usable(normalised: DataFrame) -> DataFrame:
    return normalised.filter("problem is null").drop("problem")


def problems(normalised: DataFrame) -> DataFrame:
    return normalised.filter("problem is not null").select("listing_id", F.col("problem").alias("reason"))
