"""Lookups in memo tables: ask once per distinct key, fan the answer back out.

Distinct keys come first (a map-side combine), so however many rows share a key it is looked up once.
The fan-out joins plain rows with one row per key; adaptive execution splits a hot key's rows there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import route_key
from ..functions.numbers import round_half_up
from ..functions.patterns import first_group, trimmed
from ..functions.skew import scattered
from ..functions.text import building_address, house_number_of, number_key, postcode_of, street_matches, street_of
from ..sources.caches import LICENSED_SOURCE, position_expired

# ---- Fixed values: literal coordinates -----------------------------------------------------
LATLNG = r"^\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*$"
# -------------------------------------------------------------------------------------------


def position_key(query: Column, locality: bool = False) -> Column:
    """Cache key of a query, null when it is blank; localities live in a namespace of their own."""
    text = F.lower(trimmed(query))
    return F.when(text != "", F.concat(F.lit("locality|" if locality else ""), text))


def look_up_positions(queries: DataFrame, positions: DataFrame, now_ms: Column, locality: bool = False,
                      answers: DataFrame | None = None) -> DataFrame:
    """Every row of ``queries`` (``id, query``) with its position, ``source`` and ``cached``, or nulls.

    ``positions``: ``key, lat, lng, precision, src, at``. ``answers``: what a geocoder just said for
    keys the cache could not answer. With no new answer a permanent entry is served, an expired
    licensed one never is.
    """
    asked = queries.withColumn("key", position_key(F.col("query"), locality))
    wanted = asked.select("key").filter("key is not null").distinct()
    src = F.coalesce("src", F.lit("osm"))
    usable = positions.filter(~position_expired(F.col("src"), F.col("at"), now_ms)).select(
        "key", "lat", "lng", "precision", src.alias("source"), F.lit(True).alias("cached")
    )
    found = wanted.join(usable, "key", "left")
    if answers is not None:
        fresh = answers.select(
            "key", F.struct("lat", "lng", "precision", "source", F.lit(False).alias("cached")).alias("fresh")
        )
        hit = F.struct("lat", "lng", "precision", "source", "cached")
        found = found.join(fresh, "key", "left").select(
            "key", F.when(F.col("cached"), hit).otherwise(F.col("fresh")).alias("p")
        ).select("key", "p.*")
    # Blank queries have no key: scattered, so they do not meet in one task.
    spread = asked.withColumn("_key", scattered(F.col("key"), *queries.columns))
    return spread.join(found.withColumnRenamed("key", "_key"), "_key", "left").drop("_key")


def look_up_buildings(listings: DataFrame, positions: DataFrame, now_ms: Column) -> DataFrame:
    """One lookup per building, however many listings it holds; rows keep their own columns."""
    keyed = listings.withColumn("building", F.lower(building_address(F.col("address"))))
    buildings = keyed.select("building").distinct()
    answered = look_up_positions(
        buildings.select(F.col("building").alias("id"), F.col("building").alias("query")), positions, now_ms
    ).select(F.col("id").alias("building"), "lat", "lng", "precision", "source", "cached")
    # Rows without a building, or with a blank one, are answered by nothing: scattered, so they do not meet in one task.
    spread = keyed.withColumn("_key", scattered(F.nullif("building", F.lit("")), *listings.columns))
    return spread.join(answered.withColumnRenamed("building", "_key"), "_key", "left").drop("_key")


def resolve_origins(queries: DataFrame, positions: DataFrame, now_ms: Column) -> DataFrame:
    """Origins: bounded ``lat,lng`` text is taken as it is, anything else goes through the cache."""
    lat = first_group(F.col("query"), LATLNG, 1).try_cast("double")
    lng = first_group(F.col("query"), LATLNG, 2).try_cast("double")
    bounded = (F.abs(lat) <= 90) & (F.abs(lng) <= 180)
    parsed = queries.withColumn(
        "_direct", F.when(bounded, F.struct(lat.alias("lat"), lng.alias("lng"), F.lit("building").alias("precision")))
    )
    found = look_up_positions(parsed, positions, now_ms)
    return found.select(
        *queries.columns,
        *[F.coalesce(F.col("_direct")[name], F.col(name)).alias(name) for name in ("lat", "lng", "precision")],
        F.when(F.col("_direct").isNotNull(), F.lit("given")).otherwise(F.col("source")).alias("source"),
    )


def with_route_key(located: DataFrame, mode: Column, origin_lat: Column, origin_lon: Column,
                   when: Column | None = None, provider: Column | None = None) -> DataFrame:
    return located.withColumn(
        "route_key", route_key(mode, origin_lat, origin_lon, F.col("lat"), F.col("lon"), when, provider)
    )


def look_up_routes(keyed: DataFrame, routes: DataFrame) -> DataFrame:
    """Add ``travel`` from the route cache (``key, minutes, km``); null is a miss. Unlocated rows stay."""
    wanted = keyed.select("route_key").filter("route_key is not null").distinct()
    measured = routes.select(
        F.col("key").alias("route_key"),
        F.struct(
            round_half_up(F.col("minutes"), 1).alias("minutes"), round_half_up(F.col("km"), 2).alias("km")
        ).alias("travel"),
    )
    found = wanted.join(measured, "route_key").withColumnRenamed("route_key", "_key")
    spread = keyed.withColumn("_key", scattered(F.col("route_key"), "listing_id"))
    return spread.join(found, "_key", "left").drop("_key")


def missing_routes(keyed: DataFrame, routes: DataFrame) -> DataFrame:
    """Distinct routes nobody has measured, with how many rows wait for each."""
    waiting = keyed.filter("route_key is not null").groupBy("route_key").agg(F.count("*").alias("waiting"))
    return waiting.join(routes.select(F.col("key").alias("route_key")), "route_key", "left_anti")


def backfill(listings: DataFrame, measured: DataFrame, precision: DataFrame, mode: str, computed_at: str) -> DataFrame:
    """One mode's measured times onto all located listings; ``routed`` false where nothing answered.

    ``measured``: ``listing_id, minutes, km``. ``precision``: what earlier runs recorded (default street).
    """
    located = listings.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    legs = measured.select(
        "listing_id", round_half_up(F.col("minutes"), 1).alias("minutes"), round_half_up(F.col("km"), 2).alias("km")
    )
    known = precision.select("listing_id", F.col("precision").alias("_precision"))
    located = located.select("listing_id", "address")
    return located.join(legs, "listing_id", "left").join(known, "listing_id", "left").select(
        "listing_id", "minutes", "km", F.lit(mode).alias("mode"),
        F.coalesce("_precision", F.lit("street")).alias("precision"),
        F.lit(computed_at).alias("computed_at"), "address",
        F.col("minutes").isNotNull().alias("routed"),
    )


def fold_measured(ledger: DataFrame, answers: DataFrame, column: str) -> DataFrame:
    """New answers by id onto the ledger; rows nobody answered keep what they had."""
    new = answers.select("listing_id", F.col(column).alias("_new"))
    return ledger.join(new, "listing_id", "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def resolve_addresses(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Best geocoder candidate per query: right postcode, right street, exact house number preferred.

    ``queries``: ``query_id, address``. ``candidates``: ``query_id, rank, street, name, is_street,
    house_number, postcode, lat, lon``. The pick is a combinable minimum, so no query's candidates
    are gathered.
    """
    wanted = queries.select(
        "query_id",
        street_of(F.col("address")).alias("want_street"),
        postcode_of(F.col("address")).alias("want_postcode"),
        house_number_of(F.col("address")).alias("want_number"),
    )
    offered = candidates.join(wanted, "query_id").filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    right_area = (
        F.col("want_postcode").isNull() | F.col("postcode").isNull() | (F.col("postcode") == F.col("want_postcode"))
    )
    # A name only stands for a street when the feature is one: a hotel's name must not match a street.
    named = F.when(F.coalesce("street", F.lit("")) != "", F.col("street")).when(F.col("is_street"), F.col("name"))
    on_street = offered.filter(right_area & street_matches(named, F.col("want_street")))
    exact = F.coalesce(
        (F.coalesce("house_number", F.lit("")) != "") & (number_key(F.col("house_number")) == F.col("want_number")),
        F.lit(False),
    )
    best = on_street.withColumn("exact", exact).groupBy("query_id").agg(
        F.min_by(F.struct("lat", "lon", "exact", "rank"), F.struct(~F.col("exact"), "rank")).alias("best")
    )
    return queries.select("query_id").join(best, "query_id", "left").select(
        "query_id", "best.lat", "best.lon",
        F.when(F.col("best.exact"), F.lit("building")).when(F.col("best").isNotNull(), F.lit("street"))
        .alias("precision"),
        F.col("best.rank").alias("rank"),
    )


def licensed_share(positions: DataFrame) -> DataFrame:
    """How many cached positions each source contributed."""
    return positions.groupBy(F.coalesce("src", F.lit("osm")).alias("source")).agg(
        F.count("*").alias("positions"), F.count_if(F.col("src") == LICENSED_SOURCE).alias("licensed")
    )
