"""Suburbs and envelope places: where they are, what was asked there, how far they lie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km, haversine_m
from ..functions.numbers import round_half_up, whole
from ..functions.text import suburb_key

# ---- Fixed values: thresholds ---------------------------------------------------------------
SAME_POINT_M = 1
MIN_SAMPLE = 5
KEEP_UNMEASURED_KM = 30
# -------------------------------------------------------------------------------------------


def with_suburb_key(rows: DataFrame, name: str = "name", postcode: str = "postcode") -> DataFrame:
    return rows.withColumn("suburb_key", suburb_key(F.col(name), F.col(postcode)))


def repeated_keys(places: DataFrame) -> DataFrame:
    """Suburb keys that more than one place claims; must be empty before the dimension is joined."""
    return places.groupBy("suburb_key").agg(F.count("*").alias("places")).filter("places > 1")


def with_profile(listings: DataFrame, profiles: DataFrame) -> DataFrame:
    """Add ``profile`` (struct, null for an unknown suburb).

    No broadcast hint: the planner broadcasts the dimension when its measured size allows, and
    splits hot suburbs of a sort-merge join otherwise.
    """
    rest = [c for c in profiles.columns if c != "suburb_key"]
    return listings.join(profiles.select("suburb_key", F.struct(*rest).alias("profile")), "suburb_key", "left")


def listing_centroids(listings: DataFrame) -> DataFrame:
    """Mean position of the located listings of each suburb, six decimals."""
    return (
        listings.filter("lat is not null and lon is not null")
        .groupBy("suburb_key")
        .agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count("*").alias("located"))
        .select("suburb_key", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "located")
    )


def place_suburbs(listings: DataFrame, envelope: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``suburb_key, lat, lon, source``: listings, then the envelope, then the gazetteer, else nulls."""
    keys = listings.select("suburb_key").distinct()

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("suburb_key", F.struct("lat", "lon", F.lit(name).alias("source")).alias(name))

    placed = keys
    for rows, name in ((listing_centroids(listings), "listings"), (envelope, "envelope"), (gazetteer, "gazetteer")):
        placed = placed.join(side(rows, name), "suburb_key", "left")
    chosen = placed.select("suburb_key", F.coalesce("listings", "envelope", "gazetteer").alias("p"))
    return chosen.select("suburb_key", "p.lat", "p.lon", "p.source")


def new_suburbs(listings: DataFrame, profiles: DataFrame, envelope: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Suburbs without a profile, placed where possible; ``placeable`` tells a stub from a problem."""
    fresh = listings.join(profiles.select("suburb_key"), "suburb_key", "left_anti")
    named = fresh.groupBy("suburb_key").agg(
        F.min(F.struct("listing_id", "suburb", "postcode")).alias("first"), F.count("*").alias("listings")
    )
    return named.join(place_suburbs(fresh, envelope, gazetteer), "suburb_key").select(
        "suburb_key", F.col("first.suburb").alias("name"), "first.postcode", "listings", "lat", "lon", "source",
        F.col("lat").isNotNull().alias("placeable"),
    )


def centroid_corrections(profiles: DataFrame, envelope: DataFrame) -> DataFrame:
    """Profiles more than a metre from their envelope place, farthest first."""
    p, e = profiles.alias("p"), envelope.alias("e")
    metres = haversine_m(F.col("p.lat"), F.col("p.lon"), F.col("e.lat"), F.col("e.lon"))
    return (
        p.join(e, "suburb_key")
        .select(
            "suburb_key", F.col("p.lat").alias("from_lat"), F.col("p.lon").alias("from_lon"),
            F.col("e.lat").alias("to_lat"), F.col("e.lon").alias("to_lon"), metres.alias("metres"),
        )
        .filter(F.col("metres") > SAME_POINT_M)
        .orderBy(F.desc("metres"), "suburb_key")
    )


def realigned(profiles: DataFrame, corrections: DataFrame) -> DataFrame:
    fixes = corrections.select("suburb_key", "to_lat", "to_lon")
    return profiles.join(fixes, "suburb_key", "left").withColumns(
        {"lat": F.coalesce("to_lat", "lat"), "lon": F.coalesce("to_lon", "lon")}
    ).drop("to_lat", "to_lon")


def observed_medians(listings: DataFrame, group: list[str], price: str = "price_pw", min_sample: int = MIN_SAMPLE) -> DataFrame:
    """Median asked price of every group with enough priced rows, rounded to whole dollars.

    Equal prices collapse to counts first, so a hot group reaches the second aggregate as its
    distinct prices, not its rows.
    """
    counts = listings.filter(F.col(price) > 0).groupBy(*group, price).agg(F.count("*").alias("n"))
    return (
        counts.groupBy(*group)
        .agg(F.percentile(price, F.lit(0.5), F.col("n")).alias("median"), F.sum("n").alias("sample"))
        .filter(F.col("sample") >= min_sample)
        .select(*group, whole(F.col("median")).alias("median_pw"), "sample")
    )


def observed_rents(listings: DataFrame, run_id: str, computed_at: str, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """Per suburb: medians and samples by bedroom count as maps, and how many priced rows were seen.

    Suburbs where no bedroom count reaches the sample have no row.
    """
    medians = observed_medians(listings, ["suburb_key", "beds"], min_sample=min_sample)
    # One entry per bedroom count: bounded by the number of bedroom counts.
    maps = medians.groupBy("suburb_key").agg(
        F.array_sort(F.collect_list(F.struct(F.col("beds").cast("string").alias("beds"), "median_pw", "sample"))).alias("b")
    )
    considered = listings.filter("price_pw > 0").groupBy("suburb_key").agg(F.count("*").alias("considered"))

    def by_beds(name: str) -> Column:
        return F.map_from_entries(F.transform("b", lambda x: F.struct(x["beds"], x[name])))

    return maps.join(considered, "suburb_key").select(
        "suburb_key", by_beds("median_pw").alias("median_pw_by_beds"), by_beds("sample").alias("sample_by_beds"),
        "considered", F.lit(min_sample).alias("min_sample"), F.lit(run_id).alias("run_id"),
        F.lit(computed_at).alias("computed_at"),
    )


# ---- the envelope ---------------------------------------------------------------------------


def distinct_places(found: DataFrame, postcode_from: int, postcode_to: int) -> DataFrame:
    """Enumerated places, one per canonical name, only those really in the postcode asked for."""
    real = found.filter(
        F.col("kind").isin("suburb", "precinct") & F.col("name").isNotNull()
        & (F.col("postcode") == F.col("asked_postcode"))
        & F.col("postcode").try_cast("int").between(postcode_from, postcode_to)
    ).withColumn("canonical", F.concat_ws(" ", "name", "state", "postcode"))
    rest = [c for c in real.columns if c not in ("canonical", "asked_pos")]
    return real.groupBy("canonical").agg(F.min_by(F.struct(*rest), "asked_pos").alias("place")).select("canonical", "place.*")


def envelope(places: DataFrame, origin_lat: float, origin_lon: float, travel_key: str,
             max_minutes: float | None = None, max_km: float = 25.0,
             keep_unmeasured_km: float = KEEP_UNMEASURED_KM) -> DataFrame:
    """Places within the cut, quickest first, unmeasured last, then by distance.

    With ``max_minutes`` the measured time decides and an unmeasured place is kept only where being
    unmeasured would be surprising; without it the straight line decides.
    """
    km = haversine_km(F.lit(float(origin_lat)), F.lit(float(origin_lon)), F.col("lat"), F.col("lon"))
    measured = places.filter("lat is not null and lon is not null").select(
        *places.columns, km.alias("km"),
        F.try_element_at("indicative_minutes", F.lit(travel_key)).alias("minutes"),
    )
    if max_minutes is None:
        kept = measured.filter(F.col("km") <= max_km)
    else:
        kept = measured.filter(
            F.when(F.col("minutes").isNull(), F.col("km") <= keep_unmeasured_km).otherwise(F.col("minutes") <= max_minutes)
        )
    return kept.orderBy(F.col("minutes").asc_nulls_last(), "km", "canonical")


def tagged_places(selected: DataFrame, origin: str) -> DataFrame:
    """The published form of envelope places: distances rounded, keyed by origin."""
    return selected.select(
        "canonical", "name", "state", "postcode",
        F.when(F.col("kind") == "precinct", F.lit("precinct")).otherwise(F.lit("suburb")).alias("kind"),
        "lat", "lon", F.create_map(F.lit(origin), round_half_up(F.col("km"), 2)).alias("km_from"), "indicative_minutes",
    )


def postcode_gaps(gazetteer: DataFrame, configured: DataFrame) -> DataFrame:
    """Per envelope postcode: places found, places configured, places missing (names compared without case)."""
    wanted = configured.select(
        F.lower("canonical").alias("known"), F.regexp_extract("canonical", r"(\d{4})\s*$", 1).alias("postcode")
    )
    codes = wanted.filter("postcode <> ''").select("postcode").distinct()
    found = gazetteer.filter(F.col("kind").isin("suburb", "precinct")).join(codes, "postcode", "left_semi")
    marked = found.withColumn("known", F.lower("canonical")).join(
        wanted.select("known", F.lit(True).alias("in_envelope")).distinct(), "known", "left"
    )
    return marked.groupBy("postcode").agg(
        F.count("*").alias("places"),
        F.count("in_envelope").alias("in_envelope"),
        F.count_if(F.col("in_envelope").isNull()).alias("missing"),
    )
