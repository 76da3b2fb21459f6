"""Declared schemas, as DDL text: nothing is inferred on read."""

from __future__ import annotations

TRAVEL = "minutes: DOUBLE, km: DOUBLE, mode: STRING, precision: STRING"

SOURCE_LISTING = f"""
    id: STRING, url: STRING, address: STRING, suburb: STRING, state: STRING, postcode: STRING,
    price: STRING, propertyType: STRING, bedrooms: INT, bathrooms: INT, carSpaces: INT, studies: INT,
    landSize: STRING, buildingSize: STRING, description: STRING,
    images: ARRAY<STRING>, floorplans: ARRAY<STRING>,
    coords: STRUCT<lat: DOUBLE, lng: DOUBLE>, travel: STRUCT<{TRAVEL}>, isSurrounding: BOOLEAN
"""

REJECTION = f"""
    id: STRING, url: STRING, address: STRING, suburb: STRING, state: STRING, postcode: STRING,
    coords: STRUCT<lat: DOUBLE, lng: DOUBLE>, travel: STRUCT<{TRAVEL}>
"""

TRAVEL_REPORT = """
    origin: STRING, mode: STRING, router: STRING, geocoder: STRING, listings: INT, routed: INT,
    precision: STRUCT<building: INT, street: INT, area: INT>, unresolved: INT,
    geocode_calls: INT, matrix_calls: INT, unique_buildings: INT, cached_buildings: INT
"""

CAPTURE = f"""
    source STRING, captured_at STRING, commentary STRING, searched_locations ARRAY<STRING>,
    gone MAP<STRING, STRING>,
    groups ARRAY<STRUCT<
        origin: STRING, mode: STRING, max_travel_minutes: DOUBLE, arrive_by: STRING,
        locations_searched: ARRAY<STRING>, travel_report: STRUCT<{TRAVEL_REPORT}>,
        results: ARRAY<STRUCT<{SOURCE_LISTING}>>, filtered_by_travel: ARRAY<STRUCT<{REJECTION}>>>>,
    results ARRAY<STRUCT<{SOURCE_LISTING}>>
"""

POI_ELEMENT = """
    type STRING, id BIGINT, lat DOUBLE, lon DOUBLE,
    center STRUCT<lat: DOUBLE, lon: DOUBLE>, tags MAP<STRING, STRING>
"""

CACHE_FILE = """
    routes MAP<STRING, STRUCT<minutes: DOUBLE, km: DOUBLE, ferryAvailable: BOOLEAN>>,
    geo MAP<STRING, STRUCT<lat: DOUBLE, lng: DOUBLE, precision: STRING, src: STRING, at: BIGINT>>
"""

PLACE = "status: STRING, source: STRING, name: STRING, walk_minutes: DOUBLE, distance_m: INT"
WALKABILITY = f"cafe: STRUCT<{PLACE}>, supermarket: STRUCT<{PLACE}, is_major_chain: BOOLEAN>, gym: STRUCT<{PLACE}>"

# What the ledger keeps: when, under which configuration and where the block was measured.
CACHED_WALKABILITY = f"computed_at: STRING, config_hash: STRING, lat: DOUBLE, lon: DOUBLE, {WALKABILITY}"

COMPOSITION = """
    source: STRING, ferry_available: BOOLEAN,
    legs: ARRAY<STRUCT<product_class: INT, service: STRING, service_description: STRING,
                       `from`: STRING, `to`: STRING, minutes: DOUBLE, metres: DOUBLE>>,
    walk_metres: DOUBLE, service_minutes: DOUBLE, wait_minutes: DOUBLE, walk_speed_kmh: DOUBLE,
    is_walk: BOOLEAN, has_ferry: BOOLEAN, interchanges: INT, provider_minutes: DOUBLE
"""
MISLABELLED = "actually: STRING, implied_kmh: DOUBLE, threshold_kmh: DOUBLE, ferry_available: BOOLEAN"
CACHED_TRAVEL = f"{TRAVEL}, composition: STRUCT<{COMPOSITION}>, mislabelled: STRUCT<{MISLABELLED}>, computed_at: STRING, address: STRING"

LEDGER = f"""
    listing_id STRING, url STRING, address STRING, suburb STRING, postcode STRING,
    lat DOUBLE, lon DOUBLE, first_seen_run STRING, last_seen_run STRING, status STRING,
    status_history ARRAY<STRUCT<run: STRING, status: STRING>>,
    price_history ARRAY<STRUCT<run: STRING, price_pw: INT>>,
    relist_count INT,
    facts_last STRUCT<beds: INT, baths: INT, car_spaces: INT, area_sqm: INT>,
    image_urls ARRAY<STRING>, image_files ARRAY<STRING>,
    cached_travel MAP<STRING, STRUCT<{CACHED_TRAVEL}>>,
    walkability STRUCT<{CACHED_WALKABILITY}>
"""

REJECTED = f"""
    listing_id STRING, url STRING, address STRING, lat DOUBLE, lon DOUBLE,
    travel MAP<STRING, STRUCT<{TRAVEL}, computed_at: STRING, address: STRING>>, last_seen_run STRING
"""

PROFILE = """
    suburb_key STRING, name STRING, postcode STRING, lat DOUBLE, lon DOUBLE,
    crime_lower_than_pct DOUBLE, income_decile INT,
    published_rents MAP<STRING, INT>, observed_rents MAP<STRING, INT>
"""

MANIFEST = "run_id STRING, position BIGINT, listing_count BIGINT, new_count BIGINT, criteria_version INT, date STRING, created_at STRING, label STRING"
