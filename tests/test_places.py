import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listingflow.config import Walking
from listingflow.functions import geo
from listingflow.operators import nearest as N
from listingflow.operators import places as P
from listingflow.operators import travel as T
from listingflow.sources.pois import admit_pois, distinct_pois
from listingflow.schemas import LEDGER, POI_ELEMENT

WALKING = Walking(detour_factor=1.35, speed_m_per_min=80, poi_radius_m=1200)
HOME = (-33.87, 151.2)
POI = "osm_id STRING, kind STRING, name STRING, lat DOUBLE, lon DOUBLE, is_major_chain BOOLEAN"


def metres(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.sin((lon2 - lon1) / 2) ** 2 * math.cos(lat1) * math.cos(lat2)
    return 2 * 6_371_000 * math.asin(math.sqrt(h))


def test_distances(values):
    def hav(a, b):
        return geo.haversine_m(*[F.lit(x) for x in (*a, *b)])

    town, central = (-33.8731, 151.2069), (-33.8832, 151.2069)
    there, back, same, unknown = values(hav(town, central), hav(central, town), hav(town, town), hav(town, (None, 1.0)))
    assert round(there) == 1123 and there == back and same == 0 and unknown is None
    assert values(*[geo.walk_minutes(F.lit(m), 1.35, 80) for m in (290, 1200, 0)]) == [4.9, 20.3, 0.0]
    assert values(geo.implied_speed_kmh(F.lit(1.0), F.lit(0.0)), geo.implied_speed_kmh(F.lit(2.0), F.lit(30.0))) == [None, 4.0]


def test_route_key(values):
    key = geo.route_key(F.lit("transit"), F.lit(-33.8675), F.lit(151.0), F.lit(-33.123456), F.lit(0.0), F.lit("t"), F.lit("p"))
    bare = geo.route_key(F.lit("walk"), F.lit(1.0), F.lit(100.0), F.lit(-0.000001), F.lit(10.5))
    assert values(key, bare) == ["transit:p|t|-33.8675,151|-33.12346,0", "walk||1,100|0,10.5"]


def test_paths(values):
    points = F.array(*[F.struct(F.lit(la).alias("lat"), F.lit(lo).alias("lon")) for la, lo in ((0.0, 0.0), (0.0, 1.0), (1.0, 1.0))])
    got = values(geo.path_metres(points), geo.path_metres(F.slice(points, 1, 1)))
    assert round(got[0]) == round(metres((0, 0), (0, 1)) + metres((0, 1), (1, 1))) and got[1] == 0


def brute(points, pois, radius):
    best = {}
    for p in points:
        for osm, kind, _, lat, lon, chain in pois:
            d = metres(p, (lat, lon))
            if d <= radius:
                key = (*p, kind, chain)
                best[key] = min(best.get(key, (9e9, "")), (d, osm))
    return best


@pytest.mark.parametrize("base, spread", [((-33.87, 151.2), 0.06), ((0.0, 0.0), 0.03), ((78.2, 15.6), 0.1), ((-33.87, 151.2), 0.002)])
def test_nearest_equals_brute_force(spark, base, spread):
    """Scattered, on the equator and the meridian, near a pole, and all in one dense cluster."""
    rng = random.Random(5)

    def somewhere():
        return (round(base[0] + rng.uniform(-spread, spread), 6), round(base[1] + rng.uniform(-spread, spread), 6))

    points = [somewhere() for _ in range(120)]
    pois = [(f"n{i}", rng.choice(["cafe", "gym"]), "x", *somewhere(), rng.random() < 0.3) for i in range(200)]
    pois += [(f"z{i}", "cafe", "x", *points[0], False) for i in range(30)]  # copies at one address
    rows = spark.createDataFrame([(str(i), *p) for i, p in enumerate(points * 3)], "listing_id STRING, lat DOUBLE, lon DOUBLE")
    frame = spark.createDataFrame(pois, POI).withColumn("poi_id", F.col("osm_id"))
    got = {
        (r.lat, r.lon, r.kind, r.is_major_chain): r.distance_m
        for r in N.nearest_within(rows, frame, 1200, ["kind", "is_major_chain"]).collect()
    }
    want = {k: v[0] for k, v in brute(points, pois, 1200).items()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert N.nearest_pois(rows, spark.createDataFrame(pois, POI), 1200).count() == 3 * len(want)


def test_crowded_cells_get_finer_levels(spark):
    rng = random.Random(9)
    crowd = [(f"n{i:05d}", "cafe", "x", HOME[0] + rng.uniform(0, 1e-4), HOME[1] + rng.uniform(0, 1e-4), False) for i in range(1500)]
    frame = spark.createDataFrame(crowd, POI).withColumn("poi_id", F.col("osm_id"))
    levels = N.levels_for(frame, 1200, ["kind", "is_major_chain"])
    height = N._row_height(1200, levels[-1])
    assert levels[:3] == (2, 8, 32) and N.levels_for(frame.limit(3), 1200, ["kind"]) == N.LEVELS
    assert max(Counter((math.floor(r[3] / height), math.floor(r[4] / height)) for r in crowd).values()) <= N.CROWDED
    points = [(HOME[0] + rng.uniform(-1e-3, 1e-3), HOME[1] + rng.uniform(-1e-3, 1e-3)) for _ in range(40)]
    got = {(r.lat, r.lon): r.distance_m for r in N.nearest_within(spark.createDataFrame(points, "lat DOUBLE, lon DOUBLE"), frame, 1200, ["kind", "is_major_chain"], levels).collect()}
    want = {k[:2]: v[0] for k, v in brute(points, crowd, 1200).items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


@pytest.mark.parametrize("lat, lon, spread, radius", [(-16.8, 180.0, 0.03, 600), (89.95, 0.0, 180.0, 6000), (-89.8, 180.0, 3.0, 6000)])
def test_nearest_around_the_globe(spark, lat, lon, spread, radius):
    """On both sides of the 180th meridian, and around the poles."""
    rng = random.Random(3)

    def somewhere():
        east = lon + rng.uniform(-spread, spread)
        return (round(max(-90.0, min(90.0, lat + rng.uniform(-radius, radius) / 150_000)), 6), round((east + 180) % 360 - 180, 6))

    points, pois = [somewhere() for _ in range(20)], [(f"n{i}", "cafe", "x", *somewhere(), False) for i in range(60)]
    frame = spark.createDataFrame(pois, POI).withColumn("poi_id", F.col("osm_id"))
    found = N.nearest_within(spark.createDataFrame(points, "lat DOUBLE, lon DOUBLE"), frame, radius, ["kind", "is_major_chain"])
    got, want = {(r.lat, r.lon): r.distance_m for r in found.collect()}, {k[:2]: v[0] for k, v in brute(points, pois, radius).items()}
    assert got.keys() == want.keys() and len(want) > 5 and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_ten_thousand_pois_inside_a_few_metres(spark):
    rng = random.Random(4)
    crowd = [(f"n{i:05d}", "cafe", "x", HOME[0] + rng.uniform(0, 3e-5), HOME[1] + rng.uniform(0, 3e-5), False) for i in range(10_000)]
    points = [(HOME[0] + rng.uniform(-4e-5, 6e-5), HOME[1] + rng.uniform(-4e-5, 6e-5)) for _ in range(30)]
    frame = spark.createDataFrame(crowd, POI).withColumn("poi_id", F.col("osm_id"))
    found = N.nearest_within(spark.createDataFrame(points, "lat DOUBLE, lon DOUBLE"), frame, 1200, ["kind", "is_major_chain"])
    got, want = {(r.lat, r.lon): r.distance_m for r in found.collect()}, {k[:2]: v[0] for k, v in brute(points, crowd, 1200).items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def at(north, kind, name, chain=False):
    return (f"node/{name}", kind, name, HOME[0] + north / 111_000, HOME[1], chain)


def block(spark, pois, point=HOME):
    rows = spark.createDataFrame([("h", *point)], "listing_id STRING, lat DOUBLE, lon DOUBLE")
    return N.walkability(rows, spark.createDataFrame(pois, POI), WALKING).first().walkability


def test_walkability(spark):
    near = block(spark, [at(200, "cafe", "Close"), at(600, "cafe", "Far")]).cafe
    assert (near.name, near.distance_m, near.status, near.source, near.walk_minutes) == ("Close", 200, "ok", "overpass+detour", 3.4)
    assert block(spark, [at(1250, "cafe", "Too far")]).cafe.status == "none_found" and block(spark, []).cafe.distance_m is None
    chain = block(spark, [at(50, "supermarket", "Nite Owl"), at(400, "supermarket", "ALDI", True)]).supermarket
    assert (chain.name, chain.is_major_chain) == ("ALDI", True)
    corner = block(spark, [at(50, "supermarket", "Nite Owl")]).supermarket
    assert (corner.name, corner.is_major_chain) == ("Nite Owl", False)
    assert block(spark, []).supermarket.is_major_chain is None
    assert block(spark, [at(50, "cafe", "x")], (None, None)).cafe.status == "unavailable"


def test_cached_walkability_answers_until_it_moves(spark):
    rows = spark.createDataFrame([("h", *HOME), ("lost", None, None)], "listing_id STRING, lat DOUBLE, lon DOUBLE")
    pois = spark.createDataFrame([at(200, "cafe", "Close")], POI)
    made = N.cached_walkability(rows, pois, WALKING, "abc", "2024-02-05T00:00:00Z")
    block = made.collect()[0].walkability
    assert made.count() == 1 and (block.config_hash, block.lat, block.cafe.name, block.gym.status) == ("abc", HOME[0], "Close", "none_found")
    ledger = rows.join(made, "listing_id", "left")
    moved = ledger.withColumn("lat", F.col("lat") + 0.0006)
    assert spark.createDataFrame([], LEDGER).schema["walkability"].dataType.simpleString() == made.schema["walkability"].dataType.simpleString()
    stale = [[r.listing_id for r in T.stale_walkability(*args).collect()] for args in ((ledger, "abc"), (ledger, "def"), (moved, "abc"))]
    assert stale == [[], ["h"], ["h"]]


def test_request_cells(spark):
    points = [HOME, (HOME[0] + 0.0005, HOME[1]), (HOME[0] + 0.5, HOME[1])]
    cells = N.request_cells(spark.createDataFrame(points, "lat DOUBLE, lon DOUBLE"), 1200).collect()
    assert [c.listings for c in cells] == [2, 1] and (cells[0].north - HOME[0]) * 111_000 >= 1200


def test_poi_admission(spark):
    def element(tags, i=1, kind="node", lat=-33.87, center=None):
        return (kind, i, lat, lat and 151.2, center, tags)

    rows = [
        element({"amenity": "cafe", "name": "Two Chaps"}, 1), element({"shop": "supermarket", "name": "Woolworths Metro"}, 2),
        element({"leisure": "fitness_centre"}, 3), element({"amenity": "gym", "name": "Iron Den"}, 4), element({"name": "Anytime Fitness Newtown"}, 5),
        element({"amenity": "cafe"}, 6), element({"amenity": "pub", "name": "The Vic"}, 7), element({"shop": "supermarket", "name": "IGA"}, 9, "way", None, (-33.87, 151.2)),
        element({"shop": "supermarket", "name": "IGA"}, 10, "way", None), element({"shop": "supermarket", "name": "Kent St Convenience"}, 11),
    ]
    got = {r.osm_id: (r.kind, r.is_major_chain) for r in admit_pois(spark.createDataFrame(rows, POI_ELEMENT)).collect()}
    assert got == {"node/1": ("cafe", False), "node/2": ("supermarket", True), "node/3": ("gym", False), "node/4": ("gym", False),
                   "node/5": ("gym", False), "way/9": ("supermarket", True), "node/11": ("supermarket", False)}
    twice = spark.createDataFrame([("n/1", 1, "old"), ("n/1", 2, "new")], "osm_id STRING, pos INT, name STRING")
    assert distinct_pois(twice, "pos").first().name == "new"


def rents(spark, *groups):
    rows = [("k", beds, p) for beds, prices in groups for p in prices]
    return P.observed_rents(spark.createDataFrame(rows, "suburb_key STRING, beds INT, price_pw INT"), "r", "t").first()


def test_observed_rents(spark):
    five = rents(spark, (2, (700, 750, 900, 850, 800, None, None)))
    assert five.median_pw_by_beds == {"2": 800} and five.sample_by_beds == {"2": 5} and five.considered == 5
    assert rents(spark, (2, (700, 750, 800, 850))) is None and rents(spark, (2, (None,))) is None
    assert rents(spark, (1, (500, 520, 540, 561, 580, 600))).median_pw_by_beds == {"1": 551}
    mixed = rents(spark, (1, (500, 520, 540, 560, 580)), (3, (1200, 1300)))
    assert mixed.median_pw_by_beds == {"1": 540} and mixed.considered == 7


KEYED = "suburb_key STRING, lat DOUBLE, lon DOUBLE"


def test_suburb_placement(spark):
    listings = spark.createDataFrame([("a", -33.911, 151.155), ("a", -33.913, 151.157), ("b", None, None), ("c", None, None), ("d", None, None)], KEYED)
    envelope = spark.createDataFrame([("a", -33.9, 151.15), ("b", -33.9, 151.15)], KEYED)
    gazetteer = spark.createDataFrame([(k, -33.8, 151.0) for k in "abc"], KEYED)
    got = {r.suburb_key: (r.source, r.lat) for r in P.place_suburbs(listings, envelope, gazetteer).collect()}
    assert got == {"a": ("listings", -33.912), "b": ("envelope", -33.9), "c": ("gazetteer", -33.8), "d": (None, None)}


def test_centroid_corrections(spark):
    envelope = spark.createDataFrame([("m", -33.9, 151.15)], KEYED)

    def fixes(*profiles):
        return P.centroid_corrections(spark.createDataFrame(profiles, KEYED), envelope)

    assert fixes(("m", -33.9, 151.15)).count() == 0 and fixes(("m", -33.900001, 151.150001)).count() == 0
    assert fixes(("m", -33.90003, 151.15)).count() == 1 and fixes(("x", -33.0, 151.0)).count() == 0
    drifted = spark.createDataFrame([("m", -33.911, 151.161)], KEYED)
    settled = P.realigned(drifted, P.centroid_corrections(drifted, envelope))
    assert settled.first().lat == -33.9 and P.centroid_corrections(settled, envelope).count() == 0
