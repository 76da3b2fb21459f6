import random

import pytest
from pyspark.sql import functions as F

from listingflow.functions import clock
from listingflow.operators import journeys as J
from listingflow.operators import lookups as K
from listingflow.operators import quality as Q
from listingflow.operators import travel as V
from listingflow.sources.caches import cache_expiry

LEG = "journey_id INT, n INT, block INT, product_class INT, seconds BIGINT, metres DOUBLE, departure BIGINT, arrival BIGINT"


def plain_totals(legs):
    """One journey leg by leg."""
    wait = walk = service = 0
    arrived = None
    for _, _, _, product, seconds, m, departure, arrival in legs:
        if product in (99, 100):
            walk += m
        else:
            service += seconds
            if arrived is not None and departure is not None:
                wait += max(0, departure - arrived)
        if arrival is not None:
            arrived = arrival
    return (float(walk), int(service / 60 * 10 + 0.5) / 10, int(wait / 60 * 10 + 0.5) / 10)


def test_totals_do_not_depend_on_blocks(spark):
    rng = random.Random(2)
    legs = []
    for j in range(8):
        for n in range(60 if j == 0 else rng.randint(1, 9)):  # one journey holds most legs
            legs.append((j, n, n // 7, rng.choice([1, 5, 9, 99, 100]), 60 * rng.randint(1, 40), float(rng.randint(1, 900)),
                         rng.choice([None, rng.randint(0, 9000)]), rng.choice([None, rng.randint(0, 9000)])))
    got = {r.journey_id: (r.walk_metres, r.service_minutes, r.wait_minutes) for r in J.journey_totals(spark.createDataFrame(legs, LEG), ["n"]).collect()}
    assert got == {j: plain_totals([x for x in legs if x[0] == j]) for j in range(8)}


def test_incomplete_journey_is_dropped(spark):
    legs = [(1, 0, 0, 1, 60, 1.0, 0, 60), (1, 1, 0, None, 60, 1.0, 60, 120), (2, 0, 0, 1, None, 1.0, 0, 60), (3, 0, 0, 99, 60, 5.0, 0, 60)]
    rows = J.journey_totals(spark.createDataFrame(legs, LEG), ["n"]).collect()
    assert [(r.journey_id, r.is_walk, r.interchanges) for r in rows] == [(3, True, 0)]


def test_describe_and_array_totals(spark):
    legs = [(99, None, 3.0, 200.0), (9, "F4", 12.0, 900.0), (5, "", 5.0, 10.0), (42, None, 1.0, 1.0), (100, None, 1.0, 50.0)]
    df = spark.createDataFrame([(legs,)], "legs ARRAY<STRUCT<product_class: INT, service: STRING, minutes: DOUBLE, metres: DOUBLE>>")
    row = df.select(J.describe(F.col("legs")).alias("d"), J.array_totals(F.col("legs")).alias("t")).first()
    assert row.d == "walk · F4 ferry · bus · class 42 · walk"
    assert (row.t.walk_metres, row.t.service_minutes, row.t.is_walk, row.t.has_ferry, row.t.interchanges) == (250, 18.0, False, True, 2)


def test_fastest_and_ferries(spark):
    rows = [("p", 1, 1000.0, 10.0, 0.0, False), ("p", 2, 0.0, 20.0, 0.0, True), ("p", 3, 0.0, 20.0, 0.0, False), ("q", 1, 0.0, 1.0, 0.0, False)]
    df = spark.createDataFrame(rows, "pair STRING, pos INT, walk_metres DOUBLE, service_minutes DOUBLE, wait_minutes DOUBLE, has_ferry BOOLEAN")
    best = {r.pair: (r.pos, round(r.minutes, 3)) for r in J.fastest_journeys(df, ["pair"], "pos").collect()}
    assert best == {"p": (2, 20.0), "q": (1, 1.0)}
    assert {r.pair: r.ferry_available for r in J.ferry_pairs(df, ["pair"]).collect()} == {"p": True, "q": False}


@pytest.mark.parametrize("kmh, ferry, flagged", [(6.53, True, True), (6.53, False, False), (4.32, True, False), (4.32, False, False), (4.85, True, True), (4.84, True, False), (6.53, None, False)])
def test_two_signals(spark, kmh, ferry, flagged):
    walks = spark.createDataFrame([("a", "p", 60.0, kmh)], "listing_id STRING, pair STRING, minutes DOUBLE, km DOUBLE")
    ferries = spark.createDataFrame([] if ferry is None else [("p", ferry)], "pair STRING, ferry_available BOOLEAN")
    assert V.mislabelled_walks(walks, ferries, ["pair"]).count() == int(flagged)
    row = spark.createDataFrame([("a", kmh, ferry, flagged, 4.85)], "key STRING, kmh DOUBLE, ferry_available BOOLEAN, flagged BOOLEAN, threshold_kmh DOUBLE")
    assert Q.flag_checks(row).count() == 0
    assert Q.flag_checks(row.withColumn("flagged", ~F.col("flagged"))).count() == 1


def test_findings_are_spelled_once(spark):
    camel = spark.createDataFrame([(("ferry", 6.5, 4.85, True),), (None,)], "mislabelled STRUCT<actually: STRING, impliedKmh: DOUBLE, thresholdKmh: DOUBLE, ferryAvailable: BOOLEAN>")
    once = camel.select(V.ledger_mislabelled(camel).alias("mislabelled"))
    twice = once.select(V.ledger_mislabelled(once).alias("mislabelled"))
    assert once.collect() == twice.collect() and once.first().mislabelled.implied_kmh == 6.5 and once.filter("mislabelled is null").count() == 1


def test_better_evidence_wins(spark):
    leg = "STRUCT<minutes: DOUBLE, composition: STRING, mislabelled: STRING>"
    df = spark.createDataFrame(
        [({"a": (1.0, "legs", None), "b": (1.0, None, None), "c": (1.0, None, "ferry"), "d": (1.0, None, None), "f": (1.0, "legs", None)},
          {"a": (2.0, None, None), "b": (2.0, None, None), "c": (2.0, "legs", None), "e": (2.0, None, None), "f": (2.0, "legs", None)})],
        f"old MAP<STRING, {leg}>, new MAP<STRING, {leg}>",
    )
    got = df.select(V.merge_travel_maps(F.col("old"), F.col("new")).alias("m")).first().m
    assert {k: v.minutes for k, v in got.items()} == {"a": 1.0, "b": 2.0, "c": 1.0, "d": 1.0, "e": 2.0, "f": 2.0}


def test_arrive_by(spark, values):
    def at(text):
        return clock.arrive_by_moment(F.lit(text).cast("timestamp_ntz"), "Tuesday", "09:00")

    # Stable from a Tuesday to the Sunday after it, a week on from Monday; the offset follows daylight saving.
    assert values(at("2026-09-06 01:00:00"), at("2026-09-06 23:00:00"), at("2026-10-05 00:00:00"), at("2026-04-01 00:00:00")) == [
        "2026-09-08T09:00:00+10:00", "2026-09-15T09:00:00+10:00", "2026-10-13T09:00:00+11:00", "2026-04-07T09:00:00+10:00"]
    with pytest.raises(ValueError):
        clock.arrive_by_moment(F.lit("2026-01-01").cast("timestamp_ntz"), "Someday", "09:00")


def test_arrive_by_drift(spark):
    moment, other = "2026-09-08T09:00:00+10:00", "2026-09-15T09:00:00+10:00"
    rows = [("a", "transit", moment), ("b", "transit", other), ("c", "transit", None), ("d", "walk", None), ("e", "drive", None)]
    got = V.arrive_by_mismatches(spark.createDataFrame(rows, "origin STRING, mode STRING, arrive_by STRING"), moment).collect()
    assert sorted((r.origin, r.arrive_by) for r in got) == [("b", other), ("c", None)]


def test_cache_expiry(spark):
    day, now = 86_400_000, 1_800_000_000_000
    schema = "src STRING, at BIGINT"

    def counts(*rows):
        return tuple(cache_expiry(spark.createDataFrame(rows, schema), F.lit(now)).first())

    assert counts(("osm", None), (None, None)) == (2, 0, 0, 0) and counts(("google", now - day)) == (0, 1, 0, 0)
    assert counts(("google", now - 31 * day)) == (0, 1, 1, 0) and counts(("google", now - 28 * day)) == (0, 1, 0, 1)
    assert counts(("google", now - 10 * day)) == (0, 1, 0, 0) and counts(("google", None)) == (0, 1, 1, 0)
    assert counts(("osm", None), ("google", now - day), ("google", now - 40 * day)) == (1, 2, 1, 0)


def test_position_lookup(spark):
    now = 100 * 86_400_000
    positions = spark.createDataFrame([("a st", 1.0, 2.0, "building", None, None), ("b st", 1.0, 2.0, "building", "google", 0), ("locality|c", 3.0, 4.0, "area", "osm", None)],
                                      "key STRING, lat DOUBLE, lng DOUBLE, precision STRING, src STRING, at BIGINT")
    queries = spark.createDataFrame([("1", " A St "), ("2", "b st"), ("3", "c"), ("4", "  ")], "id STRING, query STRING")
    got = {r.id: (r.lat, r.source) for r in K.look_up_positions(queries, positions, F.lit(now)).collect()}
    assert got == {"1": (1.0, "osm"), "2": (None, None), "3": (None, None), "4": (None, None)}
    places = {r.id: r.lat for r in K.look_up_positions(queries, positions, F.lit(now), locality=True).collect()}
    assert places == {"1": None, "2": None, "3": 3.0, "4": None}
    origins = spark.createDataFrame([("1", "-33.8, 151.2"), ("2", "95,10"), ("3", "a st")], "id STRING, query STRING")
    got = {r.id: (r.lat, r.source) for r in K.resolve_origins(origins, positions, F.lit(now)).collect()}
    assert got == {"1": (-33.8, "given"), "2": (None, None), "3": (1.0, "osm")}


def test_cache_freshness(values):
    def fresh(hash_, dlat):
        cached = F.struct(F.lit("abc").alias("config_hash"), F.lit(-33.87).alias("lat"), F.lit(151.2).alias("lon"))
        return V.cache_is_fresh(cached, F.lit(hash_), F.lit(-33.87 + dlat), F.lit(151.2))

    assert values(fresh("abc", 0), fresh("def", 0), fresh("abc", 0.00027), fresh("abc", 0.0018)) == [True, False, True, False]
    nobody = F.lit(None).cast("struct<config_hash:string,lat:double,lon:double>")
    assert values(V.cache_is_fresh(nobody, F.lit("abc"), F.lit(0.0), F.lit(0.0))) == [False]
