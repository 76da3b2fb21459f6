import pytest
from pyspark.sql import functions as F

from listingflow.config import Dealbreakers, Scoring
from listingflow.functions.numbers import piecewise, round_half_up
from listingflow.operators.enrichment import (
    commute_block, enrichment_note, listing_flags, missing_enrichment, run_notes, unanswered, with_enrichment,
)
from listingflow.operators.scoring import commute_minutes, ranked, score_listings
from listingflow.schemas import WALKABILITY

PRICE = [(650, 100), (750, 50), (800, 0)]
SPACE = [(55, 100), (40, 70), (30, 40), (20, 0)]
COMMUTE = [(10, 100), (20, 75), (30, 50), (45, 0)]
SCORING = Scoring(
    weights={"price": 25, "space": 12, "car_space": 2, "commute": 27, "drive": 2, "walk_cafe": 8, "walk_supermarket": 8, "walk_gym": 6, "suburb": 10},
    curves={"price": PRICE, "space": SPACE, "commute": COMMUTE, "drive": [(10, 100), (40, 0)], "walk_cafe": [(5, 100), (20, 0)],
            "walk_supermarket": [(5, 100), (20, 0)], "walk_gym": [(5, 100), (20, 0)]},
    dealbreakers=Dealbreakers(800, 1, 1, False, 30), target_price_pw=650, preferred_suburbs=["best-2000"],
)
LISTING = f"""price_pw INT, beds INT, baths INT, car_spaces INT, area_sqm INT, suburb_key STRING,
    profile STRUCT<crime_lower_than_pct: DOUBLE, income_decile: INT, published_rents: MAP<STRING, INT>, observed_rents: MAP<STRING, INT>>,
    travel MAP<STRING, STRUCT<minutes: DOUBLE, km: DOUBLE, mode: STRING, precision: STRING>>, walkability STRUCT<{WALKABILITY}>, listing_id STRING"""


def scores(spark, price=700, area=None, beds=2, cars=0, profile=None, travel=None, walkability=None, key="marrickville-2204"):
    row = [(price, beds, 1, cars, area, key, profile, travel or {}, walkability, "x")]
    return score_listings(with_enrichment(spark.createDataFrame(row, LISTING), "office", "router"), SCORING).first()["scores"]


def leg(mode, minutes, precision="building"):
    return {f"office:{mode}": (float(minutes), 1.0, mode, precision)}


@pytest.mark.parametrize(
    "curve, raw, score",
    [(PRICE, 600, 100), (PRICE, 650, 100), (PRICE, 700, 75), (PRICE, 750, 50), (PRICE, 800, 0), (PRICE, 950, 0), (SPACE, 70, 100),
     (SPACE, 47.5, 85), (SPACE, 40, 70), (SPACE, 25, 20), (SPACE, 15, 0), (COMMUTE, 30, 50), (COMMUTE, 45, 0), ([(5, 150), (10, -50)], 5, 100),
     ([(5, 150), (10, -50)], 7.5, 50), ([(1, 10), (1, 20), (2, 30)], 1, 10)],
)
def test_piecewise(values, curve, raw, score):
    assert values(piecewise(F.lit(raw), curve)) == [score]


def test_null_stays_null_on_a_curve(values):
    assert values(piecewise(F.lit(None).cast("double"), PRICE)) == [None]


def test_rounding_is_binary_half_up(values):
    assert values(round_half_up(F.lit(-2.5)), round_half_up(F.lit(0.285), 2), round_half_up(F.lit(2.5))) == [-2.0, 0.28, 3.0]


def test_unenriched_listing(spark):
    s = scores(spark, area=80)
    assert s.confidence == 0.39 and s.factors.space.raw == 40 and s.dealbreakers == []
    assert s.composite == round((25 * 75 + 12 * 70) / 39, 1)
    assert s.factors.commute.excluded == "provider_unavailable" and s.factors.suburb.excluded == "no_suburb_profile"
    assert sum(f.score is None for f in s.factors) == 6


def test_missing_area_sits_out(spark):
    s = scores(spark)
    assert s.confidence == 0.27 and s.factors.space.excluded == "missing_sqm"
    assert scores(spark, area=50, beds=0).factors.space.excluded == "unknown_beds"


def test_price_rules(spark):
    assert scores(spark, price=900).dealbreakers == ["rent_above_hard_cap"]
    free = scores(spark, price=None)
    assert free.factors.price.excluded == "missing_price" and free.dealbreakers == []


def test_published_beats_observed(spark):
    def profile(published=None, observed=None):
        return (None, None, published, observed)

    assert scores(spark, profile=profile()).factors.suburb.excluded == "incomplete_suburb_profile"
    own = scores(spark, profile=profile(observed={"2": 800}))
    both = scores(spark, profile=profile({"2": 900}, {"2": 800}))
    assert own.factors.suburb.source == "rents:observed" and own.factors.suburb.score > 60
    assert both.factors.suburb.source == "rents:published" and both.factors.suburb.raw != own.factors.suburb.raw
    assert scores(spark, beds=3, profile=profile(observed={"2": 800})).factors.suburb.excluded == "incomplete_suburb_profile"


def test_preferred_bonus_is_capped(spark):
    s = scores(spark, profile=(0.97, 10, None, None), key="best-2000").factors.suburb
    assert s.raw == 98.3 and s.score == 100


def test_commute_factor(spark):
    train = scores(spark, travel=leg("transit", 20))
    assert train.confidence == 0.54 and train.factors.commute.score == 75 and train.dealbreakers == []
    assert scores(spark, travel=leg("transit", 35)).dealbreakers == ["commute_too_long"]
    assert scores(spark, travel={**leg("transit", 20), **leg("drive", 25)}).confidence == 0.56
    assert scores(spark, travel=leg("walk", 20)).factors.commute.score == 75
    driven = scores(spark, travel=leg("drive", 9))
    assert driven.factors.commute.excluded == "provider_unavailable" and driven.factors.drive.score == 100


@pytest.mark.parametrize("walk, transit, changes, fastest", [(24, 12, None, 12), (12, 24, None, 12), (16, 14, 1, 16), (16, 14, 0, 14)])
def test_fastest_way_in(values, walk, transit, changes, fastest):
    def way(minutes, **extra):
        return F.struct(F.lit("ok").alias("status"), F.lit(float(minutes)).alias("minutes"),
                        *[F.lit(v).cast("int").alias(k) for k, v in extra.items()])

    commute = F.struct(way(walk).alias("walk"), way(transit, interchanges=changes).alias("transit"))
    assert values(commute_minutes(commute)) == [fastest]


def test_commute_block_reads_only_its_origin(spark):
    schema = "travel MAP<STRING, STRUCT<minutes: DOUBLE, km: DOUBLE, mode: STRING, precision: STRING>>"
    df = spark.createDataFrame([(leg("transit", 18.6, "area"),)], schema)
    here = df.select(commute_block(F.col("travel"), "office", "r").alias("c")).first().c
    assert (here.transit.status, here.transit.minutes, here.transit.interchanges) == ("fallback", 18.6, None)
    assert here.walk.status == here.drive.status == "unavailable" and here.drive.minutes is None
    assert df.select(commute_block(F.col("travel"), "home", "r").alias("c")).first().c.transit.status == "unavailable"


def test_poi_statuses(spark):
    def block(status, minutes=None):
        return (status, None, None, minutes, None)

    w = (block("none_found"), (*block("ok", 5.0), True), block("none_found"))
    f = scores(spark, walkability=w).factors
    assert (f.walk_cafe.score, f.walk_supermarket.score, f.walk_gym.score) == (0, 100, 30)
    assert scores(spark, walkability=(block("unavailable"), (*block("ok"), None), block("ok", 5.0))).factors.walk_supermarket.score is None


def test_flags_and_gaps(spark):
    schema = LISTING + ", lat DOUBLE, lon DOUBLE, share_signals ARRAY<STRING>, studio_signals ARRAY<STRING>"
    df = with_enrichment(spark.createDataFrame([(300, 1, 1, 0, None, "k", None, {}, None, "x", None, 1.0, ["a"], [])], schema), "office", "r")
    full = listing_flags(650, F.col("enrichment"), F.lit(0))
    row = df.select(full.alias("f"), listing_flags(650).alias("e"), unanswered(F.col("enrichment")).alias("u")).first()
    assert row.f == ["no_sqm", "no_latlon", "enrichment_incomplete", "images_failed", "suspiciously_cheap", "share_house"]
    assert row.e == ["no_sqm", "no_latlon", "suspiciously_cheap", "share_house"]
    assert row.u == ["commute", "cafe", "supermarket", "gym"]


def test_notes(spark, values):
    partial, stale = "Partial search: 25 of 398", "Enrichment has not run for this milestone"

    def notes(missing, carried):
        found = F.array(*[F.lit(m) for m in missing]) if missing else F.array().cast("array<string>")
        return run_notes(enrichment_note(found), F.array(*[F.lit(c) for c in carried]))

    assert values(notes([], [stale, partial])) == [[partial]]
    kept = values(notes(["walkability"], [stale, partial]))[0]
    assert len(kept) == 2 and kept[0].startswith("No listing in this run has walkability") and kept[1] == partial
    assert values(notes(["walkability"], kept)) == [kept]


def test_missing_enrichment(spark):
    def run(rows):
        def block(s):
            return (s, None, None, None, None)

        data = [(700, 1, 1, 0, None, "k", None, leg("walk", 5) if c else {}, (block(p), (*block(p), None), block(p)), "x") for c, p in rows]
        return missing_enrichment(with_enrichment(spark.createDataFrame(data, LISTING), "office", "r")).first().missing

    assert run([(True, "ok")]) == [] and run([(True, "none_found")]) == [] and run([(True, "fallback")]) == []
    assert run([(True, "unavailable")]) == ["walkability"]
    assert run([(False, "unavailable")]) == ["a routed commute time", "walkability"]
    assert run([(True, "ok"), (False, "unavailable")]) == [] and run([]) == []


def test_ranking(spark):
    rows = [("b", 700, (50.0,)), ("a", 700, (50.0,)), ("c", None, (50.0,)), ("d", 900, (60.0,))]
    df = spark.createDataFrame(rows, "listing_id STRING, price_pw INT, scores STRUCT<composite: DOUBLE>")
    assert [r.listing_id for r in ranked(df).collect()] == ["d", "a", "b", "c"]
