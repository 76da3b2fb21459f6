from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from listingflow.config import Envelope, LocationRule, SavedSearch
from listingflow.operators import searches as Q

WALK = SavedSearch("a", "office", "walk", 15)
SCHEMA = """listing_id STRING, price_pw INT, beds INT, baths INT, car_spaces INT, property_type STRING, flags ARRAY<STRING>,
    travel MAP<STRING, STRUCT<minutes: DOUBLE, km: DOUBLE, mode: STRING, precision: STRING>>"""


def leg(minutes):
    return (minutes, 1.0, "walk", "building")


def candidate(spark, price=600, beds=2, kind="apartment", flags=(), travel=None):
    t = {"office:walk": leg(9.4)} if travel is None else travel
    return spark.createDataFrame([("x", price, beds, 1, 0, kind, list(flags), t)], SCHEMA)


CASES = [
    (WALK, {}, True), (WALK, {"travel": {"office:walk": leg(15.1)}}, False), (WALK, {"travel": {"office:walk": leg(15.0)}}, True),
    (WALK, {"travel": {}}, False), (WALK, {"travel": {"office:drive": leg(4.0)}}, False), (replace(WALK, origin="home"), {}, False),
    (replace(WALK, max_price_pw=700), {"price": 700}, True), (replace(WALK, max_price_pw=700), {"price": 701}, False),
    (replace(WALK, max_price_pw=700), {"price": None}, False), (WALK, {"price": None}, True), (replace(WALK, min_beds=2, max_beds=2), {"beds": 1}, False),
    (replace(WALK, min_beds=2, max_beds=2), {"beds": 3}, False), (replace(WALK, exclude_flagged=("share_house",)), {"flags": ["share_house"]}, False),
    (replace(WALK, exclude_flagged=("share_house",)), {"flags": ["no_sqm"]}, True), (replace(WALK, property_types=("unit",)), {"kind": "unit"}, True),
    (replace(WALK, property_types=("unit",)), {"kind": "house"}, False),
]


@pytest.mark.parametrize("search, listing, expected", CASES)
def test_match_inline_and_by_join(spark, search, listing, expected):
    df = candidate(spark, **listing)
    assert bool(Q.match_searches(df, [search]).first().matched_searches) == expected
    assert bool(Q.match_search_table(df, Q.searches_frame(spark, [search])).first().matched_searches) == expected


def test_both_forms_agree_on_many_searches_repeated_ids_and_null_flags(spark):
    rows = [("1", 600, 2, 1, 0, "unit", [], {"office:walk": leg(5.0)}), ("1", 600, 2, 1, 0, "unit", [], {"office:walk": leg(50.0)}),
            ("2", 600, 2, 1, 0, "unit", None, {"office:walk": leg(5.0)}), ("3", 600, 2, 1, 0, "unit", ["studio"], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    many = [replace(WALK, search_id=f"s{i:03d}", max_minutes=i, exclude_flagged=("studio",) if i % 2 else ()) for i in range(100)]
    inline = Q.match_searches(df, many).collect()
    table = Q.match_search_table(df, Q.searches_frame(spark, many)).collect()
    assert [len(r.matched_searches) for r in inline] == [95, 50, 95, 0]
    assert sorted((r.listing_id, r.matched_searches) for r in inline) == sorted((r.listing_id, r.matched_searches) for r in table)


def test_excluded_by_every_search(values):
    share, studio = replace(WALK, exclude_flagged=("share_house",)), replace(WALK, exclude_flagged=("studio",))

    def check(searches, *flags):
        return values(Q.excluded_by_every_search(searches, F.array(*[F.lit(f) for f in flags]) if flags else F.array().cast("array<string>")))[0]

    assert check([share], "share_house") and check([share, studio], "share_house", "studio")
    assert not check([share, studio], "share_house") and not check([share]) and not check([WALK], "share_house")
    assert not check([], "share_house")


ENVELOPE = "location STRING, location_pos INT, indicative_minutes MAP<STRING, DOUBLE>, km_from MAP<STRING, DOUBLE>"


def envelope(spark, tagged=True):
    rows = [("Close NSW 2000", 0, {"office:walk": 12.0}, {"office": 1.0}), ("Far NSW 2999", 1, {"office:walk": 200.0}, {"office": 1.0}), ("Untagged NSW 2001", 2, None, None)]
    return spark.createDataFrame(rows if tagged else [(n, p, None, None) for n, p, *_ in rows], ENVELOPE)


def resolved(spark, search):
    return [r.location for r in Q.resolve_locations(envelope(spark), [search]).orderBy("location_pos").collect()]


def test_location_rules(spark):
    rule = replace(WALK, locations=LocationRule(within_indicative_minutes=45, mode="walk"))
    assert resolved(spark, rule) == ["Close NSW 2000", "Untagged NSW 2001"]
    assert len(resolved(spark, replace(WALK, locations=LocationRule(within_indicative_minutes=45, mode="transit")))) == 3
    assert len(resolved(spark, WALK)) == 3
    assert resolved(spark, replace(WALK, locations=("Far NSW 2999", "Elsewhere NSW 1", "Close NSW 2000"))) == ["Far NSW 2999", "Elsewhere NSW 1", "Close NSW 2000"]
    assert resolved(spark, replace(WALK, locations=())) == []


def test_refusals(spark):
    def reasons(searches, tagged=True, asked=None):
        rows = Q.refusals(envelope(spark, tagged), searches, Envelope(750, 1), ["office"], asked).collect()
        return {r.search_id: r.reason for r in rows}

    assert "above the envelope's 750" in reasons([replace(WALK, max_price_pw=5000)])["a"]
    assert "unknown origin" in reasons([replace(WALK, origin="nowhere")])["a"]
    assert reasons([replace(WALK, locations=("Broken Hill NSW 2880", "Close NSW 2000"))])["a"].endswith("envelope: Broken Hill NSW 2880")
    assert "rule" in reasons([replace(WALK, locations=LocationRule(within_km=5))], tagged=False)["a"]
    assert reasons([WALK], asked=["b"]) == {"b": "no such search saved"}
    assert reasons([WALK, replace(WALK, search_id="z", locations=LocationRule(within_km=5))]) == {}


def test_plan_and_results(spark):
    w10, w15, d20 = replace(WALK, search_id="walk-10", max_minutes=10), replace(WALK, search_id="walk-15"), SavedSearch("drive-20", "office", "drive", 20)
    passes = {r.travel_key: r for r in Q.plan_passes(Q.resolve_locations(envelope(spark), [w10, w15, d20]), [w10, w15, d20]).collect()}
    assert passes["office:walk"].search_ids == ["walk-10", "walk-15"] and passes["office:walk"].max_minutes == 15
    assert len(passes) == 2 and passes["office:walk"].locations == 3
    rows = [(i, 600, 2, 1, 0, "unit", [], {"office:walk": leg(m)}) for i, m in (("near", 8.0), ("mid", 12.0), ("far", 40.0))]
    matched = Q.match_searches(spark.createDataFrame(rows, SCHEMA), [w10, w15])
    totals = spark.createDataFrame([("office:walk", 3)], "travel_key STRING, considered BIGINT")
    full = {r.search_id: r for r in Q.search_results(matched, [w10, w15, d20], totals, Q.resolve_locations(envelope(spark), [w10, w15, d20])).collect()}
    assert (full["walk-10"].matched, full["walk-15"].matched, full["walk-15"].status) == (1, 2, "ok") and "drive-20" not in full
    some = spark.createDataFrame([("Close NSW 2000",)], "location STRING")
    part = Q.search_results(matched, [w10], totals, Q.resolve_locations(envelope(spark), [w10]), some).first()
    assert (part.status, part.locations_queried, part.locations_searched) == ("partial_coverage", 1, ["Close NSW 2000"])
    both = Q.resolve_locations(envelope(spark), [w10, d20])
    empty = {r.search_id: (r.matched, r.considered) for r in Q.search_results(matched, [w10, d20], totals, both, passes={"office:walk", "office:drive"}).collect()}
    assert empty == {"walk-10": (1, 3), "drive-20": (0, 0)}  # a covered pass that returned nothing still reports
    reports = spark.createDataFrame([("office:walk", (7,))], "travel_key STRING, travel STRUCT<routed: INT>")
    assert Q.search_results(matched, [w10], totals, both, reports=reports).first().travel.routed == 7
    refused = spark.createDataFrame([("walk-15",)], "search_id STRING")
    narrow = Q.plan_passes(Q.resolve_locations(envelope(spark), [w10, w15]), [w10, w15], refused).first()
    assert (narrow.search_ids, narrow.max_minutes) == (["walk-10"], 10)
