import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from listingflow.functions import patterns, signals as G, text as X


@pytest.mark.parametrize(
    "display, rent",
    [("$650 per week", 650), ("$650 - $700 per week", 650), ("$650 pw + $30 parking", 650), ("Contact agent", None), ("", None), ("$2,600 per month", None),
     ("$2,400 pcm ($554 pw)", 554), ("$99", None), ("$480.50", 481), ("$ 1,150.49", 1150), ("$31,200 p.a.", None), ("$900 p.a", None), ("$650pa", 650), ("$5001", None), ("$,", None)],
)
def test_weekly_rent(values, display, rent):
    assert values(X.weekly_rent(F.lit(display))) == [rent]


@pytest.mark.parametrize("size, sqm", [("80m²", 80), ("1,200 m²", None), ("14.9", None), ("15", 15), ("450.5m²", 451), ("n/a", None), (None, None), ("600.4", None), ("600", 600)])
def test_area(values, size, sqm):
    assert values(X.area_sqm(F.lit(size))) == [sqm]


@pytest.mark.parametrize(
    "display, kind",
    [("Terrace House", "terrace"), ("Town House", "townhouse"), ("villa", "townhouse"), ("Studio Apartment", "other"), ("Penthouse", "apartment"),
     ("Flat", "unit"), ("Semi-Detached", "house"), ("Acreage", "other"), (None, "other"), ("Warehouse", "other")],
)
def test_property_type(values, display, kind):
    assert values(X.property_type(F.lit(display))) == [kind]


def test_addresses(values):
    assert values(*[X.building_address(F.lit(a)) for a in (
        "Fully Furnished 3/170 Kent St, Sydney", "12/8-10 Point St", "Studio 631-635 George Street", "Level 3 20 Bond St", "Small Studio/5 A St", "5 A St")]) == [
        "170 Kent St, Sydney", "8-10 Point St", "631-635 George Street", "20 Bond St", "Small Studio/5 A St".split("/")[1], "5 A St"]
    assert values(*[X.expand_street_type(F.lit(a)) for a in ("5 Kent St, Sydney", "5 Point Rd., X", "5 Broadway, X", "St", "7 Foo BLVD")]) == [
        "5 Kent Street, Sydney", "5 Point Road, X", "5 Broadway, X", "St", "7 Foo Boulevard"]
    a = F.lit("24-26 Point Street, Pyrmont NSW 2009")
    assert values(X.street_of(a), X.postcode_of(a), X.house_number_of(a), X.house_number_of(F.lit("Point St"))) == ["point street", "2009", "2426", None]
    tail = X.address_tail(F.lit("1/2 A St, Surry Hills, NSW 2010 "))
    assert values(tail["suburb"], tail["state"], tail["postcode"]) == ["Surry Hills", "NSW", "2010"]


def test_street_match(values):
    cases = [("Point Street", "point street"), ("Point", "point street"), ("Kent Lane", "kent street"), ("St Kilda", "st james"), (None, "x"), ("A", "")]
    assert values(*[X.street_matches(F.lit(c), F.lit(w)) for c, w in cases]) == [True, True, True, False, False, False]


def test_keys_and_paths(values):
    assert values(X.suburb_key(F.lit(" Walsh Bay "), F.lit("2000")), X.feature_key(F.lit("Air-Conditioning!"))) == ["walsh-bay-2000", "air_conditioning"]
    listed = X.feature_list(F.array(F.lit("Air Conditioning"), F.lit("air-conditioning"), F.lit("--"), F.lit("Gas")))
    assert values(listed) == [["air_conditioning", "gas"]]
    keys = ["images/listings/1/01.webp", "/images/listings/1/01.webp", "images/mylistings/1/01.webp", "listings/1/a/b.webp", "listings//b", "", "listings/1"]
    assert values(*[X.listing_id_of_key(F.lit(k)) for k in keys]) == ["1", "1", None, None, None, None, None]
    assert values(X.sized_image_url(F.lit("a/{size}/{size}")), X.sized_image_url(F.lit("a/800x600/800x600/b")), X.sized_image_url(F.lit("a/b"))) == [
        "a/1600x1200/{size}", "a/1600x1200/800x600/b", "a/b"]


def test_snippet_and_display(values):
    word = "abcdefghi "
    long, solid = word * 60, "x" * 600
    got = values(X.snippet(F.lit("  a \n b ")), X.snippet(F.lit(long)), X.snippet(F.lit(solid)))
    assert got[0] == "a b" and got[1] == (word * 49).strip() + "…" and got[2] == "x" * 499 + "…"
    nothing = F.lit(None).cast("int")
    assert values(X.price_display(F.lit(" $5 "), nothing), X.price_display(F.lit(" "), F.lit(700)), X.price_display(F.lit(""), nothing)) == [
        "$5", "$700 per week", "Contact agent"]
    assert values(X.keyword_hit(F.lit("Studio"), F.lit("1 A St"), ["room", "stud"]), X.keyword_hit(F.lit(None).cast("string"), F.lit("Mushroom St"), ["room"])) == ["stud", None]


def evidence(spark, description="", kind="Apartment", address="1 A St", price="", beds=1):
    df = spark.createDataFrame([(description, kind, address, price, beds)], "d STRING, t STRING, a STRING, p STRING, b INT")
    row = G.with_evidence(df, "d", "t", "a", "p", "b").first()
    return row.room_evidence, row.studio_evidence


@pytest.mark.parametrize(
    "description, kind, signals",
    [("", "Studio", ["rea_property_type"]), ("", "Apartment", []), ("", None, []), ("Light-filled living, moments from the park.", "Studio", ["rea_property_type"]),
     ("This spacious studio is fully renovated.", "Apartment", ["studio_offered"]), ("A true one bedroom (not a studio) in the heart of it.", "Apartment", []),
     ("The studio-style living area opens to a balcony.", "Apartment", []), ("Moments from cafes and a yoga studio.", "Apartment", []),
     ("A true one bedroom (not a studio), beautifully presented.", "Studio", ["rea_property_type"]),
     ("Furnished studio apartments available now.", "Studio", ["rea_property_type", "studio_dwelling", "studio_offered"]),
     ("Fully furnished studios in the heart of Surry Hills.", "Apartment", ["studios_offered"]), ("Studio | 1 Bathroom", "Unit", ["studio_headline", "studio_spec"]),
     ("Bed-sitter near all", "Unit", ["bedsit"])],
)
def test_studio_signals(spark, description, kind, signals):
    assert [e.signal for e in evidence(spark, description, kind)[1]] == signals


def test_quotes_come_from_the_unmasked_text(spark):
    quote = evidence(spark, "not a studio but this modern studio is bright and opens to the quiet leafy street")[1][0].quote
    assert quote == "not a studio but this modern studio is bright and opens to the qu…"
    assert evidence(spark, kind="Studio")[1][0].quote == "REA property type: Studio"


@pytest.mark.parametrize(
    "description, signals",
    [("shared<br/>kitchen", ["shared_kitchen"]), ("shared modern, tiled bathroom", ["shared_bathroom"]), ("shared garden area. Kitchen features", []),
     ("five shared bathrooms full kitchen", ["shared_bathroom"]), ("shared laundry, lounge room and dining room", []), ("spacious lounge room", []),
     ("spacious room with view", ["offered_room"]), ("Private Room &amp; co-living, flat mates", ["co_living", "private_room", "flatmate"]),
     ("2 rooms still available per person", ["per_person", "rooms_available"]), ("consists of 6 rooms", ["n_rooms"])],
)
def test_room_signals(spark, description, signals):
    assert [e.signal for e in evidence(spark, description)[0]] == signals


def test_structural_room_signals(spark):
    found = evidence(spark, address="Room2/50 Frederick St", price="$400 pw", beds=5)[0]
    assert [(e.signal, e.quote) for e in found] == [("room_address", "Room2/50 Frederick St"), ("beds_vs_price", "5 bedrooms at $400 pw")]
    assert evidence(spark, address="Roomy St", price="$500", beds=5)[0] == []


def test_loose_quotes(values):
    assert values(G.loose_quotes(F.lit("one room, two rooms, one room, a share"), G.ROOM_LOOSE, 4)) == [["…one room, tw…", "…two rooms, on…", "…one room, a…"]]
    assert values(G.loose_quotes(F.lit("nothing"), G.ROOM_LOOSE, 4)) == [[]]


WORDS = ["shared", "kitchen", "room", "rooms", "studio", "studios", "per", "p.a.", "pa", "über", "bathroom", "_", "-", ".", ",", "a", "not", "the", "flat", "mates", "2", "é", "$650"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=12), st.sampled_from([" ", "", "-"]))
def test_cheap_boundaries_equal_the_general_one(words, joiner):
    """Python's ASCII engine reads both translations of a boundary; they must agree on every rule."""
    line = joiner.join(words)
    for _, rule in [*G.ROOM_SIGNALS, *G.STUDIO_SIGNALS, *X.PROPERTY_TYPES, ("", X.OTHER_PERIOD), *[("", p) for p in G.NOT_A_STUDIO_OFFER]]:
        cheap = re.search(patterns.java(rule), line, re.ASCII)
        plain = re.search(rule, line, re.ASCII)
        assert (cheap and cheap.span()) == (plain and plain.span())


def test_boundaries_are_ascii(values):
    assert values(patterns.matches(F.lit("über room"), r"\bber\b"), patterns.matches(F.lit("a room b"), r"\broom\b")) == [True, True]


def test_a_hit_runs_its_pattern_twice(spark):
    """One pass finds the place, one what it says; a text without the rule's stems is not searched at all."""
    rule = dict(G.ROOM_SIGNALS)["master_room"]
    plan = spark.range(1).select(G.room_evidence(F.lit("a") + F.col("id"), F.lit(""), F.lit(""), F.lit(1)).alias("e"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(patterns.java(rule)) <= 2


@pytest.mark.parametrize(
    "text", ["shared kitchen", "communal bathroom", "sharing the facilities", "share-house", "co living", "boardinghouse", "per room", "per person", "each room $", "room only",
             "rooms to lease", "2 rooms still available", "room type:", "private lockable", "locked private rooms", "master room", "house mates", "10 rooms in total",
             "air conditioned rooms"],
)
def test_every_rule_meets_its_stems(text):
    for signal, pattern in G.ROOM_SIGNALS:
        if re.search(pattern, text):
            assert all(any(stem in text for stem in group) for group in G.ROOM_STEMS[signal]), signal


def test_collapsed_runs(values):
    assert values(patterns.collapsed(F.lit(" a \u00a0b\n\nc  d\te f "))) == [" a b c d e f "]
