import pytest
from pyspark.sql import functions as F

from bindings.settings import SCORING
from listingflow.config import Envelope, SavedSearch
from listingflow.operators.searches import resolve_locations
from listingflow.plans import build as B
from listingflow.plans import guards
from listingflow.plans.replay import replay
from listingflow.plans.search_pass import search_pass
from listingflow.schemas import LEDGER, PROFILE, REJECTED
from listingflow.sources import captures
from test_sources import leg, listing, page, store

SEARCHES = [SavedSearch("walk-15", "office", "walk", 15, max_price_pw=900), SavedSearch("train-30", "office", "transit", 30), SavedSearch("unasked", "home", "walk", 30)]


def capture(prices, minutes=5.0):
    rows = [listing(i, price=f"${p} per week", bedrooms=2, bathrooms=1, buildingSize="80m²", travel=leg(minutes)) for i, p in prices.items()]
    bad = [listing(90, address="nowhere"), listing(91, propertyType="Room"), listing(92, address=" ", suburb="S", postcode="2000")]
    return {"source": "s", "captured_at": "t", "groups": [
        {"origin": "office", "mode": "walk", "max_travel_minutes": 15, "results": rows + bad,
         "filtered_by_travel": [{"id": "50", "url": "u", "address": "far", "travel": leg(99)}, {"id": next(iter(prices)), "url": "u", "address": "x"}]}]}


def frames(spark, folder, body):
    folder.mkdir()
    docs = captures.read_captures(spark, store(folder, c=body))
    return captures.capture_rows(docs), captures.rejected_rows(docs)


def run(spark, folder, body, run_id, previous=None, ledger=None, rejected=None, verdicts=()):
    rows, rejections = frames(spark, folder, body)
    envelope = spark.createDataFrame([("Sydney NSW 2000", 0, None, None)], "location STRING, location_pos INT, indicative_minutes MAP<STRING, DOUBLE>, km_from MAP<STRING, DOUBLE>")
    places = spark.createDataFrame([("sydney-2000", -33.87, 151.2)], "suburb_key STRING, lat DOUBLE, lon DOUBLE")
    state = B.State(
        ledger=spark.createDataFrame([], LEDGER) if ledger is None else ledger,
        rejected=spark.createDataFrame([], REJECTED) if rejected is None else rejected,
        profiles=spark.createDataFrame([], PROFILE), envelope=places, gazetteer=places, resolved=resolve_locations(envelope, SEARCHES),
    )
    out = B.build(rows, rejections, ["office:walk"], spark.createDataFrame(list(verdicts), "listing_id STRING, verdict STRING"), state, SCORING,
                  Envelope(900, 0, exclude_keywords=["room"]), SEARCHES, run_id, previous, "2024-01-01T00:00:00Z", "https://x/", "router",
                  carried_notes=["Partial search: 1 of 2"])
    return rows, state, out


def test_two_runs_and_a_replay(spark, tmp_path):
    _, _, first = run(spark, tmp_path / "a", capture({"1": 650, "2": 700, "3": 1000}), "r1")
    assert {r.listing_id: r.listing_state for r in first.listings.collect()} == {"1": "new", "2": "new"}  # 3 is over the cap
    assert [r.listing_id for r in first.listings.collect()] == ["1", "2"]
    assert tuple(first.funnel.first()) == (6, 6, 3, 1, 2, 2)
    assert {(r.search_id, r.matched, r.considered) for r in first.results.collect()} == {("walk-15", 2, 6)}
    assert {r.listing_id for r in first.problems.collect()} == {"90", "92"}
    assert [r.listing_id for r in first.rejected.collect()] == ["50"]
    assert [(r.suburb_key, r.source) for r in first.suburbs.collect()] == [("sydney-2000", "envelope")]
    assert [(r.suburb_key, r.lat, r.lon, r.observed_rents) for r in first.profiles.collect()] == [("sydney-2000", -33.87, 151.2, None)]
    assert first.photos.count() == 0 and first.summary.first().total == 2
    notes = [r.note for r in first.notes.collect()]
    assert notes[0].startswith("No listing in this run has walkability,") and notes[1] == "Partial search: 1 of 2"

    rows, state, second = run(spark, tmp_path / "b", capture({"1": 600, "3": 800}), "r2", "r1", first.ledger, first.rejected, [("2", "leased")])
    got = {r.listing_id: (r.listing_state, r.price_change and r.price_change.delta_pw) for r in second.listings.collect()}
    assert got == {"1": ("price_drop", -50), "3": ("price_drop", -200)}
    assert {r.listing_id: r.status for r in second.ledger.collect()} == {"1": "active", "2": "leased", "3": "active"}
    summary = second.summary.first()
    assert (summary.price_drops, summary.leased_since_last_run) == (2, 1)

    again = replay(rows, second.listings, second.ledger, second.profiles, SCORING, ["room"],
                   B.covered(SEARCHES, ["office:walk"]), "https://x/", "router")
    assert [(r.search_id, r.matched) for r in again.matched.collect()] == [("walk-15", 2)]
    assert tuple(again.summary.first()) == (2, 0, 0, 2, 0) and again.notes.count() == 1
    for part in (again.changes, again.left, again.violations, again.drift):
        assert part.count() == 0
    assert again.listings.drop("travel", "captured_travel").exceptAll(second.listings.drop("travel", "captured_travel")).count() == 0


def test_new_suburb_is_scored_with_the_table_that_is_handed_on(spark, tmp_path):
    _, _, done = run(spark, tmp_path / "a", capture({str(i): 640 for i in range(1, 8)}), "r1")
    assert {tuple(r.observed_rents.items()) for r in done.profiles.collect()} == {(("2", 640),)}
    factors = done.listings.select("scores").first().scores.asDict(True)
    assert "rents:observed" in str(factors) and "no_suburb_profile" not in str(factors)
    again, _, _ = frames_of_next(spark, tmp_path / "b", done)
    assert again.profiles.count() == 1 and again.suburbs.count() == 0


def frames_of_next(spark, folder, done):
    rows, rejections = frames(spark, folder, capture({"1": 640}))
    places = spark.createDataFrame([("sydney-2000", -33.9, 151.3)], "suburb_key STRING, lat DOUBLE, lon DOUBLE")
    envelope = spark.createDataFrame([("Sydney NSW 2000", 0, None, None)], "location STRING, location_pos INT, indicative_minutes MAP<STRING, DOUBLE>, km_from MAP<STRING, DOUBLE>")
    state = B.State(ledger=done.ledger, rejected=done.rejected, profiles=done.profiles, envelope=places, gazetteer=places, resolved=resolve_locations(envelope, SEARCHES))
    none = spark.createDataFrame([], "listing_id STRING, verdict STRING")
    out = B.build(rows, rejections, ["office:walk", "office:transit"], none, state, SCORING, Envelope(900, 0), SEARCHES, "r2", "r1", "2024-01-02T00:00:00Z", "https://x/", "router")
    moved = out.profiles.first()
    assert (moved.lat, moved.lon, moved.observed_rents) == (-33.9, 151.3, {"2": 640})  # moved to the envelope; rents kept
    assert {(r.search_id, r.matched, r.considered) for r in out.results.collect()} >= {("train-30", 0, 0)}
    return out, rows, state


def test_unplaceable_suburb_stops_the_build(spark, tmp_path):
    body = capture({"1": 640})
    body["groups"][0]["results"][0] |= {"suburb": "Nowhere", "postcode": "9999", "coords": None}
    with pytest.raises(ValueError, match="nowhere-9999"):
        run(spark, tmp_path / "a", body, "r1")


def test_guards_stop_a_build(spark):
    places = spark.createDataFrame([("Sydney NSW 2000", 0, None, None)], "location STRING, location_pos INT, indicative_minutes MAP<STRING, DOUBLE>, km_from MAP<STRING, DOUBLE>")
    groups = spark.createDataFrame([("office", "walk", None), ("office", "transit", "2024-01-09T09:00:00+11:00"), ("home", "transit", None)], "origin STRING, mode STRING, arrive_by STRING")
    asked = guards.Asked(groups, places, ["office", "home"], "2024-01-02T09:00:00+11:00")
    with pytest.raises(guards.Refused, match="no passes"):
        guards.require_passes([])
    wide = [SavedSearch("rich", "office", "walk", 15, max_price_pw=5000), SavedSearch("away", "office", "walk", 15, locations=("Elsewhere NSW 2999",)), *SEARCHES]
    with pytest.raises(guards.Refused) as refused:
        guards.require_plannable(asked, wide, Envelope(900, 0))
    assert [line.split(":")[0] for line in refused.value.reasons] == ["away", "rich"]
    guards.require_plannable(asked, SEARCHES, Envelope(900, 0))
    with pytest.raises(guards.Refused, match="2024-01-02T09:00:00") as refused:
        guards.require_arrive_by(asked)
    assert refused.value.reasons == ["home:transit (none)", "office:transit 2024-01-09T09:00:00+11:00"]
    guards.require_arrive_by(asked, force=True)
    guards.require_arrive_by(guards.Asked(groups, places, [], None))


def test_a_partial_search_marks_nothing_stale_and_says_so(spark, tmp_path):
    rows, state, first = run(spark, tmp_path / "a", capture({"1": 650, "2": 700}), "r1")
    later, rejections = frames(spark, tmp_path / "b", capture({"1": 650}))
    two = state.envelope.unionByName(state.envelope.withColumn("suburb_key", F.lit("other-2001")))
    old = first.ledger.withColumn("last_seen_run", F.lit("r0"))
    after = B.State(old, first.rejected, first.profiles, two, two, state.resolved)
    searched = spark.createDataFrame([("Sydney NSW 2000", 0)], "location STRING, location_pos INT")
    none = spark.createDataFrame([], "listing_id STRING, verdict STRING")
    args = (later, rejections, ["office:walk"], none, after, SCORING, Envelope(900, 0, exclude_keywords=["room"]), SEARCHES, "r2", "r1", "2024-01-02T00:00:00Z", "https://x/", "router")
    part = B.build(*args, searched=searched)
    assert {r.listing_id: r.status for r in part.ledger.collect()} == {"1": "active", "2": "active"}
    assert any(r.note.startswith("Partial search: 1 of 2 configured locations were queried (Sydney NSW 2000)") for r in part.notes.collect())
    whole = B.build(*args)
    assert {r.listing_id: r.status for r in whole.ledger.collect()} == {"1": "active", "2": "stale"}


def test_replay_names_what_a_fix_moves(spark, tmp_path):
    rows, state, done = run(spark, tmp_path / "a", capture({"1": 650, "2": 700}), "r1")
    moved = rows.withColumn("price", F.when(F.col("listing_id") == "1", F.lit("$640 pw")).otherwise(F.col("price"))).withColumn(
        "propertyType", F.when(F.col("listing_id") == "2", F.lit("Room")).otherwise(F.col("propertyType")))
    again = replay(moved, done.listings, done.ledger, state.profiles, SCORING, ["room"], B.covered(SEARCHES, ["office:walk"]), "https://x/", "router")
    assert {(r.field, r.listings, r.sample) for r in again.changes.collect()} >= {("price_pw", 1, "1"), ("price_display", 1, "1")}
    assert [r.listing_id for r in again.left.collect()] == ["2"] and again.violations.count() == 0
    assert [(r.fact, r.recorded, r.rebuilt) for r in again.drift.collect()] == [("price", 650, 640)]


def test_search_pass(spark):
    def item(i, address):
        return {"listing": {"id": str(i), "address": {"display": {"fullAddress": address}}}}

    html = page({"rentSearch": {"results": {"exact": {"items": [item(1, "3/5 A St, Sydney"), item(2, "5 A St, Sydney"), item(3, "9 Far Rd"), item(4, "1 Lost Ln")]}}}})
    pages = spark.createDataFrame([(1, html)], "page_id INT, html STRING")
    positions = spark.createDataFrame([("5 a st, sydney", -33.87, 151.2, "building", None, None), ("9 far rd", -33.0, 151.0, "street", None, None)],
                                      "key STRING, lat DOUBLE, lng DOUBLE, precision STRING, src STRING, at BIGINT")
    routes = spark.createDataFrame([("walk||1,2|-33.87,151.2", 5.04, 0.404)], "key STRING, minutes DOUBLE, km DOUBLE")
    far = spark.createDataFrame([("walk||1,2|-33,151", 80.0, 9.0)], "key STRING, minutes DOUBLE, km DOUBLE")
    some = search_pass(pages, "page_id", positions, routes, 0, "walk", 1.0, 2.0, 30)
    assert [r.listing_id for r in some.kept.collect()] == ["1", "2", "3", "4"] and some.rejected.count() == 0
    assert [(r.route_key, r.waiting) for r in some.unmeasured.collect()] == [("walk||1,2|-33,151", 1)]
    full = search_pass(pages, "page_id", positions, routes.unionByName(far), 0, "walk", 1.0, 2.0, 30)
    assert [(r.listing_id, r.travel and r.travel.minutes) for r in full.kept.collect()] == [("1", 5.0), ("2", 5.0), ("4", None)]
    assert [(r.listing_id, r.travel.precision) for r in full.rejected.collect()] == [("3", "street")]
    report = full.report.first()
    assert (report.listings, report.unique_buildings, report.routed, report.unresolved, report.building, report.street) == (4, 3, 3, 1, 2, 1)
