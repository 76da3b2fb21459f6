import random

from pyspark.sql import functions as F

from listingflow.operators import ledger as L
from listingflow.operators.rejected import fold_rejected
from listingflow.schemas import LEDGER, REJECTED

NEW = "listing_id STRING, url STRING, address STRING, suburb STRING, postcode STRING, lat DOUBLE, lon DOUBLE, price_pw INT, beds INT, baths INT, car_spaces INT, area_sqm INT"


def sighted(spark, rows):
    return spark.createDataFrame([(i, "u", "a", "s", "2000", lat, lat, p, 1, 1, 0, None) for i, p, lat in rows], NEW)


def fold(spark, ledger, rows, run, previous, verdicts=(), returned=(), stale=True):
    back = spark.createDataFrame([(i,) for i, *_ in rows] + [(i,) for i in returned], "listing_id STRING")
    v = spark.createDataFrame(list(verdicts), "listing_id STRING, verdict STRING")
    return L.fold_run(ledger, sighted(spark, rows), back, v, run, previous, stale)


def test_fold_outcomes(spark):
    empty = spark.createDataFrame([], LEDGER)
    first = fold(spark, empty, [("a", 700, 1.0), ("b", 600, None), ("c", None, None), ("d", 500, None), ("e", 400, None)], "r1", None)
    assert {r.state for r in first.collect()} == {"new"}
    one = first.drop(*L.FOLD_COLUMNS)
    second = fold(spark, one, [("a", 750, None), ("c", 650, None)], "r2", "r1", [("b", "leased"), ("e", "unmatched")], returned=["x"])
    got = {r.listing_id: r for r in second.collect()}
    # A price rise is labelled like a drop, a move from "contact agent" is history but no change.
    assert (got["a"].state, got["a"].prev_pw, got["a"].delta_pw, got["a"].lat) == ("price_drop", 700, 50, 1.0)
    assert got["c"].state == "carried_over" and len(got["c"].price_history) == 2
    assert (got["b"].status, got["d"].status, got["d"].absent, got["e"].status) == ("leased", "active", True, "unmatched")
    two = second.drop(*L.FOLD_COLUMNS)
    third = fold(spark, two, [("b", 600, None), ("e", 400, None)], "r3", "r2", returned=["c"])
    got = {r.listing_id: r for r in third.collect()}
    assert (got["b"].state, got["b"].relist_count, [p.status for p in got["b"].status_history]) == ("relisted", 1, ["active", "leased", "active"])
    # Unmatched was absent but never gone: no relist.
    assert (got["e"].state, got["e"].relist_count, len(got["e"].status_history)) == ("carried_over", 0, 3)
    # Missing twice goes stale; returned but unusable is not absent; missing once is left alone.
    assert (got["d"].status, got["c"].status, got["a"].status) == ("stale", "active", "active")
    partial = fold(spark, two, [], "r3", "r2", stale=False)
    assert {r.listing_id: r.status for r in partial.collect()}["d"] == "active"


def test_history_equals_folding(spark):
    rng = random.Random(7)
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    rows = [(f"l{i}", d, rng.choice([300, 350, 400])) for i in range(12) for d in days for _ in range(rng.randint(0, 2))]
    rows += [("anchor", d, 300) for d in days]  # every run exists
    seen = spark.createDataFrame(rows, "listing_id STRING, run_id STRING, price_pw INT")
    runs = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "run_id STRING, run_pos INT")
    at_once = {(r.listing_id, r.run_id): (r.state, r.prev_pw, r.delta_pw, r.relist_count) for r in L.sighting_history(seen, runs).collect()}
    # The same by folding one run after another, as plain values.
    book, folded, previous = {}, {}, None
    for day in days:
        prices = {}
        for i, d, p in rows:
            if d == day:
                prices[i] = min(p, prices.get(i, p))
        ledger = spark.createDataFrame([book[k] for k in sorted(book)], LEDGER)
        out = fold(spark, ledger, [(i, p, None) for i, p in prices.items()], day, previous).collect()
        for r in out:
            if r.state:
                folded[(r.listing_id, day)] = (r.state, r.prev_pw, r.delta_pw, r.relist_count)
        names = spark.createDataFrame([], LEDGER).columns
        book = {r.listing_id: tuple(r[n] for n in names) for r in out}
        previous = day
    assert at_once == folded


LEG = "minutes: DOUBLE, km: DOUBLE, mode: STRING, precision: STRING"
ROW = f"group_pos INT, row_pos INT, travel_key STRING, listing_id STRING, url STRING, address STRING, lat DOUBLE, lon DOUBLE, travel STRUCT<{LEG}>"


def plain_fold(previous, rows, tracked, run, at):
    """The rule row by row: what the set-based form must equal."""
    held = {k: dict(v) for k, v in previous.items()}
    for _, _, key, i, url, address, lat, lon, leg in sorted(rows, key=lambda r: r[:2]):
        if not url:
            continue
        before = held.get(i)
        travel = dict(before["travel"]) if before and before["address"] == address else {}
        if leg:
            travel[key] = (*leg, at, address)
        held[i] = {"url": url, "address": address, "lat": lat, "lon": lon, "travel": travel, "run": run}
    return {k: v for k, v in held.items() if k not in tracked}


def test_rejected_equals_the_ordered_fold(spark):
    rng = random.Random(3)
    for _ in range(3):
        rows = [
            (g, p, f"office:{g}", f"r{rng.randint(0, 9)}", rng.choice(["u1", "u2", None, ""]), rng.choice(["A", "A", "B"]), float(p), 1.0,
             rng.choice([None, (float(p), 1.0, "walk", "street")]))
            for g in range(3) for p in range(40)
        ]
        previous = {f"r{i}": {"url": "old", "address": rng.choice("AB"), "lat": None, "lon": None, "run": "r0",
                              "travel": {"home:1": (1.0, 1.0, "walk", "street", "t0", "x"), "office:1": (2.0, 1.0, "walk", "street", "t0", "x")}} for i in range(0, 14, 2)}
        frame = spark.createDataFrame([(k, v["url"], v["address"], v["lat"], v["lon"], v["travel"], v["run"]) for k, v in previous.items()], REJECTED)
        tracked = spark.createDataFrame([("r4",), ("zz",)], "listing_id STRING")
        out = fold_rejected(frame, spark.createDataFrame(rows, ROW), tracked, "r9", "t9").collect()
        got = {r.listing_id: {"url": r.url, "address": r.address, "lat": r.lat, "lon": r.lon, "run": r.last_seen_run,
                              "travel": {k: tuple(v) for k, v in r.travel.items()}} for r in out}
        assert got == plain_fold(previous, rows, {"r4"}, "r9", "t9")


def test_absence(spark):
    empty = spark.createDataFrame([], LEDGER)
    ledger = fold(spark, empty, [("a", 1, None), ("b", 1, None), ("c", 1, None)], "r1", None).drop(*L.FOLD_COLUMNS)
    back = spark.createDataFrame([("a",), ("a",)], "listing_id STRING")
    known = spark.createDataFrame([("b", "leased")], "listing_id STRING, verdict STRING")
    assert [r.listing_id for r in L.absent_listings(ledger, back, known).collect()] == ["c"]
    pages = spark.createDataFrame([("1", True, "Deposit Taken"), ("2", True, None), ("3", False, "Leased"), ("4", True, "$650")], "listing_id STRING, fetched BOOLEAN, price STRING")
    got = {r.listing_id: (r.verdict, r.evidence) for r in L.absence_verdicts(pages).collect()}
    assert got == {"1": ("leased", "Deposit Taken"), "2": ("unmatched", "page live"), "3": (None, None), "4": ("unmatched", "$650")}


def test_partial_search(spark):
    def check(n):
        done = spark.range(n).select(F.col("id").cast("string").alias("location"))
        return L.partial_search(done, spark.range(5)).first().partial

    assert [check(0), check(3), check(5)] == [False, True, False]
