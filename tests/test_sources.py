import hashlib
import json
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from listingflow.operators import capture as C
from listingflow.sources import caches, captures, pages, runs, splits
from listingflow.schemas import CAPTURE


def listing(i, **extra):
    return {"id": str(i), "address": f"{i} A St, Sydney, NSW 2000", "price": "$650 pw", **extra}


def leg(minutes, mode="walk"):
    return {"minutes": minutes, "km": 1.0, "mode": mode, "precision": "building"}


GROUPED = {
    "source": "s", "captured_at": "2024-01-01T00:00:00Z", "gone": {"9": "leased"},
    "groups": [
        {"origin": "office", "mode": "walk", "max_travel_minutes": 30,
         "results": [listing(1, price="$700 pw", travel=leg(5)), listing(2), listing(1, price="$1", travel=leg(9)), listing(1)],
         "filtered_by_travel": [{"id": "7", "url": "u", "address": "far", "coords": {"lat": 1.0, "lng": 2.0}, "travel": leg(99)}]},
        {"origin": "office", "mode": "transit", "max_travel_minutes": 30, "arrive_by": "t", "results": [listing(1, travel=leg(7, "transit")), listing(3, address=" ")]},
    ],
    "results": [listing(55)],
}
FLAT = {"source": "s", "captured_at": "t", "groups": [], "results": [listing(4), listing(4), listing(5)]}


def store(folder, **files):
    for name, body in files.items():
        (folder / f"{name}.json").write_text(body if isinstance(body, str) else json.dumps(body))
    return str(folder)


def test_capture_rows_and_flattening(spark, tmp_path):
    docs = captures.read_captures(spark, store(tmp_path, a=GROUPED))
    rows = captures.capture_rows(docs)
    assert [(r.group_pos, r.row_pos, r.listing_id) for r in rows.orderBy("group_pos", "row_pos").collect()] == [
        (0, 0, "1"), (0, 1, "2"), (0, 2, "1"), (0, 3, "1"), (1, 0, "1"), (1, 1, "3")]
    flat = {r.listing_id: r for r in C.unique_listings(rows, ["price", "address"]).collect()}
    # First occurrence's facts, each pass's last measured time.
    assert flat["1"].price == "$700 pw" and {k: v.minutes for k, v in flat["1"].travel.items()} == {"office:walk": 9.0, "office:transit": 7.0}
    assert flat["2"].travel == {}
    assert {r.travel_key: r.considered for r in C.group_totals(rows).collect()} == {"office:walk": 2, "office:transit": 2}
    assert [(r.listing_id, r.occurrences) for r in C.blank_addresses(rows).collect()] == [("3", 1)]
    assert sorted(r.listing_id for r in C.returned_ids(rows).collect()) == ["1", "2", "3"]
    lost = captures.rejected_rows(docs).first()
    assert (lost.listing_id, lost.travel_key, lost.lat, lost.lon, lost.travel.minutes) == ("7", "office:walk", 1.0, 2.0, 99.0)
    assert [(g.mode, g.arrive_by) for g in captures.capture_groups(docs).orderBy("group_pos").collect()] == [("walk", None), ("transit", "t")]


def test_legacy_flat_form(spark, tmp_path):
    rows = captures.capture_rows(captures.read_captures(spark, store(tmp_path, a=FLAT)))
    assert sorted((r.listing_id, r.travel_key) for r in rows.collect()) == [("4", None), ("4", None), ("5", None)]
    assert C.group_totals(rows).count() == 0 and C.unique_listings(rows, ["price"]).count() == 2


def test_schema_check(spark, tmp_path):
    path = store(tmp_path, good=GROUPED, bad='{"source": 3, "groups": "no"')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        captures.read_captures(spark, path).collect()
    lenient = captures.read_documents(spark, path, CAPTURE, strict=False).cache()
    assert [r.source_path.rsplit("/", 1)[1] for r in captures.quarantined(lenient).collect()] == ["bad.json"]


def test_budget_keeps_the_unknown(spark, tmp_path):
    rows = captures.capture_rows(captures.read_captures(spark, store(tmp_path, a=GROUPED)))
    assert C.within_budget(rows, 6).count() == 4 and [r.travel.minutes for r in C.over_budget(rows, 6).collect()] == [9.0, 7.0]
    assert [r.travel and r.travel.minutes for r in C.nearest_first(rows).collect()] == [5.0, 7.0, 9.0, None, None, None]


GEO = {"lat": -33.8, "lng": 151.2, "precision": "building"}


@pytest.mark.parametrize(
    "body, expected",
    [({"routes": {"walk|x": {"minutes": 5, "km": 0.4}}, "geo": {"a st": GEO}}, ("ok", 1, 1, 0)),
     ({"routes": {"walk|x": {"minutes": 5, "km": 0.4}}, "geo": {"": GEO, "a": GEO}}, ("unreadable", 1, 2, 1)), ("{nope", ("unreadable", 0, 0, 0))],
)
def test_cache_states(spark, tmp_path, body, expected):
    docs = caches.read_cache_documents(spark, store(tmp_path, c=body))
    assert tuple(caches.cache_state(spark, docs).first()) == expected
    if expected[0] == "ok":
        assert caches.cached_positions(docs).first().key == "a st" and caches.cached_routes(docs).first().minutes == 5.0


def test_missing_cache_is_not_an_unreadable_one(spark, tmp_path):
    docs = caches.read_cache_documents(spark, str(tmp_path / "nope.json"))
    assert docs is None and caches.cache_state(spark, docs).first().state == "missing"


def page(*payloads, extra=""):
    layers = {"app": {"n": 1, "cache": json.dumps({"bad": {"data": "{"}, **{f"h{i}": {"data": json.dumps(p)} for i, p in enumerate(payloads)}})}, "m": 3}
    return f"<html><script>window.ArgonautExchange = {json.dumps(layers)};{extra}</script></html>"


def items(spark, html, read):
    rows = spark.createDataFrame([(1, html)], "page_id INT, html STRING")
    return read(pages.page_payloads(rows), "page_id").select("*", *pages.normalised_item(F.col("item"))).orderBy("listing_id").collect()


NODE = {"id": 12, "address": {"display": {"shortAddress": "1 A St", "geocode": {"latitude": 0, "longitude": 0}}, "location": {"lat": "-33.8", "lon": 151.2}},
        "price": {"information": "Call"}, "propertySizes": {"land": {"displayValue": "108"}, "building": {"displayValue": "80", "sizeUnit": {"display": "sqm"}}},
        "listers": [{"name": "N", "_links": {"canonical": {"href": "h?cid={cid}"}}}], "media": {"images": [{"templatedUrl": "i/{size}/1"}, {}]}}


def test_search_page(spark):
    found = {"rentSearch": {"results": {"exact": {"items": [{"listing": NODE}]}, "surrounding": {"items": [{"id": "13"}]}, "totalResultsCount": 2}}}
    rows = items(spark, page({"other": 1}, found, extra="window.x=1"), pages.search_rows)
    assert [(r.listing_id, r.is_surrounding, r.total_results) for r in rows] == [("12", False, 2), ("13", True, 2)]
    one = rows[0]
    assert (one.address, one.price, one.land_size, one.building_size, one.images) == ("1 A St", "Call", "108m²", "80sqm", ["i/1024x768/1"])
    assert (one.coords.lat, one.coords.lng, one.agents[0].profile_url) == (-33.8, 151.2, "h")
    unnamed = {"odd": {"results": {"exact": {"items": [{"id": "5"}]}}}}
    assert [r.listing_id for r in items(spark, page(unnamed), pages.search_rows)] == ["5"]


def test_detail_page(spark):
    wrapped = {"details": {"listing": NODE, "relatedListings": [{"id": 4}, {}]}}
    loose = {"a": 1, "b": {"listing": {"id": "77", "address": {"suburb": "X"}}}}
    assert [(r.listing_id, r.related_ids) for r in items(spark, page(loose, wrapped), pages.detail_rows)] == [("12", ["4"])]
    assert [r.listing_id for r in items(spark, page(loose), pages.detail_rows)] == ["77"]
    assert items(spark, "<html>no data</html>", pages.detail_rows) == []


def test_publish_is_immutable(spark, tmp_path):
    root = str(tmp_path)
    part = spark.createDataFrame([("b", "k2"), ("a", "k1")], "listing_id STRING, suburb_key STRING")
    row = spark.createDataFrame([("2024-01-01a", 0, 2, 1, 3)], "run_id STRING, position BIGINT, listing_count BIGINT, new_count BIGINT, criteria_version INT")
    runs.publish_run("2024-01-01a", root, part, part, part, part, row)
    manifest = runs.read_manifest(spark, root)
    assert manifest.count() == 1
    assert [r.listing_id for r in spark.read.parquet(f"{root}/runs/run_id=2024-01-01a").collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="immutable"):
        runs.publish_run("2024-01-01a", root, part, part, part, part, row)
    runs.publish_run("2024-01-01b", root, part, part, part, part, row.withColumn("run_id", F.lit("2024-01-01b")))
    assert runs.read_manifest(spark, root).count() == 2


def file_hashes(path) -> list[str]:
    return sorted(hashlib.sha256(f.read_bytes()).hexdigest() for f in path.glob("*.parquet"))


def test_the_same_rows_are_written_to_the_same_bytes(spark, tmp_path):
    rows = [(f"office/{k * 7919 % 3000}", k % 5, {"b": k, "a": 1} if k % 2 else {"a": 1, "b": k}) for k in range(3000)] + [(None, 1, {}), ("é", 2, {"x": 0})]
    turned = [(i, n, dict(reversed(m.items()))) for i, n, m in reversed(rows)]
    schema = "listing_id STRING, n INT, m MAP<STRING, INT>"
    for name, data, tasks, partitions in (("a", rows, 3, "8"), ("b", turned, 11, "8"), ("c", rows, 1, "5")):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        splits.write_sorted(spark.createDataFrame(data, schema).repartition(tasks), str(tmp_path / name), ["listing_id"], rows_per_file=400)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    first = file_hashes(tmp_path / "a")
    assert len(first) >= 8 and first == file_hashes(tmp_path / "b") == file_hashes(tmp_path / "c")
    files = [[r.listing_id for r in spark.read.parquet(str(f)).collect()] for f in sorted((tmp_path / "a").glob("*.parquet"))]
    flat = [i for f in files for i in f]
    assert all(len(f) <= 400 for f in files) and flat == sorted(flat, key=lambda i: (i is not None, i or "")) and len(flat) == len(rows)


def test_numbers_and_hot_keys_split_in_order(spark):
    keys = [-5, -1, 0, 3, 1 << 40] + [7] * 50 + list(range(100, 160))
    df = spark.createDataFrame([(k,) for k in keys], "k BIGINT").repartition(4)
    bounds = splits.file_bounds(df, "k", rows_per_file=20)
    placed = df.select("k", splits.range_of(splits.ordered_text(F.col("k"), df.schema["k"].dataType), bounds).alias("f")).orderBy("k").collect()
    assert [r.f for r in placed] == sorted(r.f for r in placed) and max(Counter(r.f for r in placed if r.k != 7).values()) <= 20
    assert splits.file_bounds(df.limit(0), "k") == [] and splits.file_bounds(df, "k") == []


def test_one_of_two_publishers_wins(spark, tmp_path):
    root = str(tmp_path)
    row = spark.createDataFrame([("2024-01-01a", 0, 1, 1, 3, "2024-01-01", "t", None)], runs.MANIFEST)

    def publish(name: str) -> str:
        part = spark.createDataFrame([(name, "k")], "listing_id STRING, suburb_key STRING")
        try:
            runs.publish_run("2024-01-01a", root, part, part, part, part, row)
            return name
        except ValueError as refused:
            assert "immutable" in str(refused)
            return ""

    with ThreadPoolExecutor(4) as pool:
        winners = [w for w in pool.map(publish, ["p", "q", "r", "s"]) if w]
    assert len(winners) == 1
    assert [r.listing_id for r in spark.read.parquet(f"{root}/runs/run_id=2024-01-01a").collect()] == winners
    assert runs.current_run(runs.published_runs(spark, root)).first().current_run == "2024-01-01a"


def test_ids_are_reserved_once(spark, tmp_path):
    moment = spark.sql("select timestamp_ntz'2024-01-01 14:00:00' as utc_now")
    with ThreadPoolExecutor(4) as pool:
        ids = list(pool.map(lambda _: runs.reserve_run_id(spark, str(tmp_path), moment), range(4)))
    assert sorted(ids) == [f"2024-01-02{c}" for c in "abcd"]


def test_half_a_run_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    part = spark.createDataFrame([("a", "k1")], "listing_id STRING, suburb_key STRING")
    row = spark.createDataFrame([("2024-01-01a", 0, 1, 1, 3, "2024-01-01", "t", None)], runs.MANIFEST)
    broken = part.withColumn("suburb_key", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        runs.publish_run("2024-01-01a", root, part, part, broken, part, row)
    assert runs.published_runs(spark, root).count() == 0 and runs.current_run(runs.published_runs(spark, root)).first().current_run is None
    with pytest.raises(ValueError, match="being published"):
        runs.publish_run("2024-01-01a", root, part, part, part, part, row)
    runs.publish_run("2024-01-01a", root, part, part, part, part, row, reserved=True)
    assert [r.date for r in runs.published_runs(spark, root).collect()] == ["2024-01-01"]
    with pytest.raises(ValueError, match="already exists"):
        runs.publish_run("2024-01-01a", root, part, part, part, part, row, reserved=True)


def test_next_run_id(spark):
    moment = spark.sql("select timestamp_ntz'2024-01-01 14:00:00' as utc_now")
    taken = spark.createDataFrame([("2024-01-02a",), ("2024-01-02b",), ("2024-01-01c",)], "run_id STRING")
    assert runs.next_run_id(moment, taken).first().run_id == "2024-01-02c"
    full = spark.createDataFrame([(f"2024-01-02{chr(97 + k)}",) for k in range(26)], "run_id STRING")
    with pytest.raises(Exception, match="no run id is left"):
        runs.next_run_id(moment, full).collect()


def test_sorted_entries(values):
    entries = F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2))
    assert [e.key for e in values(runs.sorted_entries(entries))[0]] == ["a", "b"]
