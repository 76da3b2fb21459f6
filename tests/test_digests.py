"""Comparing written snapshots by digests, and documents checked against a declared schema."""

from __future__ import annotations

import json
import shutil

import pytest
from pyspark.sql import functions as F

from listingflow.operators import digests as G
from listingflow.operators import snapshots as D
from listingflow.schemas import CAPTURE
from listingflow.sources import faults

ROW = "listing_id STRING, price INT, tags ARRAY<STRING>, travel MAP<STRING, STRUCT<minutes: DOUBLE, km: DOUBLE>>, note STRING"
FIELDS = ["price", "tags", "travel", "note"]


def rows(n: int) -> list[tuple]:
    return [(f"l{k}", k % 7 or None, ["a", None] if k % 3 else ["a"], {"x": (1.0, None), "y": (float(k), 2.0)}, "kept") for k in range(n)]


def test_diff_by_digest_equals_the_full_diff(spark, tmp_path):
    old = rows(400)
    new = [list(r) for r in old]
    new[5][1], new[7][2], new[9][3], new[11][2] = 99, ["a", "a"], {"y": (9.0, 2.0), "x": (None, 1.0)}, ["a"]
    new[12][3] = dict(reversed(new[12][3].items()))  # the same map
    new = new[:-3] + [["fresh", 1, [], {}, "kept"]]
    before, after = spark.createDataFrame(old, ROW), spark.createDataFrame([tuple(r) for r in new], ROW).repartition(5)
    a = G.write_snapshot(before, str(tmp_path / "a"), "listing_id", FIELDS, buckets=32)
    b = G.write_snapshot(after, str(tmp_path / "b"), "listing_id", FIELDS, buckets=32)
    full = sorted(map(tuple, D.change_report(before, after, FIELDS).collect()))
    assert full and sorted(map(tuple, G.diff_report(spark, a, b, FIELDS).collect())) == full
    touched = {r["bucket"] for r in G.differing(a.digests(spark), b.digests(spark)).collect()}
    assert 0 < len(touched) <= 8 and {r["field"] for r in G.differing(a.digests(spark), b.digests(spark)).collect()} >= {"price", "tags", "travel", G.KEYS}
    assert {r[0] for r in G.left_snapshot(spark, a, b).collect()} == {r[0] for r in old[-3:]}
    assert [r[0] for r in G.left_snapshot(spark, b, a).collect()] == ["fresh"]


def test_equal_snapshots_are_compared_without_their_rows(spark, tmp_path):
    df = spark.createDataFrame(rows(50), ROW)
    a = G.write_snapshot(df, str(tmp_path / "a"), "listing_id", FIELDS, buckets=4)
    b = G.write_snapshot(df.repartition(3), str(tmp_path / "b"), "listing_id", FIELDS, buckets=4)
    for side in "ab":
        shutil.move(str(tmp_path / side / "rows"), str(tmp_path / f"{side}-rows"))
    assert G.diff_report(spark, a, b, FIELDS).count() == 0 == G.left_snapshot(spark, a, b).count()


def test_only_differing_buckets_are_scanned(spark, tmp_path):
    old = rows(200)
    new = [(i, 5000 if i == "l17" else p, *rest) for i, p, *rest in old]
    a, b = (G.write_snapshot(spark.createDataFrame(data, ROW), str(tmp_path / name), "listing_id", FIELDS, buckets=16) for name, data in (("a", old), ("b", new)))
    parts = G._parts(spark, a, b, FIELDS)
    assert parts[2] == ["price"] and parts[0].columns == ["listing_id", "price"]
    assert len(parts[0].inputFiles()) == 16 and parts[0].count() < 40
    assert "PartitionFilters: [isnotnull(bucket" in parts[0]._jdf.queryExecution().toString()


DOCUMENTS = {
    "sound": {"source": "s", "captured_at": "t", "gone": {"9": "leased"}, "groups": [{"origin": "o", "mode": "walk", "max_travel_minutes": 15, "results": [{"id": "1", "address": "a", "bedrooms": 2}]}], "other": 1},
    "faulty": {"source": 3, "gone": {"9": "sold"}, "groups": [{"origin": None, "mode": "fly", "max_travel_minutes": "x", "results": [{"id": "1"}, {"id": 2, "address": "b", "bedrooms": 1.5, "coords": {"lat": "no"}}]}, 7], "results": {}},
}


def test_faults_name_their_fields(spark):
    texts = [(k, json.dumps(v)) for k, v in DOCUMENTS.items()] + [("cut", "{"), ("list", "[1]"), ("null", None)]
    df = spark.createDataFrame(texts, "name string, text string")
    got = {tuple(r) for r in faults.fault_rows(df, "name", "text", CAPTURE, faults.CAPTURE_RULES).collect()}
    listed = "expected one of"
    assert got == {
        ("faulty", "source", "expected string, found number"), ("faulty", "captured_at", "required"),
        ("faulty", "gone.9", f"{listed} leased, withdrawn, unmatched, found sold"), ("faulty", "groups.0.origin", "expected string, found null"),
        ("faulty", "groups.0.mode", f"{listed} walk, drive, transit, found fly"), ("faulty", "groups.0.max_travel_minutes", "expected number, found string"),
        ("faulty", "groups.0.results.0.address", "required"), ("faulty", "groups.0.results.1.id", "expected string, found number"),
        ("faulty", "groups.0.results.1.bedrooms", "expected a whole number"), ("faulty", "groups.0.results.1.coords.lat", "expected number, found string"),
        ("faulty", "groups.1", "expected object, found number"), ("faulty", "results", "expected array, found object"),
        ("cut", "(root)", "not valid JSON"), ("list", "(root)", "expected object, found array"), ("null", "(root)", "not valid JSON"),
    }
    assert faults.require_sound(df.where("name = 'sound'"), "name", "text", CAPTURE, faults.CAPTURE_RULES).count() == 1
    with pytest.raises(Exception, match="faulty failed schema validation: source: expected string, found number; captured_at: required"):
        faults.require_sound(df.where("name = 'faulty'"), "name", "text", CAPTURE, faults.CAPTURE_RULES).select(F.length("text")).collect()
