"""A ledger kept in buckets against the fold of the whole ledger."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from listingflow.operators.ledger import FOLD_COLUMNS, fold_run
from listingflow.schemas import LEDGER
from listingflow.sources import ledger_versions as V

LISTING = (
    "listing_id STRING, url STRING, address STRING, suburb STRING, postcode STRING, lat DOUBLE, lon DOUBLE, price_pw INT, "
    "beds INT, baths INT, car_spaces INT, area_sqm INT"
)
BUCKETS = 64


def listing(k: int, price: int | None) -> tuple:
    return (f"l{k}", f"u{k}", "a", "s", "2000", k / 10 if k % 3 else None, 1.0, price, k % 4, 1, None, None)


def as_text(df) -> list[str]:
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*sorted(df.columns)))).collect())


@pytest.fixture
def runs(spark):
    """(run id, listings, returned, verdicts, may go stale)"""
    full = [listing(k, 400 + k if k % 7 else None) for k in range(300)]
    second = [listing(k, 400 + k + k % 2) for k in range(20, 310)]
    third = [listing(k, 500) for k in (0, 25, 400)]
    told = [("l30", "leased"), ("l31", "unmatched"), ("l2", "leased"), ("nowhere", "leased"), ("l40", None), ("l50", "leased")]

    def frames(run_id, rows, also, verdicts, stale):
        ids = [(r[0],) for r in rows] + [(i,) for i in also]
        return (
            run_id, spark.createDataFrame(rows, LISTING), spark.createDataFrame(ids + ids[:2], "listing_id STRING"),
            spark.createDataFrame(verdicts, "listing_id STRING, verdict STRING"), stale,
        )

    return [
        frames("2024-01-01", full, [], [], False), frames("2024-01-02", second, ["l3"], [("l4", "leased")], True),
        frames("2024-01-03", third, ["l50"], told, False), frames("2024-01-04", second[:50], [], [], True),
    ]


def test_versions_equal_the_fold_of_the_whole_ledger(spark, tmp_path, runs):
    root, previous, plain = str(tmp_path), None, spark.createDataFrame([], LEDGER)
    texts = {}
    for run_id, listings, returned, verdicts, stale in runs:
        whole = fold_run(plain, listings, returned, verdicts, run_id, previous, stale).cache()
        decided = V.fold_version(spark, root, previous, listings, returned, verdicts, run_id, previous, stale, BUCKETS)
        assert as_text(decided) == as_text(whole.where("state is not null or absent_status is not null"))
        plain = whole.drop(*FOLD_COLUMNS)
        texts[run_id] = as_text(plain)
        assert as_text(V.read_version(spark, root, run_id)) == texts[run_id]
        previous = run_id
    for run_id, text in texts.items():  # older versions are still what they were
        assert as_text(V.read_version(spark, root, run_id)) == text
    both = V.read_version(spark, root, "2024-01-03").unionByName(V.read_version(spark, root, "2024-01-04"))
    statuses = {r["status"] for r in both.select("status").distinct().collect()}
    assert statuses == {"active", "leased", "unmatched", "stale"}


def test_a_small_run_writes_only_the_buckets_it_touches(spark, tmp_path, runs):
    root = str(tmp_path)
    (first, *a), (second, *b), (third, *c), _ = runs
    V.fold_version(spark, root, None, *a[:3], first, None, a[3], BUCKETS)
    V.fold_version(spark, root, first, *b[:3], second, first, b[3], BUCKETS)
    V.fold_version(spark, root, second, *c[:3], third, second, c[3], BUCKETS)
    keys = spark.createDataFrame([("l0",), ("l25",), ("l400",), ("l30",), ("l31",), ("l2",)], "listing_id STRING")
    changed = {r[0] for r in keys.select(V.bucket_of(F.col("listing_id"), BUCKETS)).collect()}
    written = {int(p.name.removeprefix("bucket=")) for p in (tmp_path / "rows" / f"version={third}").glob("bucket=*")}
    # l2 has been away since the second run and is told only now; l50 came back unread, l40 was checked without a result and
    # "nowhere" is in no ledger, so they change nothing.
    assert written == changed
    placed = V._placed(spark, root, third)
    assert {k for k, v in placed.items() if v == third} == written and set(placed.values()) <= {first, second, third}


def test_a_finished_version_is_not_replaced_and_an_unfinished_one_is(spark, tmp_path, runs):
    root = str(tmp_path)
    run_id, listings, returned, verdicts, stale = runs[0]
    V.fold_version(spark, root, None, listings, returned, verdicts, run_id, None, stale, BUCKETS)
    before = as_text(V.read_version(spark, root, run_id))
    with pytest.raises(ValueError, match="already exists"):
        V.fold_version(spark, root, None, listings.limit(3), returned, verdicts, run_id, None, stale, BUCKETS)
    assert as_text(V.read_version(spark, root, run_id)) == before
    later = runs[1]
    V._write(V.read_version(spark, root, run_id).limit(5), root, "2024-01-09", {}, [], BUCKETS)
    (tmp_path / "committed" / "2024-01-09").rename(tmp_path / "lost")  # as if the attempt had died before its last step
    with pytest.raises(ValueError, match="no version"):
        V.read_version(spark, root, "2024-01-09")
    V.fold_version(spark, root, run_id, *later[1:4], "2024-01-09", run_id, later[4], BUCKETS)
    assert V.read_version(spark, root, "2024-01-09").count() == 310


def test_an_empty_run_changes_nothing(spark, tmp_path, runs):
    root = str(tmp_path)
    run_id, listings, returned, verdicts, stale = runs[0]
    V.start_versions(fold_run(spark.createDataFrame([], LEDGER), listings, returned, verdicts, run_id, None, stale).drop(*FOLD_COLUMNS), root, run_id, BUCKETS)
    none = [df.limit(0) for df in (listings, returned, verdicts)]
    assert V.fold_version(spark, root, run_id, *none, "2024-01-02", run_id, False, BUCKETS).count() == 0
    assert as_text(V.read_version(spark, root, "2024-01-02")) == as_text(V.read_version(spark, root, run_id))
    assert set(V._placed(spark, root, "2024-01-02").values()) == {run_id}
