"""Consistency checks as violation rows: ``severity, rule, key, detail``. No row means no fault."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .journeys import FERRY_CLASS, RECONCILE_MINUTES, WALK_METRES_SLACK, WALK_SUSPECT_KMH, is_walk, retimed_minutes


def violations(rows: DataFrame, rule: str, key: Column, detail: Column | None = None, severity: str = "fail") -> DataFrame:
    return rows.select(
        F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), key.cast("string").alias("key"),
        (F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit("null"))).alias("detail"),
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def check_rows(rows: DataFrame, key: Column, rules: dict[str, Column], severity: str = "fail") -> DataFrame:
    """Row-local rules in one pass: ``rules`` maps a name to the condition that must hold."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return rows.select(key.alias("_key"), F.explode(F.array_compact(F.array(*broken))).alias("_rule")).select(
        F.lit(severity).alias("severity"), F.col("_rule").alias("rule"), F.col("_key").cast("string").alias("key"),
        F.lit("").alias("detail"),
    )


def manifest_checks(manifest: DataFrame, runs: DataFrame, current: DataFrame) -> DataFrame:
    """``manifest``: run_id, date, listing_count, new_count, criteria_version. ``runs``: run_id,
    listings, new, criteria_version, snapshot_version, searches. ``current``: one row ``current_run``."""
    key = F.col("run_id")
    both = manifest.alias("m").join(runs.alias("r"), "run_id")
    return union_all([
        violations(manifest.groupBy("run_id").agg(F.count("*").alias("n")).filter("n > 1"), "duplicate_run", key, F.col("n")),
        violations(manifest.join(runs, "run_id", "left_anti"), "run_missing", key),
        violations(runs.join(manifest, "run_id", "left_anti"), "run_not_listed", key),
        violations(
            current.join(manifest, current["current_run"] == manifest["run_id"], "left_anti"), "current_run_unknown",
            F.col("current_run"),
        ),
        check_rows(
            both, key,
            {
                "date_disagrees": F.col("m.date") == F.left(key, F.lit(10)),
                "listing_count_disagrees": F.col("m.listing_count") == F.col("r.listings"),
                "new_count_disagrees": F.col("m.new_count") == F.col("r.new"),
                "criteria_version_disagrees": F.col("m.criteria_version") == F.col("r.criteria_version"),
                "snapshot_version_disagrees": F.col("r.snapshot_version") == F.col("r.criteria_version"),
            },
        ),
    ])


def _fault(rule: str, detail: Column | str = "") -> Column:
    text = F.lit(detail) if isinstance(detail, str) else F.coalesce(detail.cast("string"), F.lit("null"))
    return F.struct(F.lit(rule).alias("rule"), text.alias("detail"))


def _broken(rules: dict[str, Column]) -> Column:
    """The faults of a row: ``rules`` maps a name to the condition that must hold."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), _fault(name)) for name, ok in rules.items()]))


def _searches_by_run(searches: DataFrame, name: str) -> DataFrame:
    """The searches of each run, which are configuration, as one list."""
    return searches.groupBy("run_id").agg(F.collect_set("search_id").alias(name))


def _flagged(keys: DataFrame, key: Column, name: str, flag: str) -> DataFrame:
    return keys.select(key.alias(name)).distinct().withColumn(flag, F.lit(True))


def reference_checks(listings: DataFrame, ledger: DataFrame, suburbs: DataFrame, runs: DataFrame,
                     defined: DataFrame, asked: DataFrame, results: DataFrame) -> DataFrame:
    """References of published listings. ``listings``: run_id, listing_id, suburb_key, first_seen_run,
    matched_searches, image_count, hero, photos. ``defined``, ``asked``: run_id, search_id.
    ``results``: run_id, search_id, matched, considered.

    The listings are read once: every reference is a flag joined to the row, every fault a member of one list.
    """
    rows = (
        listings.join(_flagged(ledger, F.col("listing_id"), "listing_id", "_in_ledger"), "listing_id", "left")
        .join(_flagged(suburbs, F.col("suburb_key"), "suburb_key", "_has_suburb"), "suburb_key", "left")
        .join(_flagged(runs, F.col("run_id"), "first_seen_run", "_has_first"), "first_seen_run", "left")
        .join(_searches_by_run(defined, "_defined"), "run_id", "left")
        .join(_searches_by_run(asked, "_asked"), "run_id", "left")
    )
    none = F.array().cast("array<string>")

    def claims_outside(rule: str, known: Column) -> Column:
        outside = F.filter("matched_searches", lambda s: ~F.array_contains(known, s))
        return F.transform(outside, lambda s: _fault(rule, s))

    faults = F.concat(
        _broken(
            {
                "not_in_ledger": F.col("_in_ledger"),
                "matched_no_search": F.col("_defined").isNull() | (F.size("matched_searches") > 0),
                "image_count_disagrees": F.col("image_count") == F.size("photos"),
                "hero_not_first": F.col("hero").eqNullSafe(F.get("photos", F.lit(0))),
            }
        ),
        F.array_compact(
            F.array(
                F.when(F.col("_has_suburb").isNull(), _fault("suburb_unknown", F.col("suburb_key"))),
                F.when(F.col("_has_first").isNull(), _fault("first_run_unknown", F.col("first_seen_run"))),
            )
        ),
        claims_outside("search_undefined", F.coalesce("_defined", none)),
        # A run that asked nothing predates named searches.
        F.coalesce(claims_outside("search_not_asked", F.col("_asked")), F.array().cast("array<struct<rule:string,detail:string>>")),
    )
    found = rows.select(F.concat_ws("/", "run_id", "listing_id").alias("key"), F.explode(faults).alias("f"))
    result_key = F.concat_ws("/", "run_id", "search_id")
    return union_all([
        found.select(F.lit("fail").alias("severity"), "f.rule", "key", "f.detail"),
        violations(results.join(defined, ["run_id", "search_id"], "left_anti"), "result_undefined", result_key),
        violations(results.filter("matched > considered"), "matched_more_than_considered", result_key, F.col("matched")),
    ])


def ledger_checks(ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """Every run a ledger row mentions is known; its last status is its status; its photo count is its number of photo
    files. ``ledger``: listing_id, status, first_seen_run, last_seen_run, the two histories, image_count, image_files.

    The ledger is read once: faults of the row itself travel beside the runs it mentions.
    """

    def mention(place: str, run: Column) -> Column:
        return F.struct(F.lit(None).cast("string").alias("rule"), F.lit(place).alias("place"), run.alias("run_id"))

    def history(name: str) -> Column:
        return F.transform(name, lambda point: mention(name, point["run"]))

    last = F.try_element_at("status_history", F.lit(-1))["status"]
    own = _broken(
        {
            "status_disagrees": last.eqNullSafe(F.col("status")),
            "file_count_disagrees": F.col("image_count") == F.coalesce(F.size("image_files"), F.lit(0)),
        }
    )
    said = F.concat(
        F.array(mention("first_seen_run", F.col("first_seen_run")), mention("last_seen_run", F.col("last_seen_run"))),
        history("price_history"), history("status_history"),
        F.transform(own, lambda f: F.struct(f["rule"].alias("rule"), F.lit("").alias("place"), F.lit(None).cast("string").alias("run_id"))),
    )
    known = _flagged(runs, F.col("run_id"), "run_id", "_known")
    rows = ledger.select("listing_id", F.explode(said).alias("m")).select("listing_id", "m.*").join(known, "run_id", "left")
    wrong = rows.filter("rule is not null or _known is null")
    return wrong.select(
        F.lit("fail").alias("severity"), F.coalesce("rule", F.lit("ledger_run_unknown")).alias("rule"),
        F.col("listing_id").cast("string").alias("key"),
        F.when(F.col("rule").isNull(), F.concat_ws(":", "place", "run_id")).otherwise(F.lit("")).alias("detail"),
    )


def factor_keys(listings: DataFrame, expected: Sequence[str], factors: str = "factor_keys") -> DataFrame:
    """Rows whose factor names are not exactly the weighted ones."""
    names = F.array(*[F.lit(k) for k in sorted(expected)])
    return violations(
        listings.filter(~F.array_sort(factors).eqNullSafe(names)), "factor_keys_disagree",
        F.concat_ws("/", "run_id", "listing_id"), F.array_join(F.array_sort(factors), ","),
    )


def version_warnings(current: DataFrame, searches: DataFrame, asked: DataFrame, saved_version: int,
                     preferred: DataFrame, suburbs: DataFrame) -> DataFrame:
    """What deserves a look but blocks nothing: another search version, unasked searches, unprofiled favourites."""
    skew = current.filter(F.col("searches_version").isNotNull() & (F.col("searches_version") != saved_version))
    return union_all([
        violations(skew, "searches_version_skew", F.col("run_id"), F.col("searches_version"), "warn"),
        violations(searches.join(asked, "search_id", "left_anti"), "search_not_asked", F.col("search_id"), severity="warn"),
        violations(preferred.join(suburbs, "suburb_key", "left_anti"), "preferred_without_profile", F.col("suburb_key"), severity="warn"),
    ])


def commentary_warnings(runs: DataFrame) -> DataFrame:
    """Runs without a word of commentary. ``runs``: run_id, commentary."""
    silent = F.trim(F.coalesce("commentary", F.lit(""))) == ""
    return violations(runs.filter(silent), "commentary_empty", F.col("run_id"), severity="warn")


# ---- travel --------------------------------------------------------------------------------


def flag_checks(walks: DataFrame) -> DataFrame:
    """The two-signal rule both ways. ``walks``: key, kmh, ferry_available (null: never asked), flagged, threshold_kmh."""
    fast = F.coalesce(F.col("kmh") >= WALK_SUSPECT_KMH, F.lit(False))
    served = F.coalesce("ferry_available", F.lit(False))
    flagged = F.coalesce("flagged", F.lit(False))
    return check_rows(
        walks, F.col("key"),
        {
            "flag_without_both_signals": ~flagged | (fast & served),
            "missed_flag": flagged | ~(fast & served),
            "other_threshold": ~flagged | (F.col("threshold_kmh") == WALK_SUSPECT_KMH),
        },
    )


def empty_band(walks: DataFrame) -> DataFrame:
    """One row when the threshold no longer separates flagged from unflagged speeds."""
    speeds = walks.agg(
        F.coalesce(F.max(F.when(~F.coalesce("flagged", F.lit(False)), F.col("kmh"))), F.lit(0.0)).alias("fastest_unflagged"),
        F.min(F.when(F.col("flagged"), F.col("kmh"))).alias("slowest_flagged"),
    )
    crossed = (F.col("fastest_unflagged") >= WALK_SUSPECT_KMH) | (F.col("slowest_flagged") <= WALK_SUSPECT_KMH)
    return violations(speeds.filter(crossed), "threshold_not_in_empty_band", F.lit("walks"))


def composition_checks(journeys: DataFrame, legs: DataFrame) -> DataFrame:
    """Stored journey facts recomputed from the legs. ``journeys``: journey_id, minutes, walk_metres,
    service_minutes, wait_minutes, walk_speed_kmh, is_walk, has_ferry, ferry_available, interchanges."""
    walk = is_walk(F.col("product_class"))
    facts = legs.groupBy("journey_id").agg(
        F.count_if(~walk).alias("services"),
        F.bool_or(F.col("product_class") == FERRY_CLASS).alias("ferry"),
        F.sum(F.when(walk, F.col("metres")).otherwise(F.lit(0.0))).alias("walked"),
    )
    both = journeys.join(facts, "journey_id")
    expected = retimed_minutes(F.col("walk_metres"), F.col("service_minutes"), F.col("wait_minutes")) if (
        "walk_speed_kmh" not in journeys.columns
    ) else F.col("walk_metres") / 1000.0 / F.col("walk_speed_kmh") * 60.0 + F.col("service_minutes") + F.col("wait_minutes")
    return check_rows(
        both, F.col("journey_id"),
        {
            "is_walk_disagrees": F.col("is_walk") == (F.col("services") == 0),
            "has_ferry_disagrees": F.col("has_ferry") == F.col("ferry"),
            "interchanges_disagree": F.col("interchanges") == F.greatest(F.lit(0), F.col("services") - 1),
            "ferry_not_available": ~F.col("has_ferry") | F.col("ferry_available"),
            "minutes_do_not_add_up": F.abs(expected - F.col("minutes")) <= RECONCILE_MINUTES,
            "walk_metres_disagree": F.abs(F.col("walked") - F.col("walk_metres")) <= WALK_METRES_SLACK,
        },
    )


def leaked_interchanges(listings: DataFrame) -> DataFrame:
    """A measured interchange count must not reach the scored commute."""
    leaked = F.col("enrichment.commute.transit.interchanges").isNotNull()
    return violations(listings.filter(leaked), "interchanges_scored", F.col("listing_id"))
