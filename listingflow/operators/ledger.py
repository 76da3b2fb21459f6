"""The cumulative ledger: one row per listing, histories append-only.

A run folds in by one full outer join on ``listing_id`` (unique on both sides, so no key is hot).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.signals import LEASED

# ---- Fixed values: statuses that mean the listing left the market, wording of a note -------
GONE_STATUSES = ["leased", "withdrawn", "stale"]
PARTIAL_NOTE = (
    "Partial search: %d of %d configured locations were queried (%s). Listings from the remaining %d"
    " are absent because they were never searched, not because none exist — so no listing was marked stale this run."
)
# -------------------------------------------------------------------------------------------
FACTS = ["beds", "baths", "car_spaces", "area_sqm"]


def fold_run(ledger: DataFrame, listings: DataFrame, returned: DataFrame, verdicts: DataFrame, run_id: str,
             previous_run: str | None, allow_stale: bool, gone_statuses: Sequence[str] = GONE_STATUSES) -> DataFrame:
    """The ledger after a run, with what the run decided beside each row.

    ``listings``: this run's usable rows. ``returned``: every id the capture returned; a listing
    that was returned but not usable is not absent. ``verdicts``: ``listing_id, verdict`` of checked
    absences. Extra columns: ``state`` (this run's sightings), ``prev_pw`` and ``delta_pw`` (a price
    move between two known prices), ``absent_status`` (what absence turned the row into).
    """
    keep = [c for c in ledger.columns if c != "listing_id"]
    old = ledger.select("listing_id", F.struct(*keep).alias("old"))
    new = listings.select(
        "listing_id",
        F.struct("url", "address", "suburb", "postcode", "lat", "lon", "price_pw", F.struct(*FACTS).alias("facts"))
        .alias("new"),
    )
    back = returned.select("listing_id").distinct().withColumn("returned", F.lit(True))
    joined = (
        old.join(new, "listing_id", "full_outer")
        .join(back, "listing_id", "left")
        .join(verdicts.select("listing_id", "verdict"), "listing_id", "left")
    )
    o, n = F.col("old"), F.col("new")
    seen, known = n.isNotNull(), o.isNotNull()
    last_price = F.try_element_at(o["price_history"], F.lit(-1))["price_pw"]
    moved = ~last_price.eqNullSafe(n["price_pw"])
    was_absent = o["status"] != "active"
    was_gone = o["status"].isin(*gone_statuses)
    priced_move = moved & last_price.isNotNull() & n["price_pw"].isNotNull()

    absent = known & ~seen & F.col("returned").isNull() & (o["status"] == "active")
    missed_two = F.lit(bool(allow_stale and previous_run is not None)) & (
        o["last_seen_run"] != F.lit(previous_run or "")
    )
    fate = F.when(absent, F.coalesce("verdict", F.when(missed_two, F.lit("stale"))))

    run = F.lit(run_id)
    status_point = F.struct(run.alias("run"), F.coalesce(fate, F.lit("active")).alias("status"))
    price_point = F.struct(run.alias("run"), n["price_pw"].alias("price_pw"))

    def latest(name: str) -> Column:
        return F.when(seen, n[name]).otherwise(o[name]).alias(name)

    columns = {
        "lat": F.coalesce(n["lat"], o["lat"]),
        "lon": F.coalesce(n["lon"], o["lon"]),
        "first_seen_run": F.coalesce(o["first_seen_run"], run),
        "last_seen_run": F.when(seen, run).otherwise(o["last_seen_run"]),
        "status": F.when(seen, F.lit("active")).otherwise(F.coalesce(fate, o["status"])),
        "status_history": F.when(~known, F.array(status_point))
        .when((seen & was_absent) | fate.isNotNull(), F.concat(o["status_history"], F.array(status_point)))
        .otherwise(o["status_history"]),
        "price_history": F.when(~known, F.array(price_point))
        .when(seen & moved, F.concat(o["price_history"], F.array(price_point)))
        .otherwise(o["price_history"]),
        "relist_count": F.when(~known, F.lit(0))
        .when(seen & was_gone, o["relist_count"] + 1)
        .otherwise(o["relist_count"]),
        "facts_last": F.when(seen, n["facts"]).otherwise(o["facts_last"]),
    }
    # Whatever else the ledger carries (photos, cached travel, walkability) passes through untouched.
    fixed = {"url", "address", "suburb", "postcode", *columns}
    carried = [o[c].alias(c) for c in keep if c not in fixed]
    state = (
        F.when(~seen, F.lit(None).cast("string"))
        .when(~known, F.lit("new"))
        .when(was_gone, F.lit("relisted"))
        .when(priced_move, F.lit("price_drop"))
        .otherwise(F.lit("carried_over"))
    )
    both = known & seen & priced_move
    return joined.select(
        "listing_id",
        *[latest(name) for name in ("url", "address", "suburb", "postcode")],
        *[value.alias(name) for name, value in columns.items()],
        *carried,
        state.alias("state"),
        F.when(both, last_price).alias("prev_pw"),
        F.when(both, n["price_pw"] - last_price).alias("delta_pw"),
        fate.alias("absent_status"),
        absent.alias("absent"),
    )


FOLD_COLUMNS = ["state", "prev_pw", "delta_pw", "absent_status", "absent"]


def absent_listings(ledger: DataFrame, returned: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Active listings the capture did not return and nobody has checked yet."""
    return (
        ledger.filter("status = 'active'")
        .join(returned.select("listing_id").distinct(), "listing_id", "left_anti")
        .join(verdicts.select("listing_id"), "listing_id", "left_anti")
    )


def absence_verdicts(pages: DataFrame) -> DataFrame:
    """Verdict per fetched detail page: leased wording, else still live; a failed fetch says nothing."""
    text = F.coalesce("price", F.lit(""))
    return pages.select(
        "listing_id",
        F.when(
            F.col("fetched"), F.when(text.rlike("(?i)" + LEASED), F.lit("leased")).otherwise(F.lit("unmatched"))
        ).alias("verdict"),
        F.when(F.col("fetched"), F.coalesce(F.nullif("price", F.lit("")), F.lit("page live"))).alias("evidence"),
    )


def partial_search(searched: DataFrame, envelope: DataFrame) -> DataFrame:
    """One row: ``searched``, ``configured`` and ``partial``. A partial search may not mark anything stale."""
    done = searched.agg(F.count("*")).scalar()
    return envelope.agg(F.count("*").alias("configured")).select(
        done.alias("searched"), "configured", ((done > 0) & (done < F.col("configured"))).alias("partial")
    )


def partial_note(searched: Column, configured: Column, names: Column) -> Column:
    told = F.format_string(PARTIAL_NOTE, searched, configured, names, configured - searched)
    return F.when(searched.isNotNull() & configured.isNotNull() & names.isNotNull(), told)


def sighting_history(sightings: DataFrame, runs: DataFrame) -> DataFrame:
    """Every run at once, from raw sightings: what folding them one run at a time would decide.

    ``sightings``: ``listing_id, run_id, price_pw`` with any number of rows per listing and run, the
    lowest price standing for the run. ``runs``: ``run_id, run_pos`` in append order. Rows are reduced
    to one per listing and run before the window, so a window holds at most as many rows as there are
    runs. A listing missing from two consecutive runs went stale, so its return is a relist.
    """
    from pyspark.sql import Window

    per_run = sightings.groupBy("listing_id", "run_id").agg(F.min("price_pw").alias("price_pw"))
    placed = per_run.join(runs.select("run_id", "run_pos"), "run_id")
    by_listing = Window.partitionBy("listing_id").orderBy("run_pos")
    before = by_listing.rowsBetween(Window.unboundedPreceding, 0)
    stepped = placed.select(
        "listing_id", "run_id", "run_pos", "price_pw",
        F.lag("run_pos").over(by_listing).alias("prev_pos"),
        F.lag("price_pw").over(by_listing).alias("prev_price"),
        F.first("run_id").over(before).alias("first_seen_run"),
    )
    first = F.col("prev_pos").isNull()
    missed = F.col("run_pos") - F.col("prev_pos") - 1
    relisted = ~first & (missed >= 2)
    moved = ~first & F.col("prev_price").isNotNull() & F.col("price_pw").isNotNull() & (
        F.col("prev_price") != F.col("price_pw")
    )
    flagged = stepped.withColumn("relisted", F.coalesce(relisted, F.lit(False)))
    return flagged.select(
        "listing_id", "run_id", "run_pos", "first_seen_run", "price_pw",
        F.when(first, F.lit("new")).when(F.col("relisted"), F.lit("relisted")).when(moved, F.lit("price_drop"))
        .otherwise(F.lit("carried_over")).alias("state"),
        F.when(moved, F.col("prev_price")).alias("prev_pw"),
        F.when(moved, F.col("price_pw") - F.col("prev_price")).alias("delta_pw"),
        F.coalesce(missed, F.lit(0)).alias("missed_runs"),
        F.sum(F.col("relisted").cast("int")).over(before).cast("int").alias("relist_count"),
    )
