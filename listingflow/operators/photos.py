"""Photo bookkeeping: what to fetch next, and which stored objects nobody needs any more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import listing_id_of_key

MAX_PHOTOS = 8  # fixed value: photos kept per listing


def planned_photos(urls: Column, known_urls: Column, files: Column, limit: int = MAX_PHOTOS) -> Column:
    """``array<struct<url, file>>``: unseen URLs in order, up to the room left, numbered after the highest file."""
    none = F.array().cast("array<string>")
    known, have = F.coalesce(known_urls, none), F.coalesce(files, none)
    pending = F.filter(F.coalesce(urls, none), lambda u: ~F.array_contains(known, u))
    room = F.greatest(F.lit(0), F.lit(limit) - F.size(have))
    highest = F.coalesce(F.array_max(F.transform(have, lambda f: F.left(f, F.lit(2)).try_cast("int"))), F.lit(0))
    return F.transform(
        F.slice(pending, F.lit(1), room),
        lambda u, i: F.struct(
            u.alias("url"),
            F.concat(F.lpad((highest + 1 + i).cast("string"), 2, "0"), F.lit(".webp")).alias("file"),
        ),
    )


def photo_plan(listings: DataFrame, limit: int = MAX_PHOTOS) -> DataFrame:
    """One row per photo to fetch. Arrays stay in their row: no shuffle.

    ``listings``: listing_id, image_urls (this capture), known_urls and files (the ledger).
    """
    plan = planned_photos(F.col("image_urls"), F.col("known_urls"), F.col("files"), limit)
    return listings.select("listing_id", F.explode(plan).alias("p")).select("listing_id", "p.url", "p.file")


def doomed_listings(run_listings: DataFrame, removed_runs: DataFrame) -> DataFrame:
    """Listings of removed runs that no remaining run holds."""
    removed = run_listings.join(removed_runs.select("run_id"), "run_id", "left_semi")
    kept = run_listings.join(removed_runs.select("run_id"), "run_id", "left_anti")
    return removed.select("listing_id").distinct().join(kept.select("listing_id").distinct(), "listing_id", "left_anti")


def orphan_media(keys: DataFrame, doomed: DataFrame) -> DataFrame:
    """Object keys that belong to doomed listings; look-alike keys belong to nobody."""
    owned = keys.withColumn("listing_id", listing_id_of_key(F.col("key"))).filter("listing_id is not null")
    return owned.join(doomed.select("listing_id"), "listing_id", "left_semi").select("key", "listing_id")


def cleared_photos(ledger: DataFrame, doomed: DataFrame) -> DataFrame:
    """The ledger with the photo record of doomed listings emptied."""
    none = F.array().cast("array<string>")
    marked = ledger.join(doomed.select("listing_id", F.lit(True).alias("_doomed")), "listing_id", "left")
    gone = F.col("_doomed").isNotNull()
    return marked.withColumns(
        {name: F.when(gone, none).otherwise(F.col(name)) for name in ("image_urls", "image_files")}
    ).drop("_doomed")


def current_run_after(manifest: DataFrame, removed_runs: DataFrame, current: str) -> DataFrame:
    """The run to show once some are removed: the current one if it stays, else the last survivor."""
    left = manifest.join(removed_runs.select("run_id"), "run_id", "left_anti")
    rank = F.struct(F.when(F.col("run_id") == current, F.lit(1)).otherwise(F.lit(0)), "position")
    return left.agg(F.max_by("run_id", rank).alias("current_run"))
