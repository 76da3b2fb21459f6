"""Listings a pass rejected on travel time, remembered so they are not measured again.

The rule is an ordered fold per listing: the last sighting wins, an edited address throws away the
routed times, each pass overwrites its own. Folding would need all rows of a listing in one place.
It is computed instead from three combinable maxima per (listing, address, pass): what survives are
the last times measured after the last sighting under another address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_rejected(previous: DataFrame, rejections: DataFrame, tracked: DataFrame, run_id: str,
                  computed_at: str) -> DataFrame:
    """``listing_id, url, address, lat, lon, travel map, last_seen_run`` after this capture.

    ``previous``: the same columns. ``rejections``: rows in capture order (``group_pos, row_pos,
    travel_key, travel``). ``tracked``: ids the ledger holds; those are never rejections.
    """
    position = F.struct("group_pos", "row_pos")
    linked = rejections.filter(F.coalesce("url", F.lit("")) != "").withColumn("pos", position)

    # (listing, address): where it was last seen, and what was said there.
    seen = linked.groupBy("listing_id", "address").agg(
        F.max("pos").alias("pos"), F.max_by(F.struct("url", "lat", "lon"), "pos").alias("facts")
    )
    final = seen.groupBy("listing_id").agg(
        F.max_by(F.struct("address", "facts"), "pos").alias("final"), F.count("*").alias("addresses")
    )
    other = (
        seen.alias("s").join(final.alias("f"), "listing_id")
        .filter(F.col("s.address") != F.col("f.final.address"))
        .groupBy("listing_id").agg(F.max("s.pos").alias("broken_at"))
    )
    outcome = final.join(other, "listing_id", "left").select(
        "listing_id", F.col("final.address").alias("address"), F.col("final.facts.url").alias("url"),
        F.col("final.facts.lat").alias("lat"), F.col("final.facts.lon").alias("lon"), "broken_at",
    )
    timed = linked.filter("travel is not null").groupBy("listing_id", "address", "travel_key").agg(
        F.max_by("travel", "pos").alias("travel"), F.max("pos").alias("pos")
    )
    fresh = (
        timed.join(outcome.select("listing_id", "address", "broken_at"), ["listing_id", "address"])
        .filter(F.col("broken_at").isNull() | (F.col("pos") > F.col("broken_at")))
        .groupBy("listing_id")
        # One entry per pass: bounded by the number of passes.
        .agg(
            F.collect_list(
                F.struct(
                    "travel_key",
                    F.struct(
                        "travel.minutes", "travel.km", "travel.mode", "travel.precision",
                        F.lit(computed_at).alias("computed_at"), F.col("address"),
                    ).alias("leg"),
                )
            ).alias("legs")
        )
    )
    leg_type = "minutes:double,km:double,mode:string,precision:string,computed_at:string,address:string"
    no_legs = F.array().cast(f"array<struct<travel_key:string,leg:struct<{leg_type}>>>")
    now = outcome.join(fresh, "listing_id", "left").withColumn("legs", F.coalesce("legs", no_legs))

    p, n = previous.alias("p"), now.alias("n")
    both = p.join(n, "listing_id", "full_outer")
    unbroken = F.col("n.broken_at").isNull() & (F.col("p.address") == F.col("n.address"))
    old = F.transform(
        F.coalesce(F.map_entries("p.travel"), F.array().cast(f"array<struct<key:string,value:struct<{leg_type}>>>")),
        lambda e: F.struct(e["key"].alias("travel_key"), e["value"].alias("leg")),
    )
    new_keys = F.transform("n.legs", lambda e: e["travel_key"])
    surviving = F.when(unbroken, F.filter(old, lambda e: ~F.array_contains(new_keys, e["travel_key"]))).otherwise(no_legs)
    seen_now = F.col("n.address").isNotNull()
    merged = both.select(
        "listing_id",
        F.coalesce("n.url", "p.url").alias("url"),
        F.coalesce("n.address", "p.address").alias("address"),
        F.when(seen_now, F.col("n.lat")).otherwise(F.col("p.lat")).alias("lat"),
        F.when(seen_now, F.col("n.lon")).otherwise(F.col("p.lon")).alias("lon"),
        F.when(seen_now, F.map_from_entries(F.array_sort(F.concat(surviving, "n.legs"))))
        .otherwise(F.col("p.travel")).alias("travel"),
        F.when(seen_now, F.lit(run_id)).otherwise(F.col("p.last_seen_run")).alias("last_seen_run"),
    )
    return merged.join(tracked.select("listing_id"), "listing_id", "left_anti")
