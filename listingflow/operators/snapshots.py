"""Comparing a rebuilt run with the published one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---- Fixed values: what a rebuild may move, and what it may not ------------------------------
DERIVED_FIELDS = [
    "url", "address", "suburb", "postcode", "state", "lat", "lon", "price_pw", "price_display",
    "beds", "baths", "car_spaces", "area_sqm", "area_source", "property_type", "available_date",
    "bond", "features", "description_snippet", "travel", "matched_searches", "enrichment",
    "scores", "flags", "share_signals", "studio_signals",
]
HISTORY_FIELDS = ["listing_state", "first_seen_run", "price_change", "images", "agent_notes"]
SAMPLE_IDS = 4
# -------------------------------------------------------------------------------------------


def _comparable(df: DataFrame, name: str):
    """Maps cannot be compared; their sorted entries can."""
    from pyspark.sql.types import MapType

    column = F.col(name)
    return F.array_sort(F.map_entries(column)) if isinstance(df.schema[name].dataType, MapType) else column


def changed_fields(before: DataFrame, after: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``listing_id, field`` for every field that differs, nulls compared as values. One equi-join."""
    b = before.select("listing_id", *[_comparable(before, f).alias(f"b_{f}") for f in fields])
    a = after.select("listing_id", *[_comparable(after, f).alias(f"a_{f}") for f in fields])
    moved = [F.when(~F.col(f"b_{f}").eqNullSafe(F.col(f"a_{f}")), F.lit(f)) for f in fields]
    return b.join(a, "listing_id").select("listing_id", F.explode(F.array_compact(F.array(*moved))).alias("field"))


def change_report(before: DataFrame, after: DataFrame, fields: Sequence[str], sample: int = SAMPLE_IDS) -> DataFrame:
    """Per field: how many listings changed and the first ids. Ids are limited on the map side."""
    changes = changed_fields(before, after, fields)
    counts = changes.groupBy("field").agg(F.count("*").alias("listings"))
    order = Window.partitionBy("field").orderBy("listing_id")
    firsts = changes.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample)
    samples = firsts.groupBy("field").agg(F.array_join(F.array_sort(F.collect_list("listing_id")), ", ").alias("sample"))
    return counts.join(samples, "field")


def left_run(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.select("listing_id").join(after.select("listing_id"), "listing_id", "left_anti")


def appeared(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows a rebuild may not have: the run holds no history for them."""
    return after.select("listing_id").join(before.select("listing_id"), "listing_id", "left_anti")


def guard_violations(before: DataFrame, after: DataFrame, history: Sequence[str]) -> DataFrame:
    """``rule, listing_id, detail``: moved history fields and rows that appeared. Empty on a sound rebuild."""
    moved = changed_fields(before, after, history).select(
        F.lit("history_changed").alias("rule"), "listing_id", F.col("field").alias("detail")
    )
    new = appeared(before, after).select(F.lit("appeared").alias("rule"), "listing_id", F.lit("").alias("detail"))
    return moved.unionByName(new)


def drift(after: DataFrame, ledger: DataFrame) -> DataFrame:
    """Facts of the rebuilt run that disagree with what the ledger last recorded."""
    a, entry = after.alias("a"), ledger.alias("l")
    last_price = F.try_element_at(F.col("l.price_history"), F.lit(-1))["price_pw"]
    pairs = {
        "price": (last_price, F.col("a.price_pw")),
        "beds": (F.col("l.facts_last.beds"), F.col("a.beds")),
        "baths": (F.col("l.facts_last.baths"), F.col("a.baths")),
    }
    found = [
        F.when(
            ~old.eqNullSafe(new),
            F.struct(F.lit(name).alias("fact"), old.cast("int").alias("recorded"), new.cast("int").alias("rebuilt")),
        )
        for name, (old, new) in pairs.items()
    ]
    return a.join(entry, "listing_id").select(
        "listing_id", F.explode(F.array_compact(F.array(*found))).alias("d")
    ).select("listing_id", "d.fact", "d.recorded", "d.rebuilt")


def state_counts(listings: DataFrame) -> DataFrame:
    """One row of counts by state."""

    def of(state: str):
        return F.count_if(F.col("listing_state") == state)

    return listings.agg(
        F.count("*").alias("total"), of("new").alias("new"), of("carried_over").alias("carried_over"),
        of("price_drop").alias("price_drops"), of("relisted").alias("relisted"),
    )


def run_summary(listings: DataFrame, gone: DataFrame) -> DataFrame:
    """One row of counts by state; ``gone``: listings that left the market since the last run."""
    return state_counts(listings).withColumn("leased_since_last_run", gone.agg(F.count("*")).scalar())
