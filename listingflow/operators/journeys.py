"""Door-to-door journeys from their legs.

Legs come either as rows (``journey_id``, an order column and a coarser ``block`` that never
decreases with it) or as an array inside the journey's row. The row form never needs a whole journey
in one task: waits are carried from block to block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round_half_up

# ---- Fixed values: product classes and walking speed ---------------------------------------
CLASS_LABELS = {
    1: "train", 2: "metro", 4: "light rail", 5: "bus", 7: "coach", 9: "ferry",
    11: "school bus", 99: "walk", 100: "walk", 107: "cycle",
}
WALK_CLASSES = [99, 100]
FERRY_CLASS = 9
WALK_SPEED_KMH = 4.324
WALK_SUSPECT_KMH = 4.85
RECONCILE_MINUTES = 0.15
WALK_METRES_SLACK = 1
# -------------------------------------------------------------------------------------------


def is_walk(product_class: Column) -> Column:
    return product_class.isin(*WALK_CLASSES)


def leg_label(product_class: Column, service: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in CLASS_LABELS.items() for x in pair])
    name = F.coalesce(
        F.try_element_at(labels, product_class), F.concat(F.lit("class "), product_class.cast("string"))
    )
    return F.when(service.isNotNull() & (service != ""), F.concat(service, F.lit(" "), name)).otherwise(name)


def describe(legs: Column) -> Column:
    """``walk · F4 ferry · walk`` from an array of legs."""
    return F.array_join(F.transform(legs, lambda leg: leg_label(leg["product_class"], leg["service"])), " · ")


def leg_metres(product_class: Column, distance: Column, path: Column) -> Column:
    """A footpath's own length beats its drawn path; a service has only the path."""
    return F.when(is_walk(product_class), F.coalesce(distance, path)).otherwise(path)


def carry_last(rows: DataFrame, key: str, block: str, order: list[str], value: str, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` strictly before the row within ``key``.

    Two levels, so that a key holding a third of all rows is spread over its blocks: a window inside
    each (key, block), and one over the block summaries.
    """
    inside = Window.partitionBy(key, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    per_block = rows.groupBy(key, block).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_last")
    )
    carried = per_block.select(key, block, F.last("_last", ignorenulls=True).over(across).alias("_carried"))
    return (
        rows.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
        .join(carried, [key, block])
        .withColumn(name, F.coalesce("_inside", "_carried"))
        .drop("_inside", "_carried")
    )


def with_waits(legs: DataFrame, order: list[str], block: str = "block", key: str = "journey_id") -> DataFrame:
    """Add ``wait_seconds``: from the last known arrival (walks included) to a service's departure, never negative."""
    carried = carry_last(legs, key, block, order, "arrival", "_arrived")
    gap = F.when(
        ~is_walk(F.col("product_class")), F.greatest(F.lit(0), F.col("departure") - F.col("_arrived"))
    )
    return carried.withColumn("wait_seconds", F.coalesce(gap, F.lit(0))).drop("_arrived")


def journey_totals(legs: DataFrame, order: list[str], block: str = "block", key: str = "journey_id",
                   carry: list[str] | None = None) -> DataFrame:
    """One row per journey. ``legs``: product_class, seconds, metres, departure, arrival (epoch seconds).

    A journey with a leg of unknown class or duration is dropped whole. All aggregates combine on
    the map side.
    """
    walk = is_walk(F.col("product_class"))
    service = ~walk
    timed = with_waits(legs, order, block, key)
    position = F.struct(*order)
    total = timed.groupBy(*(carry or []), key).agg(
        F.bool_and(F.col("product_class").isNotNull() & F.col("seconds").isNotNull()).alias("valid"),
        F.count("*").alias("legs"),
        F.sum(F.when(walk, F.col("metres")).otherwise(F.lit(0.0))).alias("walk_m"),
        F.sum(F.when(service, F.col("seconds")).otherwise(F.lit(0))).alias("service_s"),
        F.sum("wait_seconds").alias("wait_s"),
        F.sum("metres").alias("metres"),
        F.count_if(service).alias("services"),
        F.coalesce(F.bool_or(F.col("product_class") == FERRY_CLASS), F.lit(False)).alias("has_ferry"),
        F.min_by("departure", position).alias("first_departure"),
        F.max_by("arrival", position).alias("last_arrival"),
    )
    span = (F.col("last_arrival") - F.col("first_departure")) / F.lit(60.0)
    return total.filter("valid").select(
        *(carry or []),
        key,
        "legs",
        round_half_up(F.col("walk_m")).alias("walk_metres"),
        round_half_up(F.col("service_s") / F.lit(60.0), 1).alias("service_minutes"),
        round_half_up(F.col("wait_s") / F.lit(60.0), 1).alias("wait_minutes"),
        F.coalesce(round_half_up(span, 1), F.lit(0.0)).alias("provider_minutes"),
        (F.col("services") == 0).alias("is_walk"),
        "has_ferry",
        F.greatest(F.lit(0), F.col("services") - 1).alias("interchanges"),
        round_half_up(F.col("metres")).alias("metres"),
    )


def retimed_minutes(walk_metres: Column, service: Column, wait: Column, speed_kmh: float = WALK_SPEED_KMH) -> Column:
    """Door to door with the walking at ``speed_kmh``; timetabled and waiting minutes stand."""
    return walk_metres / F.lit(1000.0) / F.lit(float(speed_kmh)) * F.lit(60.0) + service + wait


def fastest_journeys(journeys: DataFrame, pair: list[str], position: str, speed_kmh: float = WALK_SPEED_KMH) -> DataFrame:
    """Per pair the quickest journey by our own clock; the earlier offer wins a tie."""
    minutes = retimed_minutes(F.col("walk_metres"), F.col("service_minutes"), F.col("wait_minutes"), speed_kmh)
    rest = [c for c in journeys.columns if c not in pair]
    timed = journeys.withColumn("minutes", minutes)
    return timed.groupBy(*pair).agg(
        F.min_by(F.struct(*rest, "minutes"), F.struct("minutes", position)).alias("best")
    ).select(*pair, "best.*")


def ferry_pairs(journeys: DataFrame, pair: list[str]) -> DataFrame:
    """Whether a ferry serves the pair in any journey offered, not just the quickest."""
    return journeys.groupBy(*pair).agg(F.bool_or("has_ferry").alias("ferry_available"))


def composition(journey: Column, legs: Column, source: str) -> Column:
    """A journey as a ledger stores it; null when ferry availability or walking speed is unknown."""
    known = journey["ferry_available"].isNotNull() & journey["walk_speed_kmh"].isNotNull()
    return F.when(
        known,
        F.struct(
            F.lit(source).alias("source"),
            journey["ferry_available"].alias("ferry_available"),
            F.transform(legs, lambda leg: leg.withField("minutes", round_half_up(leg["minutes"], 1))).alias("legs"),
            round_half_up(journey["walk_metres"]).alias("walk_metres"),
            round_half_up(journey["service_minutes"], 1).alias("service_minutes"),
            round_half_up(journey["wait_minutes"], 1).alias("wait_minutes"),
            journey["walk_speed_kmh"].alias("walk_speed_kmh"),
            journey["is_walk"].alias("is_walk"),
            journey["has_ferry"].alias("has_ferry"),
            journey["interchanges"].alias("interchanges"),
            round_half_up(journey["provider_minutes"], 1).alias("provider_minutes"),
        ),
    )


def array_totals(legs: Column) -> Column:
    """The totals of a journey whose legs sit in its own row; null when a leg lacks class or duration."""
    def walked(leg: Column) -> Column:
        return is_walk(leg["product_class"])

    def total(value, zero) -> Column:
        return F.aggregate(legs, zero, lambda acc, leg: acc + value(leg))

    services = F.filter(legs, lambda leg: ~walked(leg))
    bad = F.exists(legs, lambda leg: leg["product_class"].isNull() | leg["minutes"].isNull())
    return F.when(
        (F.size(legs) > 0) & ~bad,
        F.struct(
            round_half_up(
                total(lambda leg: F.when(walked(leg), leg["metres"]).otherwise(F.lit(0.0)), F.lit(0.0))
            ).alias("walk_metres"),
            round_half_up(
                total(lambda leg: F.when(walked(leg), F.lit(0.0)).otherwise(leg["minutes"]), F.lit(0.0)), 1
            ).alias("service_minutes"),
            (F.size(services) == 0).alias("is_walk"),
            F.exists(services, lambda leg: leg["product_class"] == FERRY_CLASS).alias("has_ferry"),
            F.greatest(F.lit(0), F.size(services) - 1).alias("interchanges"),
        ),
    )
