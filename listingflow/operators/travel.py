"""Travel evidence: which measurement to believe, and which walks are not walks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import implied_speed_kmh
from ..functions.numbers import round_half_up
from .journeys import WALK_SUSPECT_KMH

# ---- Fixed values: provider precision labels -----------------------------------------------
PROVIDER_PRECISION = {
    "ROOFTOP": "building",
    "RANGE_INTERPOLATED": "street",
    "GEOMETRIC_CENTER": "street",
    "APPROXIMATE": "area",
}
# -------------------------------------------------------------------------------------------
EVIDENCE = ["composition", "mislabelled"]


def provider_precision(label: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for pair in PROVIDER_PRECISION.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, label), F.lit("area"))


def merge_travel(cached: DataFrame, captured: DataFrame, facts: list[str] = ("minutes", "km", "mode", "precision"),
                 evidence: list[str] = tuple(EVIDENCE)) -> DataFrame:
    """Long form merge on (listing_id, travel_key): the capture wins unless the cache carries evidence it lacks."""
    keys = ["listing_id", "travel_key"]
    fields = [*facts, *evidence]
    old = cached.select(*keys, F.struct(*fields).alias("old"))
    new = captured.select(*keys, F.struct(*fields).alias("new"))
    chosen = better_evidence(F.col("old"), F.col("new"), list(evidence))
    return old.join(new, keys, "full_outer").select(*keys, chosen.alias("leg")).select(*keys, "leg.*")


def better_evidence(old: Column, new: Column, evidence: list[str] = tuple(EVIDENCE)) -> Column:
    knows_more = F.lit(False)
    for name in evidence:
        knows_more = knows_more | (old[name].isNotNull() & new[name].isNull())
    return F.when(new.isNull() | (old.isNotNull() & knows_more), old).otherwise(new)


def merge_travel_maps(cached: Column, captured: Column, evidence: list[str] = tuple(EVIDENCE)) -> Column:
    """The same merge when both sides are maps in one row: no shuffle."""
    return F.map_zip_with(cached, captured, lambda key, old, new: better_evidence(old, new, list(evidence)))


def plain_travel(cached: Column) -> Column:
    """Cached entries as a run publishes them: bookkeeping (``computed_at``, ``address``) left behind."""
    return F.transform_values(
        cached,
        lambda key, leg: F.struct(
            *[leg[name].alias(name) for name in ("minutes", "km", "mode", "precision", *EVIDENCE)]
        ),
    )


def suspect_walks(walks: DataFrame) -> DataFrame:
    """Walks too fast to be walks, with the speed that gives them away. Reads minutes and km only."""
    speed = implied_speed_kmh(F.col("km"), F.col("minutes"))
    return walks.withColumn("implied_kmh", speed).filter(F.col("implied_kmh") >= WALK_SUSPECT_KMH)


def mislabelled_walks(walks: DataFrame, ferries: DataFrame, pair: list[str]) -> DataFrame:
    """Suspects that a ferry serves. The speed test runs first: few rows reach the join; an unknown pair is no finding."""
    confirmed = ferries.filter("ferry_available").select(*pair)
    return suspect_walks(walks).join(confirmed, pair, "left_semi").select(
        *walks.columns,
        F.lit("ferry").alias("actually"),
        round_half_up(F.col("implied_kmh"), 2).alias("implied_kmh"),
        F.lit(WALK_SUSPECT_KMH).alias("threshold_kmh"),
        F.lit(True).alias("ferry_available"),
    )


def ledger_mislabelled(evidence: DataFrame, column: str = "mislabelled") -> Column:
    """A router's finding in the ledger's spelling; a finding already spelled that way stays as it is."""
    spelled = {"implied_kmh": "impliedKmh", "threshold_kmh": "thresholdKmh", "ferry_available": "ferryAvailable"}
    present = set(evidence.schema[column].dataType.names)
    found = F.col(column)

    def either(name: str) -> Column:
        return F.coalesce(*[found[n] for n in (name, spelled[name]) if n in present]).alias(name)

    return F.when(found.isNotNull(), F.struct(found["actually"].alias("actually"), *[either(n) for n in spelled]))


def precision_seen(legs: DataFrame) -> DataFrame:
    """First precision recorded for a listing, in run order then key order: ``listing_id, precision``."""
    return legs.groupBy("listing_id").agg(F.min_by("precision", F.struct("run_pos", "key_pos")).alias("precision"))


def stale_routes(ledger: DataFrame, force: bool = False) -> DataFrame:
    """Located listings whose route is missing or was measured from another address."""
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    outdated = F.col("cached").isNull() | (F.col("cached.address") != F.col("address")) | F.lit(force)
    return ledger.filter(located & outdated)


def unmeasured_journeys(ledger: DataFrame, limit: int | None = None, force: bool = False) -> DataFrame:
    """Located listings without a measured journey; a limit takes the first ids."""
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    todo = ledger.filter(located & (F.col("composition").isNull() | F.lit(force)))
    return todo if limit is None else todo.orderBy("listing_id").limit(limit)


def cache_is_fresh(cached: Column, config_hash: Column, lat: Column, lon: Column, degrees: float = 0.0005) -> Column:
    """A cached walkability block still answers: same configuration, position moved by no more than ``degrees``."""
    near = (F.abs(cached["lat"] - lat) <= degrees) & (F.abs(cached["lon"] - lon) <= degrees)
    return F.coalesce((cached["config_hash"] == config_hash) & near, F.lit(False))


def stale_walkability(ledger: DataFrame, config_hash: str) -> DataFrame:
    """Located ledger rows whose cached walkability no longer answers."""
    fresh = cache_is_fresh(F.col("walkability"), F.lit(config_hash), F.col("lat"), F.col("lon"))
    return ledger.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~fresh)


def arrive_by_mismatches(groups: DataFrame, resolved: str) -> DataFrame:
    """Transit passes measured against another moment, or against none."""
    return groups.filter((F.col("mode") == "transit") & ~F.col("arrive_by").eqNullSafe(F.lit(resolved))).select(
        "origin", "arrive_by"
    )
