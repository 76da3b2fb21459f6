"""Nearest point of interest of each kind within a radius, and the walkability block built on it.

Exact, without comparing all pairs of a neighbourhood:

1. Both sides shrink to distinct positions, written once: copies at one address cost nothing extra, and no
   level reads a source again.
2. Cells are paired before points. A coarse grid lists the cell pairs the radius can reach (one
   equi-join); finer grids split the surviving pairs. A pair is dropped when even its closest corner
   is farther than the farthest corner of some other pair of the same listing cell. The bounds use
   the same great-circle formula on coordinate gaps, which only grow the distance, so nothing that
   could win is dropped.
3. Points meet only inside surviving pairs; the minimum combines on the map side.

Positions near the 180th meridian also stand on its other side, and near a pole on all sides, so the
grid finds what the great circle finds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import POI_KINDS, Walking
from ..functions.geo import EARTH_RADIUS_M, haversine_m, walk_minutes
from ..functions.numbers import whole
from ..functions.skew import scatter_slot
from ..session import cut_lineage

SOURCE = "overpass+detour"  # fixed value: names the method in published rows
CELL_DEGREES = 0.05  # fixed value: request grid
METRES_PER_DEGREE = 111_000  # fixed value: request margin

# Cells per radius at each level: coarse for the first join, finer for the pruning that follows.
LEVELS = (2, 8)
CROWDED = 256  # distinct POI positions of one kind in one finest cell
_SLACK_M = 1e-6  # metres of room for floating-point noise in the bounds
_POLAR = 89.9  # beyond this latitude a radius may reach every longitude


def _row_height(radius_m: float, level: int) -> float:
    """Degrees of latitude per cell; whole multiples between levels keep the grids nested."""
    return radius_m / (EARTH_RADIUS_M * 3.141592653589793 / 180.0) / level


def _cell(lat: Column, lon: Column, height: float) -> list[Column]:
    return [F.floor(lat / height).cast("bigint").alias("cy"), F.floor(lon / height).cast("bigint").alias("cx")]


def _gap_bounds(height: float) -> dict[str, Column]:
    """Least and greatest coordinate gaps of two cells, and the cosine range of their latitudes."""
    dy, dx = F.abs(F.col("ay") - F.col("by")), F.abs(F.col("ax") - F.col("bx"))
    one, zero = F.lit(1), F.lit(0)
    top = F.greatest(F.abs(F.col("ay")), F.abs(F.col("ay") + 1), F.abs(F.col("by")), F.abs(F.col("by") + 1))

    def least_lat(y: Column) -> Column:
        return F.when((y <= 0) & (y + 1 >= 0), zero).otherwise(F.least(F.abs(y), F.abs(y + 1)))

    low = F.least(least_lat(F.col("ay")), least_lat(F.col("by")))
    return {
        "near_lat": F.greatest(dy - one, zero) * height, "far_lat": (dy + one) * height,
        "near_lon": F.greatest(dx - one, zero) * height, "far_lon": (dx + one) * height,
        "cos_low": F.cos(F.radians(F.least(top * height, F.lit(90.0)))), "cos_high": F.cos(F.radians(low * height)),
    }


def _arc(lat_gap: Column, lon_gap: Column, cosine: Column) -> Column:
    a, b = F.sin(F.radians(lat_gap) / 2), F.sin(F.radians(F.least(lon_gap, F.lit(180.0))) / 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a * a + cosine * cosine * b * b)))


def _prune(pairs: DataFrame, height: float, radius_m: float, group: list[str]) -> DataFrame:
    """Keep cell pairs that may hold the nearest point of some position in cell (ay, ax)."""
    g = _gap_bounds(height)
    bounded = pairs.withColumn("near", _arc(g["near_lat"], g["near_lon"], g["cos_low"]) - _SLACK_M).withColumn(
        "far", _arc(g["far_lat"], g["far_lon"], g["cos_high"]) + _SLACK_M
    )
    # One listing cell and kind: at most the pairs the radius reaches, never a count of points.
    nearest_far = F.min("far").over(Window.partitionBy("ay", "ax", *group))
    return (
        bounded.filter(F.col("near") <= radius_m)
        .withColumn("limit", nearest_far)
        .filter(F.col("near") <= F.col("limit"))
        .drop("near", "far", "limit")
    )


def levels_for(positions: DataFrame, radius_m: float, group: list[str]) -> tuple[int, ...]:
    """Grid levels for these distinct POI positions: a finer one is added while the busiest cell of the last holds too
    many, and cells are still larger than the room left for rounding.

    A point meets the POIs of a bounded number of finest cells, so this keeps the pairs in proportion
    to the points however tightly the POIs cluster. Each level is measured; only its maximum comes back
    to the driver.
    """
    levels = list(LEVELS)
    while radius_m / levels[-1] > 10 * _SLACK_M:
        cell = _cell(F.col("lat"), F.col("lon"), _row_height(radius_m, levels[-1]))
        busiest = positions.groupBy(*group, *cell).count().agg(F.max("count")).first()[0] or 0
        if busiest <= CROWDED:
            break
        levels.append(levels[-1] * 4)
    return tuple(levels)


def _reach_degrees(lat: Column, radius_m: float) -> Column:
    """Degrees of longitude that the radius may span from this latitude, some too many; 180 near a pole."""
    degrees = _row_height(radius_m, 1)
    edge = F.abs(lat) + 3 * degrees
    return F.when(edge < _POLAR, F.least(F.lit(180.0), 1.01 * degrees / F.cos(F.radians(edge)))).otherwise(F.lit(180.0))


def _with_images(positions: DataFrame, radius_m: float) -> DataFrame:
    """Each POI position where it is and, if the radius crosses the 180th meridian from there, once around the globe.
    Cells use ``lon``; distances use ``poi_lon``, the longitude as written."""
    beyond = F.abs(F.col("poi_lon")) >= 180.0 - _reach_degrees(F.col("lat"), radius_m)
    around = F.when(beyond, F.col("poi_lon") - 360.0 * F.when(F.col("poi_lon") < 0, F.lit(-1)).otherwise(F.lit(1)))
    return positions.withColumnRenamed("lon", "poi_lon").withColumn(
        "lon", F.explode(F.array_compact(F.array(F.col("poi_lon"), around)))
    )


def nearest_within(points: DataFrame, pois: DataFrame, radius_m: float, group: list[str],
                   levels: tuple[int, ...] | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """``lat, lon`` of each distinct point with, per ``group``, the nearest POI: ``distance_m, poi_id`` and ``carried``.

    ``pois``: ``lat, lon, poi_id``, the group columns and the carried ones; ties go to the smallest ``poi_id``.
    Points with nothing in range have no row; points and POIs without a position take no part. ``levels`` are measured
    unless given.
    """
    a = cut_lineage(points.select("lat", "lon").filter("lat is not null and lon is not null").distinct())
    b = cut_lineage(
        pois.filter("lat is not null and lon is not null").groupBy(*group, "lat", "lon")
        .agg(F.min(F.struct("poi_id", *carried)).alias("poi"))
    )
    levels = levels or levels_for(b, radius_m, group)
    b = _with_images(b, radius_m)

    height = _row_height(radius_m, levels[0])
    a_cells = a.select(*_cell(F.col("lat"), F.col("lon"), height)).distinct()
    b_cells = b.select(*group, *_cell(F.col("lat"), F.col("lon"), height)).distinct()
    # A degree of longitude shrinks with latitude: reach further the nearer the cell is to a pole.
    farther = F.greatest(F.abs(F.col("cy")), F.abs(F.col("cy") + 1)) * height
    reach_x = F.ceil(_reach_degrees(farther, radius_m) / height).cast("int")
    reached = a_cells.select(
        F.col("cy").alias("ay"), F.col("cx").alias("ax"),
        F.explode(F.sequence(F.col("cy") - levels[0], F.col("cy") + levels[0])).alias("by"), reach_x.alias("reach"),
    ).select("ay", "ax", "by", F.explode(F.sequence(F.col("ax") - F.col("reach"), F.col("ax") + F.col("reach"))).alias("bx"))
    pairs = _prune(
        reached.join(b_cells.select(*group, F.col("cy").alias("by"), F.col("cx").alias("bx")), ["by", "bx"]),
        height, radius_m, group,
    )
    for coarse, fine in zip(levels, levels[1:]):
        if fine % coarse:
            raise ValueError("each level must be a multiple of the one before")
        height, factor = _row_height(radius_m, fine), fine // coarse
        pairs = _prune(_split(pairs, a, b, height, factor, group), height, radius_m, group)

    a_in = a.select("lat", "lon", *[c.alias(n) for c, n in zip(_cell(F.col("lat"), F.col("lon"), height), ("ay", "ax"))])
    b_in = b.select(
        *group, F.col("lat").alias("poi_lat"), "poi_lon", "poi",
        *[c.alias(n) for c, n in zip(_cell(F.col("lat"), F.col("lon"), height), ("by", "bx"))],
    )
    met = a_in.join(pairs, ["ay", "ax"]).join(b_in, [*group, "by", "bx"])
    distance = haversine_m(F.col("lat"), F.col("lon"), F.col("poi_lat"), F.col("poi_lon"))
    return (
        met.select("lat", "lon", *group, "poi", distance.alias("distance_m"))
        .filter(F.col("distance_m") <= radius_m)
        .groupBy("lat", "lon", *group)
        .agg(F.min(F.struct("distance_m", "poi")).alias("best"))
        .select("lat", "lon", *group, "best.distance_m", "best.poi.*")
    )


def _split(pairs: DataFrame, a: DataFrame, b: DataFrame, height: float, factor: int, group: list[str]) -> DataFrame:
    """Replace each cell pair by the pairs of its occupied sub-cells."""

    def children(side: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
        fine = side.select(*keep, *_cell(F.col("lat"), F.col("lon"), height)).distinct()
        return fine.select(
            *keep,
            F.floor(F.col("cy") / factor).cast("bigint").alias(names[0]),
            F.floor(F.col("cx") / factor).cast("bigint").alias(names[1]),
            F.col("cy").alias(names[0] + "_"), F.col("cx").alias(names[1] + "_"),
        )

    split = pairs.join(children(a, ["ay", "ax"], []), ["ay", "ax"]).join(
        children(b, ["by", "bx"], group), [*group, "by", "bx"]
    )
    return split.select(*group, *[F.col(n + "_").alias(n) for n in ("ay", "ax", "by", "bx")])


KINDS = ["kind", "is_major_chain"]


def _nearest_named(listings: DataFrame, pois: DataFrame, radius_m: float) -> DataFrame:
    sites = pois.select("lat", "lon", *KINDS, F.col("osm_id").alias("poi_id"), "name")
    return nearest_within(listings, sites, radius_m, KINDS, carried=["name"])


def nearest_pois(listings: DataFrame, pois: DataFrame, radius_m: float) -> DataFrame:
    """``listing_id, kind, is_major_chain, distance_m, osm_id, name``: nearest per kind, chains apart."""
    named = _nearest_named(listings, pois, radius_m)
    return listings.select("listing_id", "lat", "lon").join(named, ["lat", "lon"]).select(
        "listing_id", "kind", "is_major_chain", "distance_m", F.col("poi_id").alias("osm_id"), "name"
    )


def walkability(listings: DataFrame, pois: DataFrame, walking: Walking) -> DataFrame:
    """``listing_id, walkability{cafe, supermarket, gym}``.

    A supermarket chain in range beats a nearer corner store. Nothing in range is ``none_found``, a
    listing without a position is ``unavailable``.
    """
    named = _nearest_named(listings, pois, walking.poi_radius_m)
    # At most two rows per kind and position.
    rank = F.struct(
        F.when(F.col("kind") == "supermarket", ~F.col("is_major_chain")).otherwise(F.lit(False)),
        "distance_m", "poi_id",
    )
    best = named.groupBy("lat", "lon").agg(
        *[
            F.min_by(
                F.struct("name", "distance_m", "is_major_chain"), F.when(F.col("kind") == kind, rank)
            ).alias(kind)
            for kind in POI_KINDS
        ]
    )
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    # Listings without a position match nothing; a third join column keeps them from meeting in one task.
    rows = listings.select("listing_id", "lat", "lon", scatter_slot(located, "listing_id").alias("_slot"))
    joined = rows.join(best.withColumn("_slot", F.lit(0).cast("bigint")), ["lat", "lon", "_slot"], "left")

    def block(kind: str) -> Column:
        hit = F.col(kind)
        fields = [
            F.when(~located, F.lit("unavailable")).when(hit.isNull(), F.lit("none_found")).otherwise(F.lit("ok"))
            .alias("status"),
            F.when(located, F.lit(SOURCE)).alias("source"),
            hit["name"].alias("name"),
            walk_minutes(hit["distance_m"], walking.detour_factor, walking.speed_m_per_min).alias("walk_minutes"),
            whole(hit["distance_m"]).alias("distance_m"),
        ]
        if kind == "supermarket":
            fields.append(hit["is_major_chain"].alias("is_major_chain"))
        return F.struct(*fields).alias(kind)

    return joined.select("listing_id", F.struct(*[block(kind) for kind in POI_KINDS]).alias("walkability"))


def cached_walkability(listings: DataFrame, pois: DataFrame, walking: Walking, config_hash: str, computed_at: str) -> DataFrame:
    """``listing_id, walkability`` as the ledger keeps it, for listings with a position: the block, when and under which
    configuration it was made, and the position it was made for. ``travel.stale_walkability`` reads these."""
    located = listings.filter("lat is not null and lon is not null")
    made = [F.lit(computed_at).alias("computed_at"), F.lit(config_hash).alias("config_hash"), F.col("lat"), F.col("lon")]
    return walkability(located, pois, walking).join(located.select("listing_id", "lat", "lon"), "listing_id").select(
        "listing_id", F.struct(*made, "walkability.*").alias("walkability")
    )


def request_cells(points: DataFrame, radius_m: float, degrees: float = CELL_DEGREES) -> DataFrame:
    """Grid cells that hold points, grown by the radius, with how many points each holds."""
    cells = (
        points.filter("lat is not null and lon is not null")
        .groupBy(
            F.floor(F.col("lat") / degrees).cast("bigint").alias("cell_lat"),
            F.floor(F.col("lon") / degrees).cast("bigint").alias("cell_lon"),
        )
        .agg(F.count("*").alias("listings"))
    )
    margin = radius_m / METRES_PER_DEGREE
    south, west = F.col("cell_lat") * degrees, F.col("cell_lon") * degrees
    margin_lon = F.lit(margin) / F.cos(F.radians(south))
    return cells.select(
        "cell_lat", "cell_lon", (south - margin).alias("south"), (west - margin_lon).alias("west"),
        (south + degrees + margin).alias("north"), (west + degrees + margin_lon).alias("east"), "listings",
    ).orderBy(F.desc("listings"), "cell_lat", "cell_lon")
