"""Points of interest from raw map elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import trimmed
from ..schemas import POI_ELEMENT

# ---- Fixed values: names that decide a kind or a chain -------------------------------------
MAJOR_CHAIN = "Woolworths|Coles|ALDI|IGA|Harris Farm|FoodWorks"
GYM_CHAINS = "Anytime Fitness|F45|Fitness First|Plus Fitness|Snap Fitness|BFT|Jetts"
# -------------------------------------------------------------------------------------------


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POI_ELEMENT).json(path)


def poi_kind(tags: Column) -> Column:
    """Kind by tag precedence; a franchise name stands in for a missing gym tag."""

    def tag(name: str) -> Column:
        return F.try_element_at(tags, F.lit(name))

    return (
        F.when(tag("amenity") == "cafe", F.lit("cafe"))
        .when(tag("shop") == "supermarket", F.lit("supermarket"))
        .when((tag("leisure") == "fitness_centre") | (tag("amenity") == "gym"), F.lit("gym"))
        .when(tag("name").rlike("(?i)" + GYM_CHAINS), F.lit("gym"))
    )


def admit_pois(elements: DataFrame) -> DataFrame:
    """Typed POIs: known kind, a position, and a name unless it is a gym."""
    name = trimmed(F.try_element_at(F.col("tags"), F.lit("name")))
    carried = [c for c in elements.columns if c not in ("type", "id", "lat", "lon", "center", "tags")]
    typed = elements.select(
        *carried,
        poi_kind(F.col("tags")).alias("kind"),
        F.concat_ws("/", "type", F.col("id").cast("string")).alias("osm_id"),
        F.when(name != "", name).alias("name"),
        F.coalesce("lat", "center.lat").alias("lat"),
        F.coalesce("lon", "center.lon").alias("lon"),
    )
    known = typed.filter(
        F.col("kind").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
        & (F.col("name").isNotNull() | (F.col("kind") == "gym"))
    )
    chain = (F.col("kind") == "supermarket") & F.coalesce(F.col("name").rlike("(?i)" + MAJOR_CHAIN), F.lit(False))
    return known.withColumn("is_major_chain", chain)


def distinct_pois(pois: DataFrame, position: str) -> DataFrame:
    """One row per ``osm_id``: the last one read."""
    rest = [c for c in pois.columns if c not in ("osm_id", position)]
    return pois.groupBy("osm_id").agg(F.max_by(F.struct(*rest), position).alias("poi")).select("osm_id", "poi.*")
