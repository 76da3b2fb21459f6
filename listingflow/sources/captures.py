"""Capture documents: declared schema in, flat rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CAPTURE

CORRUPT = "_corrupt_record"


def read_documents(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """JSON documents under a declared schema, with ``source_path`` beside each.

    ``strict`` fails the job on the first document the schema refuses; otherwise the refused text
    is kept in ``_corrupt_record`` for :func:`quarantined`.
    """
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if not strict:
        schema = f"{schema}, {CORRUPT} STRING"
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path).withColumn("source_path", F.col("_metadata.file_path"))


def quarantined(documents: DataFrame) -> DataFrame:
    """Paths and text of the documents a permissive read could not parse."""
    return documents.filter(F.col(CORRUPT).isNotNull()).select("source_path", CORRUPT)


def read_captures(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return read_documents(spark, path, CAPTURE, strict)


def capture_rows(captures: DataFrame) -> DataFrame:
    """One row per returned listing, position columns first; the flat form is used when no pass exists."""
    passes = F.when(
        F.size("groups") > 0,
        F.transform(
            "groups",
            lambda g, i: F.struct(
                i.alias("group_pos"),
                F.concat_ws(":", g["origin"], g["mode"]).alias("travel_key"),
                g["results"].alias("results"),
            ),
        ),
    ).otherwise(
        F.array(
            F.struct(
                F.lit(0).alias("group_pos"), F.lit(None).cast("string").alias("travel_key"),
                F.col("results").alias("results"),
            )
        )
    )
    one_pass = captures.select("source_path", F.explode(passes).alias("p"))
    rows = one_pass.select(
        "source_path", "p.group_pos", "p.travel_key", F.posexplode("p.results").alias("row_pos", "row")
    )
    return rows.select(
        "source_path", "group_pos", "row_pos", "travel_key", F.col("row.id").alias("listing_id"), "row.*"
    ).drop("id")


def rejected_rows(captures: DataFrame) -> DataFrame:
    """One row per listing a pass rejected on travel time, in capture order."""
    passes = captures.select("source_path", F.posexplode("groups").alias("group_pos", "g"))
    return passes.select(
        "source_path", "group_pos", F.concat_ws(":", "g.origin", "g.mode").alias("travel_key"),
        F.posexplode("g.filtered_by_travel").alias("row_pos", "row"),
    ).select(
        "source_path", "group_pos", "row_pos", "travel_key", F.col("row.id").alias("listing_id"),
        "row.url", "row.address", F.col("row.coords.lat").alias("lat"), F.col("row.coords.lng").alias("lon"),
        "row.travel",
    )


def capture_groups(captures: DataFrame) -> DataFrame:
    """The passes themselves: origin, mode, budget, arrive-by."""
    return captures.select("source_path", F.posexplode("groups").alias("group_pos", "g")).select(
        "source_path", "group_pos", "g.origin", "g.mode",
        F.concat_ws(":", "g.origin", "g.mode").alias("travel_key"),
        "g.max_travel_minutes", "g.arrive_by", "g.locations_searched",
    )
