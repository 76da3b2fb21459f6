"""Descriptive reports over normalised listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import bind
from ..functions.signals import (
    ROOM_LOOSE, ROOM_LOOSE_CONTEXT, ROOM_LOOSE_STEMS, STUDIO_LOOSE, STUDIO_LOOSE_CONTEXT, STUDIO_LOOSE_STEMS,
    loose_quotes, plain_text,
)


def tallies(listings: DataFrame, fields: list[str]) -> DataFrame:
    """``field, value, listings`` for several fields in one scan, most frequent first."""
    pairs = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("null")).alias("value"))
            for f in fields
        ]
    )
    return (
        listings.select(F.explode(pairs).alias("t"))
        .groupBy("t.field", "t.value").agg(F.count("*").alias("listings"))
        .orderBy("field", F.desc("listings"), "value")
    )


def price_report(listings: DataFrame) -> DataFrame:
    """One row: priced, lowest, highest, upper median (the element at half the count), presence counts.

    The upper median is the discrete median counted from the top; its state holds a count per
    distinct whole-dollar price, combined on the map side.
    """
    return listings.agg(
        F.count("*").alias("listings"),
        F.count("price_pw").alias("priced"),
        F.min("price_pw").alias("lowest"),
        F.max("price_pw").alias("highest"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY price_pw DESC)").cast("int").alias("upper_median"),
        F.count("area_sqm").alias("with_area"),
        F.count("lat").alias("with_position"),
    )


def signal_review(rows: DataFrame) -> DataFrame:
    """Flagged rows with their evidence, and unflagged rows whose text still matches a loose pattern.

    ``rows``: listing_id, description, room_evidence, studio_evidence. Columns: listing_id, kind
    (room | studio), flagged, notes (``signal: quote`` when flagged, else up to three quotes).
    """

    def review(kind: str, evidence: str, text: Column, pattern: str, context: int, stems: list[str]) -> Column:
        flagged = F.size(evidence) > 0
        notes = F.when(
            flagged, F.transform(evidence, lambda e: F.concat_ws(": ", e["signal"], e["quote"]))
        ).otherwise(loose_quotes(text, pattern, context, stems=stems))
        return F.struct(F.lit(kind).alias("kind"), flagged.alias("flagged"), notes.alias("notes"))

    both = bind(
        plain_text(F.col("description")),
        lambda text: F.array(
            review("room", "room_evidence", F.lower(text), ROOM_LOOSE, ROOM_LOOSE_CONTEXT, ROOM_LOOSE_STEMS),
            review("studio", "studio_evidence", text, STUDIO_LOOSE, STUDIO_LOOSE_CONTEXT, STUDIO_LOOSE_STEMS),
        ),
    )
    # Outer: an inner explode would copy the whole expression into a filter below it.
    return (
        rows.select("listing_id", F.explode_outer(both).alias("r")).select("listing_id", "r.*")
        .filter(F.size("notes") > 0)
    )


def outcome_tally(listings: DataFrame) -> DataFrame:
    """Distinct confidences and dealbreakers with their counts: ``what, value, listings``."""
    marks = F.concat(
        F.array(F.struct(F.lit("confidence").alias("what"), F.col("scores.confidence").cast("string").alias("value"))),
        F.transform("scores.dealbreakers", lambda d: F.struct(F.lit("dealbreaker").alias("what"), d.alias("value"))),
        F.when(
            F.size("scores.dealbreakers") == 0, F.array(F.struct(F.lit("clear").alias("what"), F.lit("").alias("value")))
        ).otherwise(F.array().cast("array<struct<what:string,value:string>>")),
    )
    return listings.select(F.explode(marks).alias("m")).groupBy("m.what", "m.value").agg(F.count("*").alias("listings"))
