"""Rebuilding a published run from its capture, with the run's own settings, and saying what moved."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SavedSearch, Scoring
from ..operators import snapshots as D
from ..operators.normalise import normalise, usable, with_keyword_hit
from ..operators.capture import unique_listings
from ..operators.searches import match_searches, matched_counts
from ..session import cut_lineage
from .build import SOURCE_FACTS, note_rows
from .entries import listing_entries


@dataclass(frozen=True)
class Replay:
    listings: DataFrame
    changes: DataFrame  # field, listings, sample
    left: DataFrame
    violations: DataFrame  # must be empty
    drift: DataFrame  # must be empty
    matched: DataFrame  # search_id, matched: for the searches the run asked
    summary: DataFrame  # counts by state; who left the market stays what the run recorded
    notes: DataFrame


def carried_history(published: DataFrame) -> DataFrame:
    """The columns a rebuild owes to the run it rebuilds."""
    return published.select(
        "listing_id", "listing_state", "first_seen_run",
        F.col("price_change.prev_pw").alias("prev_pw"), F.col("price_change.delta_pw").alias("delta_pw"),
        F.transform("images.photos", lambda p: F.substring_index(p["src"], "/", -1)).alias("image_files"), "agent_notes",
    )


def replay(rows: DataFrame, published: DataFrame, ledger: DataFrame, profiles: DataFrame, scoring: Scoring,
           keywords: Sequence[str], asked: Sequence[SavedSearch], url_base: str, travel_source: str,
           carried_notes: Sequence[str] = ()) -> Replay:
    """``rows``: flat capture rows. ``scoring`` and ``asked`` come from the run's snapshots: searches it
    never asked may not gain matches. The ledger is read, never written."""
    listings = usable(normalise(with_keyword_hit(unique_listings(rows, SOURCE_FACTS), list(keywords)), url_base))
    current = (
        listings.filter("excluded_by is null")
        .join(carried_history(published), "listing_id")
        .join(ledger.select("listing_id", "cached_travel", "walkability"), "listing_id", "left")
    )
    entries = match_searches(listing_entries(current, profiles, scoring, travel_source), asked, travel="captured_travel")
    rebuilt = cut_lineage(entries.filter(F.size("matched_searches") > 0) if asked else entries)
    derived = [f for f in D.DERIVED_FIELDS if f in rebuilt.columns]
    history = [f for f in D.HISTORY_FIELDS if f in rebuilt.columns]
    return Replay(
        listings=rebuilt,
        changes=D.change_report(published, rebuilt, derived),
        left=D.left_run(published, rebuilt),
        violations=D.guard_violations(published, rebuilt, history),
        drift=D.drift(rebuilt, ledger),
        matched=matched_counts(rebuilt, asked),
        summary=D.state_counts(rebuilt),
        notes=note_rows(rebuilt, carried_notes),
    )
