"""A run from a capture: flatten, normalise, fold the ledger, score, match, publish."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Envelope, SavedSearch, Scoring
from ..operators import capture as C
from ..operators.enrichment import listing_flags, missing_enrichment, run_notes
from ..operators.ledger import FOLD_COLUMNS, fold_run
from ..operators.normalise import normalise, problems, usable, with_keyword_hit
from ..operators.photos import photo_plan
from ..operators.places import centroid_corrections, new_suburbs, observed_rents, realigned
from ..operators.rejected import fold_rejected
from ..operators.scoring import ranked
from ..operators.searches import excluded_by_every_search, match_searches, search_results
from ..operators.snapshots import run_summary
from ..session import cut_lineage
from .entries import listing_entries
from .guards import Asked, partial_notes, require_arrive_by, require_passes, require_plannable

SOURCE_FACTS = [
    "url", "address", "suburb", "state", "postcode", "price", "propertyType", "bedrooms", "bathrooms", "carSpaces",
    "buildingSize", "description", "images", "coords",
]


@dataclass(frozen=True)
class State:
    """What earlier runs left behind, as tables."""

    ledger: DataFrame
    rejected: DataFrame
    profiles: DataFrame
    envelope: DataFrame  # location, suburb_key, lat, lon
    gazetteer: DataFrame  # suburb_key, lat, lon
    resolved: DataFrame  # search_id, location: what each search asks about


@dataclass(frozen=True)
class Run:
    """What a build produces; nothing is published until the caller does. ``profiles`` is the suburb table that scored this
    run: publish it and hand it to the next."""

    listings: DataFrame
    ledger: DataFrame
    rejected: DataFrame
    suburbs: DataFrame
    profiles: DataFrame
    observed: DataFrame
    results: DataFrame
    summary: DataFrame
    notes: DataFrame
    funnel: DataFrame
    problems: DataFrame
    photos: DataFrame


def covered(searches: Sequence[SavedSearch], passes: Collection[str]) -> list[SavedSearch]:
    """Saved searches whose pass (``origin:mode``) the capture holds; an unasked search is absent, not zero."""
    return [s for s in searches if s.travel_key in passes]


def build(rows: DataFrame, rejections: DataFrame, passes: Collection[str], verdicts: DataFrame, state: State,
          scoring: Scoring, limits: Envelope, searches: Sequence[SavedSearch], run_id: str, previous_run: str | None,
          created_at: str, url_base: str, travel_source: str, partial: bool = False,
          searched: DataFrame | None = None, carried_notes: Sequence[str] = (), capture: Asked | None = None,
          force: bool = False) -> Run:
    """Everything a run publishes.

    ``rows``, ``rejections``: flat capture rows. ``passes``: the capture's ``origin:mode`` keys.
    ``searched``: the locations that were queried; where some of the envelope's are missing, or with ``partial``, nothing may
    go stale, and a note says so. ``capture``: what the capture was asked for; a covered search that the envelope cannot
    answer, or transit measured against another arrive-by (unless ``force``), stops the build, as does a capture without
    passes. Frames that feed
    several outputs are written to the shared checkpoint folder while the build runs: computed once, and
    still there when executors are lost. A new suburb that nothing can place stops the build.
    """
    require_passes(passes)
    asked = covered(searches, passes)
    if capture is not None:
        require_plannable(capture, asked, limits)
        require_arrive_by(capture, force)
    if searched is not None:
        state_of_search = partial_notes(searched, state.envelope).first()
        partial = partial or state_of_search["partial"]
        carried_notes = [*carried_notes, *([state_of_search["note"]] if state_of_search["note"] else [])]
    rows = cut_lineage(rows)
    flat = C.unique_listings(rows, SOURCE_FACTS)
    normal = normalise(with_keyword_hit(flat, list(limits.exclude_keywords)), url_base)
    normal = cut_lineage(normal)
    listings = usable(normal).filter("excluded_by is null")

    folded = cut_lineage(
        fold_run(state.ledger, listings, C.returned_ids(rows), verdicts, run_id, previous_run, not partial)
    )
    ledger = folded.drop(*FOLD_COLUMNS)

    history = folded.filter("state is not null").select(
        "listing_id", F.col("state").alias("listing_state"), "first_seen_run", "prev_pw", "delta_pw",
        "image_files", "cached_travel", "walkability",
    )
    current = listings.join(history, "listing_id").withColumn("agent_notes", F.lit(""))
    medians = observed_rents(listings, run_id, created_at)
    suburbs = cut_lineage(new_suburbs(listings, state.profiles, state.envelope, state.gazetteer))
    lost = suburbs.filter("not placeable").select("suburb_key", "listings").orderBy("suburb_key").limit(20).collect()
    if lost:
        names = ", ".join(f"{r.suburb_key} ({r.listings})" for r in lost)
        raise ValueError(f"suburbs without a position, and a profile needs one: {names}")
    profiles = cut_lineage(next_profiles(state, suburbs, medians))
    entries = listing_entries(current, profiles, scoring, travel_source)
    matched = cut_lineage(match_searches(entries, asked, travel="captured_travel"))
    published = matched.filter(F.size("matched_searches") > 0) if asked else matched

    early = listing_flags(scoring.target_price_pw)
    known = folded.select(
        "listing_id", F.col("image_urls").alias("known_urls"), F.col("image_files").alias("files")
    )
    wanted = listings.filter(~excluded_by_every_search(asked, early))
    photos = photo_plan(wanted.select("listing_id", "image_urls").join(known, "listing_id"))
    gone = folded.filter("absent_status is not null and absent_status <> 'unmatched'")
    notes = note_rows(published, carried_notes)
    counted = rows.groupBy("listing_id").agg(F.count("*").alias("rows"))
    funnel = C.funnel(
        normal.join(counted, "listing_id").join(
            matched.select("listing_id", (F.size("matched_searches") > 0).alias("hit")), "listing_id", "left"
        ),
        F.col("rows"), F.col("excluded_by"), F.col("problem"), F.coalesce("hit", F.lit(False)),
    )
    return Run(
        listings=ranked(published),
        ledger=ledger,
        rejected=fold_rejected(state.rejected, rejections, ledger, run_id, created_at),
        suburbs=suburbs,
        profiles=profiles,
        observed=medians,
        results=search_results(matched, asked, C.group_totals(rows), state.resolved, searched, passes),
        summary=run_summary(published, gone),
        notes=notes,
        funnel=funnel,
        problems=problems(normal.filter("excluded_by is null")),
        photos=photos,
    )


def note_rows(listings: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """The run's notes, one per row: the one about missing enrichment is derived anew, the rest are carried."""
    kept = F.array(*[F.lit(n) for n in carried]) if carried else F.array().cast("array<string>")
    return missing_enrichment(listings).select(F.explode(run_notes(F.col("note"), kept)).alias("note"))


def next_profiles(state: State, suburbs: DataFrame, medians: DataFrame) -> DataFrame:
    """The suburb table after this run: known profiles moved to where the envelope has them, a stub for each new suburb,
    then this run's medians."""
    moved = realigned(state.profiles, centroid_corrections(state.profiles, state.envelope))
    stubs = suburbs.filter("placeable").select("suburb_key", "name", "postcode", "lat", "lon")
    return with_observed(moved.unionByName(stubs, allowMissingColumns=True), medians)


def with_observed(profiles: DataFrame, medians: DataFrame) -> DataFrame:
    """Profiles with this run's observed medians; a suburb the capture missed keeps what it had."""
    fresh = medians.select("suburb_key", F.col("median_pw_by_beds").alias("_fresh"))
    return profiles.join(fresh, "suburb_key", "left").withColumn(
        "observed_rents", F.coalesce("_fresh", "observed_rents")
    ).drop("_fresh")
