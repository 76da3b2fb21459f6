"""What stops a build before it does any work, and what a partial search means for it."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Envelope, SavedSearch
from ..operators.ledger import partial_note, partial_search
from ..operators.searches import refusals
from ..operators.travel import arrive_by_mismatches


@dataclass(frozen=True)
class Asked:
    """What the capture was asked for. ``groups``: origin, mode, arrive_by of its passes; ``places``: the envelope with its
    tags (location, indicative_minutes, km_from); ``arrive_by``: the moment this build resolves for transit."""

    groups: DataFrame
    places: DataFrame
    origins: Sequence[str]
    arrive_by: str | None = None


class Refused(ValueError):
    """A build that may not start; ``reasons`` names why, one line each."""

    def __init__(self, what: str, reasons: Sequence[str] = ()):
        self.reasons = list(reasons)
        super().__init__("\n    ".join([what, *self.reasons]))


def require_passes(passes: Collection[str]) -> None:
    if not passes:
        raise Refused("the capture has no passes: nothing in it carries a routed time, so no search can match")


def require_plannable(asked: Asked, searches: Sequence[SavedSearch], limits: Envelope) -> None:
    """Every covered search must lie inside the envelope; a search narrows it and cannot widen it."""
    found = refusals(asked.places, searches, limits, asked.origins).orderBy("search_id").collect()  # one row per search
    if found:
        raise Refused("searches ask for what the envelope never captures:", [f"{r['search_id']}: {r['reason']}" for r in found])


def require_arrive_by(asked: Asked, force: bool = False) -> None:
    """Transit minutes must have been measured against the moment the run will name; ``force`` builds it anyway."""
    if asked.arrive_by is None or force:
        return
    found = arrive_by_mismatches(asked.groups, asked.arrive_by).orderBy("origin").limit(20).collect()
    if found:
        lines = [f"{r['origin']}:transit {r['arrive_by'] or '(none)'}" for r in found]
        raise Refused(f"the capture was not measured against the arrive-by of this build, {asked.arrive_by}:", lines)


def partial_notes(searched: DataFrame, configured: DataFrame) -> DataFrame:
    """``partial, note``: one row. ``searched``: location and perhaps location_pos, the locations that were queried, in that
    order; none means all. The note is null where the search was whole."""
    order = F.struct(*[c for c in ("location_pos", "location") if c in searched.columns])
    # Bounded by the envelope.
    names = searched.agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["location"]), ", ")).scalar()
    return partial_search(searched, configured).select(
        "partial", F.when(F.col("partial"), partial_note(F.col("searched"), F.col("configured"), names)).alias("note")
    )
