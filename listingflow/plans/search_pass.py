"""One capture pass from fetched pages: parse, place, measure, split by travel budget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import capture as C
from ..operators.lookups import look_up_buildings, look_up_routes, missing_routes, with_route_key
from ..session import cut_lineage
from ..sources.pages import normalised_item, page_payloads, search_rows


@dataclass(frozen=True)
class Pass:
    kept: DataFrame
    rejected: DataFrame
    report: DataFrame
    unmeasured: DataFrame  # routes a router still has to answer


def search_pass(pages: DataFrame, page_key: str, positions: DataFrame, routes: DataFrame, now_ms: int, mode: str,
                origin_lat: float, origin_lon: float, max_minutes: float, arrive_by: str | None = None,
                provider: str | None = None) -> Pass:
    """Pages to measured rows. Positions and routes come from memo tables; what they lack is reported, never guessed."""
    items = search_rows(page_payloads(pages), page_key)
    rows = items.select(page_key, "row_pos", "is_surrounding", *normalised_item(F.col("item")))
    placed = look_up_buildings(rows.drop("coords"), positions, F.lit(now_ms))
    keyed = with_route_key(
        placed.withColumnRenamed("lng", "lon"), F.lit(mode), F.lit(float(origin_lat)), F.lit(float(origin_lon)),
        F.lit(arrive_by), F.lit(provider),
    ).withColumn("route_key", F.when(F.col("lat").isNotNull(), F.col("route_key")))
    keyed = cut_lineage(keyed)
    measured = look_up_routes(keyed, routes).withColumns(
        {
            "coords": F.when(F.col("lat").isNotNull(), F.struct("lat", F.col("lon").alias("lng"))),
            "travel": F.when(
                F.col("travel").isNotNull(),
                F.struct("travel.minutes", "travel.km", F.lit(mode).alias("mode"), F.col("precision")),
            ),
        }
    )
    return Pass(
        kept=C.nearest_first(C.within_budget(measured, max_minutes)),
        rejected=C.over_budget(measured, max_minutes),
        report=C.travel_report(measured.withColumn("mode", F.lit(mode)), ["mode"]),
        unmeasured=missing_routes(keyed, routes),
    )
