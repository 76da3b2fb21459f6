"""Saved searches: which listings they match, what they cover, how they are planned.

A saved search is configuration, so its predicate is known when the plan is built. Matching is
therefore a projection over the listings (no join, no shuffle, no hot ``origin:mode`` key), however
many searches there are. Searches kept as a table are matched by an equi-join on the travel key with
both sides salted; it gives each row the same answer.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Envelope, LocationRule, SavedSearch

JOIN_SALTS = 16


def _passes(search: SavedSearch, minutes: Column) -> Column:
    """The search's predicate. A missing routed time or price never passes a test that needs it."""
    price, beds = F.col("price_pw"), F.col("beds")
    tests = [minutes <= search.max_minutes]
    if search.max_price_pw is not None:
        tests.append(price <= search.max_price_pw)
    if search.min_price_pw is not None:
        tests.append(price >= search.min_price_pw)
    if search.min_beds is not None:
        tests.append(beds >= search.min_beds)
    if search.max_beds is not None:
        tests.append(beds <= search.max_beds)
    if search.min_baths is not None:
        tests.append(F.col("baths") >= search.min_baths)
    if search.min_car_spaces is not None:
        tests.append(F.col("car_spaces") >= search.min_car_spaces)
    if search.property_types is not None:
        tests.append(F.col("property_type").isin(*search.property_types))
    if search.exclude_flagged:
        tests.append(~F.arrays_overlap(F.coalesce("flags", _texts([])), _texts(search.exclude_flagged)))
    passed = tests[0]
    for test in tests[1:]:
        passed = passed & test
    return F.coalesce(passed, F.lit(False))


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def matched_searches(searches: Sequence[SavedSearch], travel: str = "travel") -> Column:
    """Ids of the matching searches in configuration order."""

    def minutes(search: SavedSearch) -> Column:
        return F.try_element_at(F.col(travel), F.lit(search.travel_key))["minutes"]

    hits = [F.when(_passes(s, minutes(s)), F.lit(s.search_id)) for s in searches]
    return F.array_compact(F.array(*hits)) if hits else _texts([])


def searches_frame(spark: SparkSession, searches: Sequence[SavedSearch]) -> DataFrame:
    """The configuration as rows; ``position`` keeps its order."""
    schema = (
        "position INT, search_id STRING, label STRING, travel_key STRING, origin STRING, mode STRING, "
        "max_minutes DOUBLE, min_price_pw DOUBLE, max_price_pw DOUBLE, min_beds INT, max_beds INT, min_baths INT, "
        "min_car_spaces INT, property_types ARRAY<STRING>, exclude_flagged ARRAY<STRING>"
    )

    def number(value):
        return None if value is None else float(value)

    rows = [
        (
            i, s.search_id, s.label, s.travel_key, s.origin, s.mode, float(s.max_minutes),
            number(s.min_price_pw), number(s.max_price_pw), s.min_beds, s.max_beds, s.min_baths, s.min_car_spaces,
            None if s.property_types is None else list(s.property_types), list(s.exclude_flagged),
        )
        for i, s in enumerate(searches)
    ]
    return spark.createDataFrame(rows, schema)


def match_searches(candidates: DataFrame, searches: Sequence[SavedSearch], travel: str = "travel") -> DataFrame:
    """Add ``matched_searches``: ids in configuration order, empty when nothing matches."""
    return candidates.withColumn("matched_searches", matched_searches(searches, travel))


def match_search_table(candidates: DataFrame, config: DataFrame, travel: str = "travel") -> DataFrame:
    """:func:`match_searches` for searches that are rows (see :func:`searches_frame`): each row of ``candidates``, ids
    repeated or not, with its own ids in ``position`` order."""
    # A handful of travel keys carry all rows: spread each key over JOIN_SALTS partitions.
    rules = config.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
    whole = candidates.select(F.struct(*candidates.columns).alias("row"), F.monotonically_increasing_id().alias("row_no"))
    long = whole.select(
        "row", "row_no", "row.price_pw", "row.beds", "row.baths", "row.car_spaces", "row.property_type",
        F.coalesce("row.flags", _texts([])).alias("flags"),
        F.explode_outer(f"row.{travel}").alias("travel_key", "leg"),
        F.pmod(F.xxhash64("row_no"), F.lit(JOIN_SALTS)).cast("int").alias("salt"),
    )
    c, r = long.alias("c"), rules.alias("r")

    def open_or(bound: str, test: Column) -> Column:
        return F.col(f"r.{bound}").isNull() | test

    hits = c.join(
        r,
        (F.col("c.travel_key") == F.col("r.travel_key"))
        & (F.col("c.salt") == F.col("r.salt"))
        & (F.col("c.leg.minutes") <= F.col("r.max_minutes"))
        & open_or("max_price_pw", F.col("c.price_pw") <= F.col("r.max_price_pw"))
        & open_or("min_price_pw", F.col("c.price_pw") >= F.col("r.min_price_pw"))
        & open_or("min_beds", F.col("c.beds") >= F.col("r.min_beds"))
        & open_or("max_beds", F.col("c.beds") <= F.col("r.max_beds"))
        & open_or("min_baths", F.col("c.baths") >= F.col("r.min_baths"))
        & open_or("min_car_spaces", F.col("c.car_spaces") >= F.col("r.min_car_spaces"))
        & open_or("property_types", F.array_contains(F.col("r.property_types"), F.col("c.property_type")))
        & ~F.arrays_overlap(F.col("c.flags"), F.col("r.exclude_flagged")),
        "left",
    )
    # At most one hit per (row, search): the list is bounded by the configuration.
    hit = F.when(F.col("r.search_id").isNotNull(), F.struct("r.position", "r.search_id"))
    rows = hits.groupBy("c.row_no").agg(
        F.first("c.row").alias("row"), F.transform(F.array_sort(F.collect_list(hit)), lambda x: x["search_id"]).alias("matched_searches")
    )
    return rows.select("row.*", "matched_searches")


def excluded_by_every_search(searches: Sequence[SavedSearch], flags: Column) -> Column:
    """True when each search refuses the listing on flags alone; no searches means false."""
    if not searches:
        return F.lit(False)
    verdict = F.lit(True)
    for search in searches:
        verdict = verdict & F.arrays_overlap(flags, _texts(search.exclude_flagged))
    return F.coalesce(verdict, F.lit(False))


def covered_searches(searches: DataFrame, groups: DataFrame) -> DataFrame:
    """Searches whose ``origin:mode`` the capture holds; an unasked search is absent, not zero."""
    return searches.join(groups.select("origin", "mode").distinct(), ["origin", "mode"], "left_semi")


# ---- planning ------------------------------------------------------------------------------


def _rule(search: SavedSearch) -> LocationRule | None:
    return search.locations if isinstance(search.locations, LocationRule) else None


def resolve_locations(envelope: DataFrame, searches: Sequence[SavedSearch]) -> DataFrame:
    """``search_id, search_pos, location, location_pos`` for every location a search asks about.

    ``envelope``: ``location, location_pos, indicative_minutes map, km_from map`` (maps null for a
    place nobody tagged). A place a rule cannot measure is kept. A list is the answer itself, in the envelope or not
    (:func:`refusals` names what lies outside). One pass over the envelope: each search's test is a literal predicate,
    so nothing is joined.
    """
    picks, listed = [], []
    for pos, search in enumerate(searches):
        rule = _rule(search)
        if search.locations is not None and rule is None:
            names = dict.fromkeys(search.locations)
            listed += [(search.search_id, pos, search.travel_key, name, i) for i, name in enumerate(names)]
            continue
        keep = F.lit(True)
        if rule is not None:
            if rule.within_indicative_minutes is not None:
                key = f"{search.origin}:{rule.mode or search.mode}"
                minutes = F.try_element_at(F.col("indicative_minutes"), F.lit(key))
                keep = keep & F.coalesce(minutes <= rule.within_indicative_minutes, F.lit(True))
            if rule.within_km is not None:
                km = F.try_element_at(F.col("km_from"), F.lit(search.origin))
                keep = keep & F.coalesce(km <= rule.within_km, F.lit(True))
        picks.append(
            F.when(
                keep,
                F.struct(
                    F.lit(search.search_id).alias("search_id"), F.lit(pos).alias("search_pos"),
                    F.lit(search.travel_key).alias("travel_key"),
                ),
            )
        )
    schema = "search_id STRING, search_pos INT, travel_key STRING, location STRING, location_pos INT"
    given = envelope.sparkSession.createDataFrame(listed, schema)
    if not picks:
        return given
    return envelope.select(
        "location", "location_pos", F.explode(F.array_compact(F.array(*picks))).alias("pick")
    ).select("pick.search_id", "pick.search_pos", "pick.travel_key", "location", "location_pos").unionByName(given)


def refusals(envelope: DataFrame, searches: Sequence[SavedSearch], limits: Envelope, origins: Sequence[str],
             asked: Sequence[str] | None = None) -> DataFrame:
    """``search_id, reason``: the first reason each search cannot be planned, and asked ids nobody saved.

    The config decides all but one reason; whether a listed location lies in the envelope is a
    left-anti join against it.
    """
    spark = envelope.sparkSession
    wanted = [s for s in searches if asked is None or s.search_id in set(asked)]
    saved = {s.search_id for s in searches}
    rows = [(-1, a, "no such search saved") for a in asked or [] if a not in saved]
    listed = []
    for pos, s in enumerate(wanted):
        reasons = []
        if s.origin not in origins:
            reasons.append((0, f'unknown origin "{s.origin}"'))
        if _rule(s) is not None:
            reasons.append((1, None))  # decided by whether any place is tagged
        if s.max_price_pw is not None and s.max_price_pw > limits.max_price_pw:
            reasons.append((3, f"max_price_pw {s.max_price_pw:g} is above the envelope's {limits.max_price_pw:g}"))
        if s.min_beds is not None and s.min_beds < limits.min_beds:
            reasons.append((4, f"min_beds {s.min_beds} is below the envelope's {limits.min_beds}"))
        rows += [(pos * 10 + rank, s.search_id, text) for rank, text in reasons]
        if s.locations is not None and _rule(s) is None:
            listed += [(pos * 10 + 2, s.search_id, i, name) for i, name in enumerate(s.locations)]
    known = spark.createDataFrame(rows, "rank INT, search_id STRING, reason STRING")
    tagged = envelope.agg(F.count("indicative_minutes")).scalar()
    known = known.select(
        "rank", "search_id",
        F.coalesce(
            "reason",
            F.when(tagged == 0, F.lit("locations is a rule but no place is tagged to resolve it against")),
        ).alias("reason"),
    ).filter(F.col("reason").isNotNull())
    names = spark.createDataFrame(listed, "rank INT, search_id STRING, i INT, location STRING")
    outside = (
        names.join(envelope.select("location"), "location", "left_anti")
        .groupBy("rank", "search_id")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "location"))), lambda x: x["location"]), ", ").alias("names"))
        .select("rank", "search_id", F.concat(F.lit("location(s) not in the envelope: "), "names").alias("reason"))
    )
    return known.unionByName(outside).groupBy("search_id").agg(F.min_by("reason", "rank").alias("reason"))


def plan_passes(resolved: DataFrame, searches: Sequence[SavedSearch], refused: DataFrame | None = None) -> DataFrame:
    """One capture pass per ``origin:mode``: widest budget, search ids, size of the location union.

    ``refused``: ``search_id`` of searches that cannot be planned (see :func:`refusals`); they widen no pass.
    """
    config = searches_frame(resolved.sparkSession, searches)
    if refused is not None:
        out = refused.select("search_id").distinct()
        config, resolved = (df.join(out, "search_id", "left_anti") for df in (config, resolved))
    unions = resolved.groupBy("travel_key").agg(F.countDistinct("location").alias("locations"))
    return (
        config.groupBy("travel_key", "origin", "mode")
        .agg(
            F.max("max_minutes").alias("max_minutes"),
            F.transform(F.array_sort(F.collect_list(F.struct("position", "search_id"))), lambda x: x["search_id"])
            .alias("search_ids"),
        )
        .join(unions, "travel_key", "left")
        .select(
            "travel_key", "origin", "mode", "max_minutes", "search_ids",
            F.coalesce("locations", F.lit(0)).cast("bigint").alias("locations"),
            (F.col("mode") == "transit").alias("needs_arrive_by"),
        )
    )


def pass_locations(resolved: DataFrame) -> DataFrame:
    """The ordered location union of each pass: first search wins a location's place in the order."""
    return resolved.groupBy("travel_key", "location").agg(
        F.min(F.struct("search_pos", "location_pos")).alias("first")
    ).select("travel_key", "location", F.col("first.search_pos").alias("search_pos"),
             F.col("first.location_pos").alias("location_pos"))


def _hits(matched: DataFrame) -> DataFrame:
    # Outer: an inner explode would evaluate all predicates once more in a filter below it.
    hits = matched.select(F.explode_outer("matched_searches").alias("search_id")).filter("search_id is not null")
    return hits.groupBy("search_id").agg(F.count("*").alias("matched"))


def matched_counts(matched: DataFrame, searches: Sequence[SavedSearch]) -> DataFrame:
    """``search_id, matched`` of every search given, zero included."""
    config = searches_frame(matched.sparkSession, searches).select("search_id")
    return config.join(_hits(matched), "search_id", "left").select(
        "search_id", F.coalesce("matched", F.lit(0).cast("bigint")).alias("matched")
    )


def search_results(matched: DataFrame, searches: Sequence[SavedSearch], group_totals: DataFrame, resolved: DataFrame,
                   searched: DataFrame | None = None, passes: Collection[str] | None = None,
                   reports: DataFrame | None = None) -> DataFrame:
    """One row per covered search, zero matches included.

    ``group_totals``: ``travel_key, considered``. ``searched``: the locations actually queried, null
    meaning all of them; ``locations_searched`` lists a search's own in order. ``passes``: the capture's ``origin:mode``
    keys, which decide what is covered, so a pass that returned nothing still reports; without them the passes in
    ``group_totals`` count. ``reports``: ``travel_key, travel``, the travel report of each pass.
    """
    config = searches_frame(matched.sparkSession, [s for s in searches if passes is None or s.travel_key in passes])
    counts = _hits(matched)
    asked = resolved.groupBy("search_id").agg(F.count("*").alias("wanted"))
    done = resolved
    if searched is not None:
        done = resolved.join(searched.select("location").distinct(), "location", "left_semi")
    # One entry per location a search asks about: bounded by the envelope.
    listed = done.groupBy("search_id").agg(
        F.count("*").alias("queried"),
        F.transform(F.array_sort(F.collect_list(F.struct("location_pos", "location"))), lambda x: x["location"]).alias("locations_searched"),
    )
    coverage = asked.join(listed, "search_id", "left")
    zero = F.lit(0).cast("bigint")
    joined = config.join(group_totals, "travel_key", "inner" if passes is None else "left")
    if reports is not None:
        joined = joined.join(reports.select("travel_key", "travel"), "travel_key", "left")
    return (
        joined
        .join(counts, "search_id", "left")
        .join(coverage, "search_id", "left")
        .select(
            "search_id", "label",
            F.when(F.coalesce("queried", zero) < F.coalesce("wanted", zero), F.lit("partial_coverage"))
            .otherwise(F.lit("ok")).alias("status"),
            F.coalesce("matched", zero).alias("matched"),
            F.coalesce("considered", zero).alias("considered"),
            F.coalesce("queried", zero).alias("locations_queried"),
            F.coalesce("wanted", zero).alias("locations_wanted"),
            F.coalesce("locations_searched", _texts([])).alias("locations_searched"),
            *(["travel"] if reports is not None else []),
        )
    )
