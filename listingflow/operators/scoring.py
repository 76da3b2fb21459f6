"""Weighted scoring. Missing data sits out and lowers confidence; it never counts as zero.

``score_listings`` is projections only: no shuffle, one scan, whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FACTOR_KEYS, POI_KINDS, Dealbreakers, Scoring
from ..functions.numbers import Curve, clamp, piecewise, round_half_up

# ---- Fixed values: parts of the scoring model ---------------------------------------------
RENT_VALUE_CURVE = [(-0.15, 100.0), (0.0, 60.0), (0.15, 20.0)]
CRIME_WEIGHT, DECILE_WEIGHT, RENT_WEIGHT = 0.4, 0.3, 0.3
PREFERRED_BONUS = 8
MINUTES_PER_CHANGE = 5
NO_GYM_SCORE = 30
DEALBREAKERS = ["rent_above_hard_cap", "too_few_beds", "too_few_baths", "no_car_space", "commute_too_long"]
# -------------------------------------------------------------------------------------------

# Scores are built in stages of flat columns. Each stage is used more than once by the next, so the
# optimizer keeps the projections apart and every curve is evaluated (and compiled) once per row.


def place_raw(place: Column) -> Column:
    return F.when(place["status"].isin("ok", "fallback"), place["walk_minutes"])


def place_score(place: Column, minutes: Column, curve: Curve, none_found: float = 0.0) -> Column:
    """Nothing in range is a signal and scores ``none_found``; an unknown answer scores null."""
    return F.when(place["status"] == "none_found", F.lit(float(none_found))).otherwise(piecewise(minutes, curve))


def commute_minutes(commute: Column) -> Column:
    """Fastest measured way in, five minutes added per reported change; null when nothing was measured."""
    walk, transit = commute["walk"], commute["transit"]
    by_foot = F.when(walk["status"] != "unavailable", walk["minutes"])
    by_transit = F.when(
        transit["status"] != "unavailable",
        transit["minutes"] + MINUTES_PER_CHANGE * F.coalesce(transit["interchanges"], F.lit(0)),
    )
    return F.least(by_foot, by_transit)  # skips nulls


def with_suburb_factor(listings: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """Add ``suburb_raw, suburb_score, suburb_excluded, suburb_source``.

    Crime, income decile and rent value, renormalised over the parts the profile has. ``profile``:
    null or ``struct<crime_lower_than_pct, income_decile, published_rents map<beds, rent>,
    observed_rents map<beds, rent>>``. A published median outranks an observed one.
    """
    profile, price = F.col("profile"), F.col("price_pw")
    beds = F.col("beds").cast("string")
    staged = listings.withColumns(
        {
            "_published": F.try_element_at(profile["published_rents"], beds).cast("double"),
            "_observed": F.try_element_at(profile["observed_rents"], beds).cast("double"),
        }
    ).withColumn("_median", F.coalesce("_published", "_observed"))
    staged = staged.withColumn(
        "_gap", F.when((F.col("_median") > 0) & price.isNotNull(), (price - F.col("_median")) / F.col("_median"))
    )
    parts = {
        "_crime": (CRIME_WEIGHT, clamp(profile["crime_lower_than_pct"] * 100)),
        "_decile": (DECILE_WEIGHT, clamp(profile["income_decile"] * F.lit(10.0))),
        "_rent": (RENT_WEIGHT, piecewise(F.col("_gap"), RENT_VALUE_CURVE)),
    }
    staged = staged.withColumns({name: score for name, (_, score) in parts.items()})
    earned = weight = F.lit(0.0)
    for name, (share, _) in parts.items():
        earned = earned + F.coalesce(F.lit(share) * F.col(name), F.lit(0.0))
        weight = weight + F.when(F.col(name).isNotNull(), F.lit(share)).otherwise(F.lit(0.0))
    staged = staged.withColumns({"_earned": earned, "_weight": weight})
    staged = staged.withColumn("_base", F.when(F.col("_weight") > 0, F.col("_earned") / F.col("_weight")))
    bonus = F.when(F.col("suburb_key").isin(*preferred), F.lit(PREFERRED_BONUS)).otherwise(F.lit(0)) if preferred else F.lit(0)
    return staged.withColumns(
        {
            "suburb_raw": round_half_up(F.col("_base"), 1),
            "suburb_score": round_half_up(clamp(F.col("_base") + bonus)),
            "suburb_excluded": F.when(profile.isNull(), F.lit("no_suburb_profile")).when(
                F.col("_base").isNull(), F.lit("incomplete_suburb_profile")
            ),
            "suburb_source": F.when(
                F.col("_gap").isNotNull(),
                F.when(F.col("_published").isNotNull(), F.lit("rents:published")).otherwise(F.lit("rents:observed")),
            ),
        }
    ).drop("_published", "_observed", "_median", "_gap", *parts, "_earned", "_weight", "_base")


def dealbreakers(rules: Dealbreakers, commute: Column) -> Column:
    """Fired rules in fixed order. Missing data never fires one."""
    fired = {
        "rent_above_hard_cap": F.col("price_pw") > rules.hard_cap_pw,
        "too_few_beds": F.col("beds") < rules.min_beds,
        "too_few_baths": F.col("baths") < rules.min_baths,
        "no_car_space": F.lit(rules.require_car_space) & (F.col("car_spaces") < 1),
        "commute_too_long": commute > rules.max_commute_minutes,
    }
    return F.array_compact(F.array(*[F.when(fired[name], F.lit(name)) for name in DEALBREAKERS]))


def score_listings(listings: DataFrame, scoring: Scoring) -> DataFrame:
    """Add ``scores{composite, confidence, dealbreakers, factors{raw, score, excluded, source}}``.

    Reads price_pw, beds, baths, car_spaces, area_sqm, suburb_key, enrichment and profile.
    """
    curves, weights = scoring.curves, scoring.weights
    enrichment = F.col("enrichment")
    places, drive = enrichment["walkability"], enrichment["commute"]["drive"]
    area, beds = F.col("area_sqm"), F.col("beds")
    kinds = {f"walk_{kind}": places[kind] for kind in POI_KINDS}

    raws = {
        "price": F.col("price_pw").cast("double"),
        "space": F.when(area.isNotNull() & (beds >= 1), round_half_up(area / beds, 1)),
        "car_space": F.col("car_spaces").cast("double"),
        "commute": commute_minutes(enrichment["commute"]),
        "drive": F.when(drive["status"] != "unavailable", drive["minutes"]),
        **{name: place_raw(place) for name, place in kinds.items()},
    }
    staged = with_suburb_factor(listings, scoring.preferred_suburbs).withColumns(
        {f"_{name}_raw": raw for name, raw in raws.items()}
    )

    def raw(name: str) -> Column:
        return F.col(f"_{name}_raw")

    scores = {name: piecewise(raw(name), curves[name]) for name in ("price", "space", "commute", "drive")}
    scores["car_space"] = F.when(raw("car_space") > 0, F.lit(100.0)).otherwise(F.lit(0.0))
    for name, place in kinds.items():
        scores[name] = place_score(place, raw(name), curves[name], NO_GYM_SCORE if name == "walk_gym" else 0)
    staged = staged.withColumns(
        {**{f"_{name}_score": round_half_up(s) for name, s in scores.items()}, "_suburb_score": F.col("suburb_score")}
    )

    def score(name: str) -> Column:
        return F.col(f"_{name}_score")

    earned = included = F.lit(0.0)
    for key in FACTOR_KEYS:
        weight = F.lit(float(weights[key]))
        earned = earned + F.coalesce(weight * score(key), F.lit(0.0))
        included = included + F.when(score(key).isNotNull(), weight).otherwise(F.lit(0.0))
    staged = staged.withColumns({"_earned": earned, "_included": included})

    unknown = {
        "price": F.when(raw("price").isNull(), F.lit("missing_price")),
        "space": F.when(area.isNull(), F.lit("missing_sqm")).when(beds < 1, F.lit("unknown_beds")),
        "car_space": F.lit(None).cast("string"),
        **{name: F.when(score(name).isNull(), F.lit("provider_unavailable")) for name in ("commute", "drive", *kinds)},
        "suburb": F.col("suburb_excluded"),
    }
    shown = {name: raw(name) for name in raws}
    shown["space"] = F.coalesce(raw("space"), area.cast("double"))
    shown["suburb"] = F.col("suburb_raw")
    sources = {"suburb": F.col("suburb_source")}
    factors = F.struct(
        *[
            F.struct(
                shown[key].alias("raw"), score(key).alias("score"), unknown[key].alias("excluded"),
                sources.get(key, F.lit(None).cast("string")).alias("source"),
            ).alias(key)
            for key in FACTOR_KEYS
        ]
    )
    total = float(sum(weights[key] for key in FACTOR_KEYS))
    included = F.col("_included")
    composite = F.when(included > 0, round_half_up(F.col("_earned") / included, 1)).otherwise(F.lit(0.0))
    confidence = round_half_up(included / F.lit(total), 2) if total else F.lit(0.0)
    helpers = [c for c in staged.columns if c not in listings.columns]
    return staged.withColumn(
        "scores",
        F.struct(
            composite.alias("composite"),
            confidence.alias("confidence"),
            dealbreakers(scoring.dealbreakers, raw("commute")).alias("dealbreakers"),
            factors.alias("factors"),
        ),
    ).drop(*helpers)


def ranked(listings: DataFrame) -> DataFrame:
    """Best composite first, then cheapest (unpriced last), then id."""
    return listings.orderBy(
        F.col("scores.composite").desc(), F.col("price_pw").asc_nulls_last(), F.col("listing_id").asc()
    )
