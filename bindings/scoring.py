"""Queries over scores, flags and published entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.config import FACTOR_KEYS
from listingflow.operators import enrichment as E
from listingflow.operators import scoring as S
from listingflow.operators.places import with_profile

from .settings import SCORING, TRAVEL_SOURCE
from .sqltext import curve, joined, rnd
from .views import view, with_views


def travel_map(suffix: str = "") -> Column:
    """The routed times of a ``v_listing`` row as a map."""
    legs = [
        F.when(
            F.col(f"{mode}_minutes").isNotNull(),
            F.struct(
                F.lit(f"office:{mode}").alias("key"),
                F.struct(
                    F.col(f"{mode}_minutes").alias("minutes"), F.col(f"{mode}_km").alias("km"),
                    F.lit(mode).alias("mode"), F.col("precision").alias("precision"),
                ).alias("leg"),
            ),
        )
        for mode in ("walk", "drive", "transit")
    ]
    return F.map_from_entries(F.array_compact(F.array(*legs)))


def place_block(prefix: str, chain: bool = False) -> Column:
    fields = [
        F.col(f"{prefix}_status").alias("status"),
        F.when(F.col(f"{prefix}_status") != "unavailable", F.lit("poi")).alias("source"),
        F.lit(None).cast("string").alias("name"),
        F.col(f"{prefix}_minutes").alias("walk_minutes"),
        F.lit(None).cast("int").alias("distance_m"),
    ]
    if chain:
        fields.append(F.lit(None).cast("boolean").alias("is_major_chain"))
    return F.struct(*fields)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_listing`` in the library's shape."""
    return view(spark, sf_dir, "v_listing").withColumns(
        {
            "travel": travel_map(),
            "walkability": F.struct(
                place_block("cafe").alias("cafe"), place_block("shop", True).alias("supermarket"),
                place_block("gym").alias("gym"),
            ),
            "share_signals": F.when(F.col("is_share"), F.array(F.lit("share_house"))).otherwise(F.array().cast("array<string>")),
            "studio_signals": F.when(F.col("is_studio"), F.array(F.lit("bedsit"))).otherwise(F.array().cast("array<string>")),
        }
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rents(flag: str, base: int, step: int, beds: list[int]) -> Column:
        pairs = [x for b in beds for x in (F.lit(str(b)), F.lit(base + step * b) + F.col("nationkey"))]
        return F.when(F.col(flag), F.create_map(*pairs))

    return view(spark, sf_dir, "v_profile").select(
        "suburb_key", F.col("crime").alias("crime_lower_than_pct"), F.col("decile").alias("income_decile"),
        rents("has_published", 500, 100, [1, 2, 3]).alias("published_rents"),
        rents("has_observed", 450, 90, [0, 1, 2, 3, 4]).alias("observed_rents"),
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.with_enrichment(listings(spark, sf_dir), SCORING.commute_origin, TRAVEL_SOURCE)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.score_listings(with_profile(enriched(spark, sf_dir), profiles(spark, sf_dir)), SCORING)


def score_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = [
        column
        for key in FACTOR_KEYS
        for column in (
            F.col(f"scores.factors.{key}.raw").alias(f"{key}_raw"),
            F.col(f"scores.factors.{key}.score").alias(f"{key}_score"),
            F.col(f"scores.factors.{key}.excluded").alias(f"{key}_excluded"),
        )
    ]
    return S.ranked(scored(spark, sf_dir)).select(
        "listing_id", "price_pw", F.col("scores.composite").alias("composite"),
        F.col("scores.confidence").alias("confidence"),
        F.array_join("scores.dealbreakers", ",").alias("dealbreakers"), *factors,
    )


def score_suburb(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_profile(listings(spark, sf_dir), profiles(spark, sf_dir))
    return S.with_suburb_factor(rows, SCORING.preferred_suburbs).select(
        "listing_id", *[F.col(f"suburb_{name}").alias(name) for name in ("raw", "score", "excluded", "source")]
    )


def dealbreakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = S.commute_minutes(F.col("enrichment.commute"))
    hits = S.dealbreakers(SCORING.dealbreakers, minutes)
    return enriched(spark, sf_dir).select("listing_id", F.explode(hits).alias("rule")).groupBy("rule").agg(
        F.count("*").alias("listings")
    )


def listing_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = E.listing_flags(SCORING.target_price_pw, F.col("enrichment"), F.col("photo_count"))
    partial = E.listing_flags(SCORING.target_price_pw)
    return enriched(spark, sf_dir).select(
        "listing_id", F.array_join(full, ",").alias("flags"), F.array_join(partial, ",").alias("early_flags"),
        F.array_join(E.unanswered(F.col("enrichment")), ",").alias("unanswered"),
    )


def commute_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("enrichment.commute")
    return enriched(spark, sf_dir).select(
        "listing_id",
        *[c[mode][name].alias(f"{mode}_{name}") for mode in ("walk", "transit", "drive") for name in ("status", "source", "minutes")],
        c["walk"]["distance_km"].alias("walk_km"), c["drive"]["distance_km"].alias("drive_km"),
        c["transit"]["interchanges"].alias("interchanges"),
    )


def missing_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per walkability-free view of the run: what the note would say when no listing has POIs."""
    bare = E.with_enrichment(
        listings(spark, sf_dir).withColumn("walkability", F.lit(None).cast(
            "struct<cafe:struct<status:string,source:string,name:string,walk_minutes:double,distance_m:int>,"
            "supermarket:struct<status:string,source:string,name:string,walk_minutes:double,distance_m:int,is_major_chain:boolean>,"
            "gym:struct<status:string,source:string,name:string,walk_minutes:double,distance_m:int>>")),
        SCORING.commute_origin, TRAVEL_SOURCE,
    )
    return E.missing_enrichment(bare).select(F.array_join("missing", "|").alias("missing"), "note")


_W, _C = SCORING.weights, SCORING.curves
_STATUS = "case when precision = 'area' then 'fallback' else 'ok' end"


def _poi(prefix: str, c, none_found: int = 0) -> tuple[str, str, str]:
    raw = f"{prefix}_minutes"
    score = f"case when {prefix}_status = 'unavailable' then null when {prefix}_status = 'none_found' then {none_found}::double else {rnd(curve(raw, c))} end"
    return raw, score, f"case when {prefix}_status = 'unavailable' then 'provider_unavailable' end"


_SUBURB = f"""
suburb_parts as (
  select l.*, p.suburb_key is not null as has_profile, p.crime, p.decile,
    case when p.has_published and l.beds between 1 and 3 then (500 + 100 * l.beds + p.nationkey)::double end as pub,
    case when p.has_observed then (450 + 90 * l.beds + p.nationkey)::double end as obs
  from v_listing l left join v_profile p on l.suburb_key = p.suburb_key),
suburb_scores as (
  select *, case when crime is not null then greatest(0, least(100, crime * 100)) end as s1, case when decile is not null then greatest(0, least(100, decile * 10.0::double)) end as s2,
    case when coalesce(pub, obs) > 0 and price_pw is not null then
      {curve("(price_pw - coalesce(pub, obs)) / coalesce(pub, obs)", [(-0.15, 100), (0, 60), (0.15, 20)])} end as s3
  from suburb_parts),
suburb_base as (
  select *, (coalesce(0.4::double * s1, 0) + coalesce(0.3::double * s2, 0) + coalesce(0.3::double * s3, 0)) /
     nullif((0.0::double + case when s1 is not null then 0.4::double else 0.0::double end) + (case when s2 is not null then 0.3::double else 0.0::double end) + (case when s3 is not null then 0.3::double else 0.0::double end), 0) as base
  from suburb_scores),
suburb_factor as (
  select listing_id, {rnd("base", 1)} as suburb_raw,
    {rnd("case when base is not null then greatest(0, least(100, base + case when suburb_key in ('nation-3-2003', 'nation-12-2012') then 8 else 0 end)) end")} as suburb_score,
    case when not has_profile then 'no_suburb_profile' when base is null then 'incomplete_suburb_profile' end as suburb_excluded,
    case when s3 is null then null when pub is not null then 'rents:published' else 'rents:observed' end as suburb_source
  from suburb_base)
"""
_cafe, _shop, _gym = _poi("cafe", _C["walk_cafe"]), _poi("shop", _C["walk_supermarket"]), _poi("gym", _C["walk_gym"], 30)
_FACTORS = f"""
factors as (
  select l.listing_id, price_pw, beds, baths, car_spaces,
    price_pw::double as price_raw, {rnd(curve("price_pw", _C["price"]))} as price_score, case when price_pw is null then 'missing_price' end as price_excluded,
    case when area_sqm is null then null when beds < 1 then area_sqm::double else {rnd("area_sqm::double / beds", 1)} end as space_raw,
    case when area_sqm is not null and beds >= 1 then {rnd(curve(rnd("area_sqm::double / beds", 1), _C["space"]))} end as space_score,
    case when area_sqm is null then 'missing_sqm' when beds < 1 then 'unknown_beds' end as space_excluded,
    car_spaces::double as car_space_raw, case when car_spaces > 0 then 100.0::double else 0.0::double end as car_space_score, null::varchar as car_space_excluded,
    least(walk_minutes, transit_minutes) as commute_raw, {rnd(curve("least(walk_minutes, transit_minutes)", _C["commute"]))} as commute_score,
    case when walk_minutes is null and transit_minutes is null then 'provider_unavailable' end as commute_excluded,
    drive_minutes as drive_raw, {rnd(curve("drive_minutes", _C["drive"]))} as drive_score, case when drive_minutes is null then 'provider_unavailable' end as drive_excluded,
    {_cafe[0]} as walk_cafe_raw, {_cafe[1]} as walk_cafe_score, {_cafe[2]} as walk_cafe_excluded,
    {_shop[0]} as walk_supermarket_raw, {_shop[1]} as walk_supermarket_score, {_shop[2]} as walk_supermarket_excluded,
    {_gym[0]} as walk_gym_raw, {_gym[1]} as walk_gym_score, {_gym[2]} as walk_gym_excluded,
    suburb_raw, suburb_score, suburb_excluded
  from v_listing l join suburb_factor s on l.listing_id = s.listing_id)
"""
_EARNED = " + ".join(f"coalesce({_W[k]} * {k}_score, 0)" for k in FACTOR_KEYS)
_INCLUDED = " + ".join(f"case when {k}_score is null then 0 else {_W[k]} end" for k in FACTOR_KEYS)
_BREAKERS = [
    ("rent_above_hard_cap", "price_pw > 800"), ("too_few_beds", "beds < 1"), ("too_few_baths", "baths < 1"),
    ("no_car_space", "car_spaces < 1"), ("commute_too_long", "commute_raw > 30"),
]
SCORED_CTES = f"{_SUBURB}, {_FACTORS}, scored as (select *, {rnd(f'({_EARNED}) / nullif({_INCLUDED}, 0)', 1)} as composite, {rnd(f'({_INCLUDED}) / 100.0::double', 2)} as confidence, {joined(_BREAKERS)} as dealbreakers from factors)"
_EARLY = [
    ("no_sqm", "area_sqm is null"), ("no_price", "price_pw is null"), ("no_latlon", "lat is null"),
    ("suspiciously_cheap", "price_pw < 325"), ("share_house", "is_share"), ("studio", "is_studio"),
]
UNANSWERED_SQL = [
    ("commute", "walk_minutes is null and transit_minutes is null"), ("cafe", "cafe_status = 'unavailable'"),
    ("supermarket", "shop_status = 'unavailable'"), ("gym", "gym_status = 'unavailable'"),
]
FULL_FLAGS_SQL = [
    *_EARLY[:3],
    ("enrichment_incomplete", " or ".join(f"({c})" for _, c in UNANSWERED_SQL)), ("images_failed", "photo_count = 0"),
    *_EARLY[3:],
]


def _leg(mode: str) -> str:
    known = f"{mode}_minutes is not null"
    return (
        f"case when not ({known}) then 'unavailable' when precision = 'area' then 'fallback' else 'ok' end as {mode}_status, "
        f"case when {known} then 'router' end as {mode}_source, {mode}_minutes"
    )


QUERIES = {
    "score_listings": score_listings,
    "score_suburb": score_suburb,
    "dealbreakers": dealbreakers,
    "listing_flags": listing_flags,
    "commute_blocks": commute_blocks,
    "missing_enrichment": missing_enrichment,
}
ORACLES = {
    "score_listings": with_views(
        ["v_listing", "v_profile"],
        f"with {SCORED_CTES} select listing_id, price_pw, coalesce(composite, 0.0::double) as composite, confidence, dealbreakers, "
        + ", ".join(f"{k}_{s}" for k in FACTOR_KEYS for s in ("raw", "score", "excluded"))
        + " from scored",
    ),
    "score_suburb": with_views(
        ["v_listing", "v_profile"],
        f"with {_SUBURB} select listing_id, suburb_raw as raw, suburb_score as score, suburb_excluded as excluded, suburb_source as source from suburb_factor",
    ),
    "dealbreakers": with_views(
        ["v_listing"],
        " union all ".join(
            f"select '{name}' as rule, count(*) as listings from v_listing where {cond.replace('commute_raw', 'least(walk_minutes, transit_minutes)')} having count(*) > 0"
            for name, cond in _BREAKERS
        ),
    ),
    "listing_flags": with_views(
        ["v_listing"],
        f"select listing_id, {joined(FULL_FLAGS_SQL)} as flags, {joined(_EARLY)} as early_flags, {joined(UNANSWERED_SQL)} as unanswered from v_listing",
    ),
    "commute_blocks": with_views(
        ["v_listing"],
        f"select listing_id, {_leg('walk')}, {_leg('transit')}, {_leg('drive')}, walk_km, drive_km, null::int as interchanges from v_listing",
    ),
    "missing_enrichment": with_views(
        ["v_listing"],
        """select case when bool_or(walk_minutes is not null or transit_minutes is not null) then 'walkability' else 'a routed commute time|walkability' end as missing,
        'No listing in this run has ' || case when bool_or(walk_minutes is not null or transit_minutes is not null) then 'walkability, so the scoring factor that reads it'
          else 'a routed commute time or walkability, so the scoring factors that read them' end
        || ' sat out of every composite and confidence is lower than a fully enriched run''s. Run the enrich stages and replay this run to fill '
        || case when bool_or(walk_minutes is not null or transit_minutes is not null) then 'it in.' else 'them in.' end as note from v_listing""",
    ),
}
