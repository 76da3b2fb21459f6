"""Queries over journeys, travel evidence and distances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.functions import geo
from listingflow.functions.numbers import round_half_up
from listingflow.operators import journeys as J
from listingflow.operators import quality, travel
from listingflow.session import cut_lineage

from .sqltext import hav, rnd
from .views import table, view, with_views

ORDER = [
    "day", "partkey", "suppkey", "linenumber", "quantity", "price", "discount", "tax", "returnflag", "linestatus",
]


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_leg`` in the library's shape; a block is a quarter of a year."""
    return view(spark, sf_dir, "v_leg").select(
        "journey_id", *ORDER, "product_class", "seconds", "departure", "arrival",
        J.leg_metres(F.col("product_class"), F.col("distance_m"), F.col("path_m")).alias("metres"),
        F.floor(F.col("day") / 90).alias("block"),
    )


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.journey_totals(legs(spark, sf_dir), ORDER)


def journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(spark, sf_dir)


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a journey offered for its customer."""
    pairs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("journey_id"), F.col("o_custkey").alias("pair_id"))
    return totals(spark, sf_dir).join(pairs, "journey_id")


def fastest_journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = J.fastest_journeys(offers(spark, sf_dir), ["pair_id"], "journey_id")
    return best.select("pair_id", "journey_id", "walk_metres", round_half_up(F.col("minutes"), 6).alias("minutes"))


def ferry_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.ferry_pairs(offers(spark, sf_dir), ["pair_id"])


def embedded_legs():
    """An embedding as a journey: one leg per component."""
    classes = F.array(*[F.lit(c) for c in (1, 2, 4, 5, 7, 9, 11, 99, 100, 107, 3)])

    def leg(x):
        n = F.floor(F.abs(x.cast("double")) * 1000).cast("int")
        product = F.get(classes, n % 11)
        return F.struct(
            product.alias("product_class"),
            F.when(J.is_walk(product), F.lit(None).cast("string")).otherwise(
                F.when(n % 3 == 0, F.concat(F.lit("F"), (n % 10).cast("string")))
            ).alias("service"),
            (n % 600 / F.lit(10.0)).alias("minutes"),
            (n * F.lit(10.0)).alias("metres"),
        )

    return F.transform("embedding", leg)


def journey_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", embedded_legs().alias("legs"))
    staged = rows.select("vec_id", J.describe(F.col("legs")).alias("description"), J.array_totals(F.col("legs")).alias("t"))
    return staged.select("vec_id", "description", "t.*")


def path_metres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding components taken two by two as coordinates."""
    points = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("embedding") / 2).cast("int") - 1),
        lambda i: F.struct(
            F.get("embedding", i * 2).cast("double").alias("lat"), F.get("embedding", i * 2 + 1).cast("double").alias("lon")
        ),
    )
    staged = table(spark, sf_dir, "embeddings").select("vec_id", points.alias("points"))
    return staged.select("vec_id", F.floor(geo.path_metres(F.col("points")) / 10).cast("bigint").alias("decametres"))


def walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_listing").filter("walk_minutes is not null").select(
        "listing_id", F.col("custkey").alias("pair_id"), F.col("walk_minutes").alias("minutes"), F.col("walk_km").alias("km")
    )


def mislabelled_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return travel.mislabelled_walks(walks(spark, sf_dir), ferry_pairs(spark, sf_dir), ["pair_id"])


def travel_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored facts with planted errors, recomputed from the legs; flags checked both ways."""
    stored = totals(spark, sf_dir).withColumn(
        "minutes", J.retimed_minutes(F.col("walk_metres"), F.col("service_minutes"), F.col("wait_minutes"))
    ).withColumns(
        {
            "ferry_available": F.col("has_ferry") & (F.col("journey_id") % 31 != 0),
            "has_ferry": F.col("has_ferry") | (F.col("journey_id") % 41 == 0),
            "interchanges": F.col("interchanges") + F.when(F.col("journey_id") % 37 == 0, 1).otherwise(0),
            "minutes": F.col("minutes") + F.when(F.col("journey_id") % 43 == 0, 1.0).otherwise(0.1),
            "walk_metres": F.col("walk_metres") + F.when(F.col("journey_id") % 47 == 0, 2.0).otherwise(0.0),
            "is_walk": F.col("is_walk") == (F.col("journey_id") % 53 != 0),
        }
    )
    walked = walks(spark, sf_dir).join(ferry_pairs(spark, sf_dir), "pair_id", "left").withColumn(
        "kmh", geo.implied_speed_kmh(F.col("km"), F.col("minutes"))
    )
    both = F.coalesce((F.col("kmh") >= J.WALK_SUSPECT_KMH) & F.col("ferry_available"), F.lit(False))
    planted = walked.select(
        F.col("listing_id").alias("key"), "kmh", "ferry_available",
        (both != (F.col("pair_id") % 29 == 0)).alias("flagged"),
        F.when(F.col("pair_id") % 27 == 0, 5.0).otherwise(F.lit(J.WALK_SUSPECT_KMH)).alias("threshold_kmh"),
    )
    planted = cut_lineage(planted)  # read by two checks
    parts = [
        quality.composition_checks(stored, legs(spark, sf_dir)),
        quality.flag_checks(planted),
        quality.empty_band(planted),
    ]
    return quality.union_all(parts).groupBy("severity", "rule").agg(
        F.count("*").alias("violations"), F.min("key").alias("first_key")
    )


def merge_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_listing")
    none = F.lit(None).cast("string")
    captured = rows.filter("walk_minutes is not null").select(
        "listing_id", F.lit("office:walk").alias("travel_key"), F.col("walk_minutes").alias("minutes"),
        F.col("walk_km").alias("km"), F.lit("walk").alias("mode"), "precision",
        F.when(F.col("custkey") % 6 == 0, F.lit("legs")).alias("composition"), none.alias("mislabelled"),
    )
    cached = rows.filter("drive_minutes is not null").select(
        "listing_id", F.lit("office:walk").alias("travel_key"), (F.col("drive_minutes") + 1).alias("minutes"),
        F.col("drive_km").alias("km"), F.lit("walk").alias("mode"), F.lit("building").alias("precision"),
        F.when(F.col("custkey") % 2 == 0, F.lit("legs")).alias("composition"),
        F.when(F.col("custkey") % 7 == 0, F.lit("ferry")).alias("mislabelled"),
    )
    return travel.merge_travel(cached, captured)


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_listing").filter("lat is not null")
    office = (F.lit(-33.8675), F.lit(151.2045))
    metres = geo.haversine_m(office[0], office[1], F.col("lat"), F.col("lon"))
    staged = rows.select("listing_id", "lat", "lon", metres.alias("m"), "walk_km", "walk_minutes")
    return staged.select(
        "listing_id", round_half_up(F.col("m")).alias("metres"), geo.walk_minutes(F.col("m"), 1.35, 80.0).alias("walk_minutes"),
        round_half_up(geo.implied_speed_kmh(F.col("walk_km"), F.col("walk_minutes")), 6).alias("kmh"),
        geo.route_key(F.lit("transit"), office[0], office[1], F.col("lat"), F.col("lon"), F.lit("2026-09-08T09:00:00+10:00"), F.lit("planner"))
        .alias("route_key"),
    )


QUERIES = {
    "journeys": journeys, "fastest_journey": fastest_journey, "ferry_pairs": ferry_pairs,
    "journey_descriptions": journey_descriptions, "path_metres": path_metres, "mislabelled_walks": mislabelled_walks,
    "travel_invariants": travel_invariants, "merge_travel": merge_travel, "distances": distances,
}

_O = ", ".join(ORDER)
LEG_CTES = f"""
leg as (select *, product_class in (99, 100) as walk, case when product_class in (99, 100) then coalesce(distance_m, path_m) else path_m end as metres,
    last_value(arrival ignore nulls) over (partition by journey_id order by {_O} rows between unbounded preceding and 1 preceding) as arrived,
    row_number() over (partition by journey_id order by {_O}) as n from v_leg),
journey as (select journey_id, count(*) as legs, {rnd("sum(case when walk then metres else 0 end)")} as walk_metres,
    {rnd("sum(case when walk then 0 else seconds end) / 60.0::double", 1)} as service_minutes,
    {rnd("sum(case when walk then 0 else coalesce(greatest(0, case when departure is not null and arrived is not null then departure - arrived end), 0) end) / 60.0::double", 1)} as wait_minutes,
    coalesce({rnd("(arg_max(coalesce(arrival, -1), n) - arg_min(coalesce(departure, -1), n)) / 60.0::double", 1)}, 0.0::double) as pm,
    arg_max(coalesce(arrival, -1), n) = -1 or arg_min(coalesce(departure, -1), n) = -1 as open_ended,
    count(*) filter (not walk) = 0 as is_walk, bool_or(product_class = 9) as has_ferry, greatest(0, count(*) filter (not walk) - 1) as interchanges,
    {rnd("sum(metres)")} as metres from leg group by journey_id)
"""
_JOURNEY = "journey_id, legs, walk_metres, service_minutes, wait_minutes, case when open_ended then 0.0::double else pm end as provider_minutes, is_walk, has_ferry, interchanges, metres"
_RETIMED = "walk_metres / 1000.0::double / 4.324::double * 60.0::double + service_minutes + wait_minutes"
_PAIRS = f"{LEG_CTES}, offer as (select journey.*, o_custkey as pair_id, {_RETIMED} as minutes from journey join orders on journey_id = o_orderkey)"
_FERRY = "ferry as (select pair_id, bool_or(has_ferry) as ferry_available from offer group by pair_id)"
_KMH = "case when walk_minutes > 0 and walk_km > 0 then walk_km / (walk_minutes / 60.0::double) end"
_N = "cast(floor(abs(x::double) * 1000) as int)"
_LABELS = "case c when 1 then 'train' when 2 then 'metro' when 4 then 'light rail' when 5 then 'bus' when 7 then 'coach' when 9 then 'ferry' when 11 then 'school bus' when 99 then 'walk' when 100 then 'walk' when 107 then 'cycle' else 'class 3' end"


def _coord(name: str) -> str:
    """Five decimals without trailing zeros, as text."""
    return f"rtrim(rtrim(printf('%.5f', floor({name} * 100000.0::double + 0.5::double) / 100000.0::double), '0'), '.')"


ORACLES = {
    "journeys": with_views(["v_leg"], f"with {LEG_CTES} select {_JOURNEY} from journey"),
    "fastest_journey": with_views(
        ["v_leg"],
        f"""with {_PAIRS} select pair_id, arg_min(journey_id, (minutes, journey_id)) as journey_id, arg_min(walk_metres, (minutes, journey_id)) as walk_metres,
        {rnd("min(minutes)", 6)} as minutes from offer group by pair_id""",
    ),
    "ferry_pairs": with_views(["v_leg"], f"with {_PAIRS}, {_FERRY} select * from ferry"),
    "journey_descriptions": f"""
        with part as (select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) as i from embeddings),
        coded as (select vec_id, i, {_N} as n, case {_N} % 11 when 0 then 1 when 1 then 2 when 2 then 4 when 3 then 5 when 4 then 7 when 5 then 9 when 6 then 11
          when 7 then 99 when 8 then 100 when 9 then 107 else 3 end as c from part)
        select vec_id, string_agg(case when c not in (99, 100) and n % 3 = 0 then 'F' || (n % 10) || ' ' else '' end || {_LABELS}, ' · ' order by i) as description,
        {rnd("sum(case when c in (99, 100) then n * 10 else 0 end)")} as walk_metres, {rnd("sum(case when c in (99, 100) then 0 else n % 600 end) / 10.0::double", 1)} as service_minutes,
        count(*) filter (c not in (99, 100)) = 0 as is_walk, bool_or(c = 9) as has_ferry, cast(greatest(0, count(*) filter (c not in (99, 100)) - 1) as int) as interchanges
        from coded group by vec_id""",
    "path_metres": f"""
        with p as (select vec_id, unnest(range(0, len(embedding) // 2)) as i, embedding as e from embeddings),
        xy as (select vec_id, i, e[2 * i + 1]::double as lat, e[2 * i + 2]::double as lon from p),
        hop as (select vec_id, {hav('lat', 'lon', 'lead(lat) over w', 'lead(lon) over w')} as m from xy window w as (partition by vec_id order by i))
        select vec_id, cast(floor(sum(m) / 10) as bigint) as decametres from hop group by vec_id""",
    "mislabelled_walks": with_views(
        ["v_leg", "v_listing"],
        f"""with {_PAIRS}, {_FERRY}, fast as (select listing_id, custkey as pair_id, walk_minutes as minutes, walk_km as km, {_KMH} as kmh from v_listing)
        select listing_id, pair_id, minutes, km, 'ferry' as actually, {rnd("kmh", 2)} as implied_kmh, 4.85::double as threshold_kmh, true as ferry_available
        from fast join ferry using (pair_id) where kmh >= 4.85::double and ferry_available""",
    ),
    "travel_invariants": with_views(
        ["v_leg", "v_listing"],
        f"""with {_PAIRS}, {_FERRY},
        walked as (select listing_id, custkey as pair_id, {_KMH} as kmh, ferry_available from v_listing left join ferry on custkey = pair_id where walk_minutes is not null),
        planted as (select *, coalesce(kmh >= 4.85::double and ferry_available, false) as proven from walked),
        flagged as (select *, proven <> (pair_id % 29 = 0) as flag, case when pair_id % 27 = 0 then 5.0::double else 4.85::double end as threshold from planted),
        bad as (select 'interchanges_disagree' as rule, journey_id::varchar as key from journey where journey_id % 37 = 0
          union all select 'ferry_not_available', journey_id::varchar from journey where (has_ferry and journey_id % 31 = 0) or (not has_ferry and journey_id % 41 = 0)
          union all select 'has_ferry_disagrees', journey_id::varchar from journey where not has_ferry and journey_id % 41 = 0
          union all select 'minutes_do_not_add_up', journey_id::varchar from (select journey_id, abs((walk_metres + case when journey_id % 47 = 0 then 2.0::double else 0 end) / 1000.0::double / 4.324::double * 60.0::double
             + service_minutes + wait_minutes - ({_RETIMED} + case when journey_id % 43 = 0 then 1.0::double else 0.1::double end)) as gap from journey) where gap > 0.15::double
          union all select 'walk_metres_disagree', journey_id::varchar from journey where journey_id % 47 = 0
          union all select 'is_walk_disagrees', journey_id::varchar from journey where journey_id % 53 = 0
          union all select 'flag_without_both_signals', listing_id from flagged where flag and not proven
          union all select 'missed_flag', listing_id from flagged where proven and not flag
          union all select 'other_threshold', listing_id from flagged where flag and threshold <> 4.85::double
          union all select 'threshold_not_in_empty_band', 'walks' from flagged having coalesce(max(kmh) filter (not flag), 0) >= 4.85::double or min(kmh) filter (flag) <= 4.85::double)
        select 'fail' as severity, rule, count(*) as violations, min(key) as first_key from bad group by rule""",
    ),
    "merge_travel": with_views(
        ["v_listing"],
        """with cap as (select listing_id, walk_minutes as minutes, walk_km as km, precision, case when custkey % 6 = 0 then 'legs' end as composition from v_listing where walk_minutes is not null),
        old as (select listing_id, drive_minutes + 1 as minutes, drive_km as km, case when custkey % 2 = 0 then 'legs' end as composition, case when custkey % 7 = 0 then 'ferry' end as mislabelled
          from v_listing where drive_minutes is not null),
        both_sides as (select coalesce(c.listing_id, o.listing_id) as listing_id, c.listing_id is null or (o.listing_id is not null and
            ((o.composition is not null and c.composition is null) or o.mislabelled is not null)) as use_old,
            c.minutes as cm, c.km as ck, c.precision as cp, c.composition as cc, o.minutes as om, o.km as ok, o.composition as oc, o.mislabelled as ol
          from cap c full outer join old o on c.listing_id = o.listing_id)
        select listing_id, 'office:walk' as travel_key, case when use_old then om else cm end as minutes, case when use_old then ok else ck end as km, 'walk' as mode,
        case when use_old then 'building' else cp end as precision, case when use_old then oc else cc end as composition, case when use_old then ol end as mislabelled from both_sides""",
    ),
    "distances": with_views(
        ["v_listing"],
        f"""with d as (select *, {hav('-33.8675::double', '151.2045::double', 'lat', 'lon')} as m from v_listing where lat is not null)
        select listing_id, {rnd("m")} as metres, {rnd("m * 1.35::double / 80.0::double", 1)} as walk_minutes, {rnd(_KMH, 6)} as kmh,
        'transit:planner|2026-09-08T09:00:00+10:00|-33.8675,151.2045|' || {_coord('lat')} || ',' || {_coord('lon')} as route_key from d""",
    ),
}
