"""Queries over memo tables: positions, routes, freshness, addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.config import POI_KINDS
from listingflow.functions import clock, text
from listingflow.functions.geo import route_key
from listingflow.operators import lookups as K
from listingflow.operators import travel as V
from listingflow.schemas import CACHED_WALKABILITY
from listingflow.sources import caches

from .sqltext import rnd
from .travelling import _coord
from .views import VIEWS, table, view, with_views

NOW_MS = 1_707_091_200_000  # 2024-02-05T00:00:00Z
NOW_SQL = f"{NOW_MS}"

VIEWS["v_position"] = """
select case when user_id % 6 = 0 then 'locality|' else '' end || cast(1 + user_id % 90 as string) || ' nation st, nation_' || cast(user_id % 25 as string) || ', nsw '
  || cast(2000 + user_id % 25 as string) as key, min(user_id) as user_id, min(value) as lat, max(value) as lng,
  case min(user_id) % 3 when 0 then 'google' when 1 then 'osm' else null end as src,
  case when min(user_id) % 7 = 0 then null else 1704067200000 + cast(floor(max(value)) as bigint) * 86400000 / 12 end as at_ms
from {v_event}
group by case when user_id % 6 = 0 then 'locality|' else '' end || cast(1 + user_id % 90 as string) || ' nation st, nation_' || cast(user_id % 25 as string) || ', nsw '
  || cast(2000 + user_id % 25 as string)
"""
VIEWS["v_route_customer"] = """
select (c_custkey * 37) % 1000 as a, (c_custkey * 91) % 1000 as b, min(c_acctbal) as low, max(c_acctbal) as high,
  case when max(c_acctbal) > 2000 then 'walk' else 'drive' end as mode
from {customer} group by (c_custkey * 37) % 1000, (c_custkey * 91) % 1000
"""


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = view(spark, sf_dir, "v_position")
    return v.select("key", "lat", "lng", F.lit("building").alias("precision"), "src", F.floor("at_ms").cast("bigint").alias("at"))


def now_ms():
    return F.lit(NOW_MS)


def cache_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caches.cache_expiry(positions(spark, sf_dir), now_ms())


def cache_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.licensed_share(positions(spark, sf_dir))


def cache_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_capture").select(F.lower(F.trim("address")).alias("key"), F.when(F.col("k") == 13, F.lit("{")).alias("broken"))
    return caches.table_health(rows, "key", "broken")


def cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every capture row with its building's position."""
    rows = view(spark, sf_dir, "v_capture").select("row_pos", "address")
    return K.look_up_buildings(rows, positions(spark, sf_dir), now_ms()).select(
        "row_pos", "building", "lat", "lng", "source", "cached"
    )


def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct addresses nothing could place, after a geocoder answered for some."""
    queries = view(spark, sf_dir, "v_capture").select(F.col("listing_id").alias("id"), F.col("address").alias("query")).distinct()
    answers = view(spark, sf_dir, "v_capture").filter("k = 77").select(F.lower("address").alias("key")).distinct().select(
        "key", F.lit(1.0).alias("lat"), F.lit(2.0).alias("lng"), F.lit("street").alias("precision"), F.lit("osm").alias("source")
    )
    found = K.look_up_positions(queries, positions(spark, sf_dir), now_ms(), answers=answers)
    return found.select("id", "query", "lat", "lng", "source", "cached")


def locality_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same addresses asked as localities: only the namespaced entries may answer."""
    queries = view(spark, sf_dir, "v_capture").select(F.col("listing_id").alias("id"), F.col("address").alias("query")).distinct()
    found = K.look_up_positions(queries, positions(spark, sf_dir), now_ms(), locality=True)
    return found.filter("cached").select("id", "query", "lat", "lng", "source")


def resolve_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, "v_event")
    queries = e.select(
        F.col("event_id").alias("id"),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit(" -33."), F.col("k").cast("string"), F.lit(" , 151.2")))
        .when(F.col("k") % 3 == 1, F.concat((F.col("k") + 20).cast("string"), F.lit(",181")))
        .otherwise(F.concat((F.lit(1) + F.col("user_id") % 90).cast("string"), F.lit(" Nation St, NATION_"), (F.col("user_id") % 25).cast("string"),
                            F.lit(", NSW "), (F.lit(2000) + F.col("user_id") % 25).cast("string"))).alias("query"),
    )
    return K.resolve_origins(queries, positions(spark, sf_dir), now_ms()).select("id", "lat", "lng", "precision", "source")


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_listing").select("listing_id", "lat", "lon")
    keyed = K.with_route_key(rows, F.lit("walk"), F.lit(-33.8675), F.lit(151.2045))
    return keyed.withColumn("route_key", F.when(F.col("lat").isNotNull(), F.col("route_key")))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = view(spark, sf_dir, "v_route_customer")
    lat, lon = F.lit(-33.9) + F.col("a") / 10000, F.lit(151.1) + F.col("b") / 10000
    return v.select(
        route_key(F.col("mode"), F.lit(-33.8675), F.lit(151.2045), lat, lon).alias("key"),
        (F.col("low") / 77).alias("minutes"), (F.col("high") / 999).alias("km"),
    )


def route_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = K.look_up_routes(located(spark, sf_dir), routes(spark, sf_dir))
    return hit.select("listing_id", F.col("travel.minutes").alias("minutes"), F.col("travel.km").alias("km"))


def route_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.missing_routes(located(spark, sf_dir), routes(spark, sf_dir))


def stale_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per listing: is its walkability cache fresh, does its route or journey need measuring."""
    rows = view(spark, sf_dir, "v_listing").withColumns(
        {
            "address": F.concat(F.lit("addr "), (F.col("id") % 10).cast("string")),
            "cached": F.when(F.col("id") % 3 != 0, F.struct(F.concat(F.lit("addr "), (F.col("id") % 20).cast("string")).alias("address"))),
            "composition": F.when(F.col("id") % 4 == 0, F.lit("legs")),
            "walkability": F.when(
                F.col("id") % 5 != 0,
                F.struct(
                    F.lit("2024-02-05T00:00:00Z").alias("computed_at"),
                    F.when(F.col("id") % 2 == 0, F.lit("abc")).otherwise(F.lit("def")).alias("config_hash"),
                    (F.col("lat") + (F.col("id") % 9) / 10000).alias("lat"), F.col("lon").alias("lon"),
                    *[F.lit(None).alias(kind) for kind in POI_KINDS],
                ),
            ).cast(f"STRUCT<{CACHED_WALKABILITY}>"),
        }
    )
    parts = [
        V.stale_walkability(rows, "abc").select("listing_id", F.lit("walkability").alias("work")),
        V.stale_routes(rows).select("listing_id", F.lit("route").alias("work")),
        V.unmeasured_journeys(rows).select("listing_id", F.lit("journey").alias("work")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def journey_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limited work list: the first ids that still lack a journey."""
    rows = view(spark, sf_dir, "v_listing").withColumn("composition", F.when(F.col("id") % 4 == 0, F.lit("legs")))
    return V.unmeasured_journeys(rows, limit=25).select("listing_id")


def precision_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs = view(spark, sf_dir, "v_event").select(
        "listing_id", F.col("k").alias("run_pos"), F.col("event_id").alias("key_pos"),
        F.when(F.col("k") % 3 == 0, F.lit("building")).when(F.col("k") % 3 == 1, F.lit("street")).otherwise(F.lit("area")).alias("precision"),
    )
    return V.precision_seen(legs)


def travel_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_listing").withColumn("address", F.col("suburb"))
    measured = rows.filter("walk_minutes is not null").select("listing_id", (F.col("walk_minutes") / 7).alias("minutes"), (F.col("walk_km") / 7).alias("km"))
    known = rows.filter("drive_minutes is not null").select("listing_id", "precision")
    return K.backfill(rows, measured, known, "walk", "2024-02-05T00:00:00Z")


def fold_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_listing")
    old = rows.select("listing_id", F.col("walk_minutes").alias("minutes"))
    new = rows.filter("drive_minutes > 30").select("listing_id", F.col("drive_minutes").alias("minutes"))
    return K.fold_measured(old, new, "minutes")


def arrive_by_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, "v_event")
    groups = e.select(
        F.concat(F.lit("origin-"), F.col("user_id").cast("string")).alias("origin"), "mode",
        F.when(F.col("k") % 3 == 0, F.lit("2026-09-08T09:00:00+10:00")).when(F.col("k") % 3 == 1, F.lit("2026-09-15T09:00:00+10:00")).alias("arrive_by"),
    )
    return V.arrive_by_mismatches(groups, "2026-09-08T09:00:00+10:00")


def arrive_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's instant as "now": the next commute moments, the local day, the first run id."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", clock.arrive_by_moment(F.col("ts"), "Tuesday", "09:00").alias("tuesday"),
        clock.arrive_by_moment(F.col("ts"), "Sunday", "18:30").alias("sunday"),
        clock.iso_seconds(F.col("ts")).alias("iso"), clock.local_date(F.col("ts")).cast("string").alias("local_day"),
        F.element_at(clock.run_id_candidates(F.col("ts")), 3).alias("third_id"),
    )


def probe_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    given = F.when(F.col("event_type") == "error", F.col("ts"))
    return e.select("event_id", clock.probe_moment(given, F.col("ts")).cast("string").alias("probe_utc"))


def next_run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first free id of the last event's local day; every error of that day took an id."""
    from listingflow.sources.runs import next_run_id

    e = table(spark, sf_dir, "events")
    moment = e.agg(F.max("ts").alias("utc_now"))
    taken = e.filter("event_type = 'error'").select(
        F.concat(clock.local_date(F.col("ts")).cast("string"), F.char(F.lit(97) + F.col("event_id") % 3)).alias("run_id")
    ).distinct()
    return next_run_id(moment, taken)


def config_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of a configuration per customer segment office."""
    from listingflow.operators.fingerprint import config_hash as fingerprint

    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("custkey"),
        fingerprint(
            office=F.struct(F.col("c_nationkey").alias("lat"), F.lit(None).cast("int").alias("lon"), F.col("c_name").alias("address")),
            commute=F.struct(F.col("c_mktsegment").alias("day")), walk=F.struct(F.lit(1200).alias("poi_radius_m")),
        ).alias("config_hash"),
    )


def address_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("query_id"), F.col("c_nationkey").alias("n"),
        F.concat(
            (F.col("c_custkey") % 40).cast("string"), F.when(F.col("c_custkey") % 3 == 0, F.lit(" Kent St")).when(F.col("c_custkey") % 3 == 1, F.lit(" Point Rd."))
            .otherwise(F.lit(" Old South Head Road")), F.lit(", Town NSW "), (F.lit(2000) + F.col("c_nationkey")).cast("string"),
        ).alias("address"),
    )


def resolve_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five candidates per customer address, of which some are on the street, in the postcode, at the number."""
    queries = address_queries(spark, sf_dir)
    q = F.col("query_id")
    offered = queries.select("query_id", "n", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("rank"))
    rank = F.col("rank")
    candidates = offered.select(
        "query_id", "rank",
        F.when((q + rank) % 4 == 0, F.lit("Kent Street")).when((q + rank) % 4 == 1, F.lit("Point Road")).when((q + rank) % 4 == 2, F.lit("Head Lane")).alias("street"),
        F.when((q + rank) % 4 == 3, F.lit("Kent Street")).otherwise(F.lit("Point Hotel")).alias("name"),
        ((q + rank) % 2 == 1).alias("is_street"),
        F.when(rank % 2 == 0, (q % 40).cast("string")).otherwise(F.lit("999")).alias("house_number"),
        F.when(rank == 3, F.lit(None).cast("string")).when((q + rank) % 5 == 0, F.lit("9999")).otherwise((F.lit(2000) + F.col("n")).cast("string")).alias("postcode"),
        (q + rank * 0.1).alias("lat"), F.lit(151.0).alias("lon"),
    )
    return K.resolve_addresses(queries.select("query_id", "address"), candidates)


def provider_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    label = F.when(F.col("o_orderstatus") == "F", F.lit("ROOFTOP")).when(F.col("o_orderpriority") == "5-LOW", F.lit("RANGE_INTERPOLATED")).when(
        F.col("o_orderpriority") == "2-HIGH", F.lit("GEOMETRIC_CENTER")).when(F.col("o_orderpriority") == "1-URGENT", F.lit("APPROXIMATE")).otherwise(F.lit("UNHEARD"))
    return o.groupBy(V.provider_precision(label).alias("precision")).agg(F.count("*").alias("addresses"))


def building_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_doc")
    a = F.col("address")
    return rows.select(
        "listing_id", text.building_address(a).alias("building"), text.expand_street_type(a).alias("expanded"),
        text.street_of(a).alias("street"), text.postcode_of(a).alias("postcode"), text.house_number_of(a).alias("number"),
    )


QUERIES = {
    "cache_expiry": cache_expiry, "cache_sources": cache_sources, "cache_health": cache_health, "cache_hits": cache_hits,
    "cache_misses": cache_misses, "locality_lookup": locality_lookup, "resolve_origins": resolve_origins,
    "route_hits": route_hits, "route_misses": route_misses, "stale_work": stale_work, "journey_worklist": journey_worklist,
    "precision_seen": precision_seen, "travel_backfill": travel_backfill, "fold_measured": fold_measured,
    "arrive_by_mismatches": arrive_by_mismatches, "arrive_by": arrive_by, "probe_times": probe_times,
    "next_run_id": next_run_ids, "config_hash": config_hash, "resolve_addresses": resolve_addresses,
    "provider_precision": provider_precision, "building_addresses": building_addresses,
}

_AT = "cast(floor(at_ms) as bigint)"
_EXPIRED = f"(src is not distinct from 'google' and (at_ms is null or {NOW_SQL} - {_AT} > 2592000000))"
_SOON = f"(src is not distinct from 'google' and (at_ms is null or {NOW_SQL} - {_AT} > 23 * 86400000::bigint))"
_USABLE = f"usable as (select key, lat, lng, coalesce(src, 'osm') as source from v_position where not {_EXPIRED})"
_ROUTE = "left join v_route_customer r on lat is not null and (custkey * 37) % 1000 = r.a and (custkey * 91) % 1000 = r.b and r.mode = 'walk'"
_LOCAL = "timezone('Australia/Sydney', timezone('UTC', ts))"


def _moment(weekday: int, at: str) -> str:
    """First such weekday (0 Sunday) two days out or later; January, so daylight saving holds."""
    base = f"(cast({_LOCAL} as date) + 2)"
    return f"strftime({base} + cast(({weekday} - dayofweek({base}) + 7) % 7 as int), '%Y-%m-%d') || 'T{at}:00+11:00'"


_NUM = "cast(query_id % 40 as varchar)"
_ADDR = {
    "building": "case doc_id % 6 when 0 then '50 Frederick St, Sydney, NSW 2000' when 1 then (100 + doc_id % 90) || ' Kent St, Sydney NSW 2000' when 2 then (600 + doc_id % 40) || '-640 George Street, Haymarket, NSW 2000' when 4 then '' else address end",
    "expanded": "case doc_id % 6 when 0 then 'Room ' || (doc_id % 40) || '/50 Frederick Street, Sydney, NSW 2000' when 1 then 'Fully Furnished 3/' || (100 + doc_id % 90) || ' Kent Street, Sydney NSW 2000' when 3 then (1 + doc_id % 90) || 'A Point Road, Pyrmont, NSW 2009' else address end",
    "street": "case doc_id % 6 when 0 then 'room ' || (doc_id % 40) || ' 50 frederick street' when 1 then 'fully furnished 3 ' || (100 + doc_id % 90) || ' kent street' when 2 then 'studio ' || (600 + doc_id % 40) || ' 640 george street' when 3 then 'point road' when 4 then '' else 'nowhere lane' end",
    "postcode": "case when doc_id % 6 in (0, 1, 2) then '2000' when doc_id % 6 = 3 then '2009' end",
    "number": "case doc_id % 6 when 3 then (1 + doc_id % 90) || 'a' when 5 then '12' end",
}

ORACLES = {
    "cache_expiry": with_views(["v_position"], f"select count(*) filter (src is distinct from 'google') as permanent, count(*) filter (src = 'google') as licensed, count(*) filter ({_EXPIRED}) as expired, count(*) filter ({_SOON} and not {_EXPIRED}) as expiring_soon from v_position"),
    "cache_sources": with_views(["v_position"], "select coalesce(src, 'osm') as source, count(*) as positions, count(*) filter (src = 'google') as licensed from v_position group by 1"),
    "cache_health": with_views(["v_capture"], "select count(*) as total, count(*) filter (trim(address) = '') as blank_keys, count(*) filter (k = 13) as unreadable from v_capture"),
    "cache_hits": with_views(["v_capture", "v_position"], f"with {_USABLE} select row_pos, lower(trim(address)) as building, lat, lng, source, case when source is not null then true end as cached from v_capture left join usable on key = lower(trim(address)) and trim(address) <> ''"),
    "cache_misses": with_views(
        ["v_capture", "v_position"],
        f"""with {_USABLE}, q as (select distinct listing_id as id, address as query from v_capture), fresh as (select distinct lower(address) as key from v_capture where k = 77 and trim(address) <> '')
        select id, query, case when u.key is not null then u.lat when f.key is not null then 1.0::double end as lat, case when u.key is not null then u.lng when f.key is not null then 2.0::double end as lng,
        case when u.key is not null then u.source when f.key is not null then 'osm' end as source, case when u.key is not null then true when f.key is not null then false end as cached
        from q left join usable u on u.key = lower(query) left join fresh f on f.key = lower(query)""",
    ),
    "locality_lookup": with_views(["v_capture", "v_position"], f"with {_USABLE}, q as (select distinct listing_id as id, address as query from v_capture) select id, query, lat, lng, source from q join usable u on u.key = 'locality|' || lower(query)"),
    "resolve_origins": with_views(
        ["v_event", "v_position"],
        f"""with {_USABLE}, q as (select event_id as id, k, (1 + user_id % 90) || ' nation st, nation_' || (user_id % 25) || ', nsw ' || (2000 + user_id % 25) as key from v_event)
        select id, case k % 3 when 0 then cast('-33.' || k as double) when 2 then lat end as lat, case k % 3 when 0 then 151.2::double when 2 then lng end as lng,
        case when k % 3 = 0 or (k % 3 = 2 and source is not null) then 'building' end as precision, case k % 3 when 0 then 'given' when 2 then source end as source from q left join usable using (key)""",
    ),
    "route_hits": with_views(["v_listing", "v_route_customer"], f"select listing_id, {rnd('low / 77', 1)} as minutes, {rnd('high / 999', 2)} as km from v_listing {_ROUTE}"),
    "route_misses": with_views(["v_listing", "v_route_customer"], f"select 'walk||-33.8675,151.2045|' || {_coord('lat')} || ',' || {_coord('lon')} as route_key, count(*) as waiting from v_listing {_ROUTE} where lat is not null and r.a is null group by 1"),
    "stale_work": with_views(
        ["v_listing"],
        """select listing_id, 'walkability' as work from v_listing where lat is not null and not (id % 5 <> 0 and id % 2 = 0 and abs(lat + (id % 9) / 10000.0::double - lat) <= 0.0005::double)
        union all select listing_id, 'route' from v_listing where lat is not null and (id % 3 = 0 or id % 10 <> id % 20)
        union all select listing_id, 'journey' from v_listing where lat is not null and id % 4 <> 0""",
    ),
    "journey_worklist": with_views(["v_listing"], "select listing_id from v_listing where lat is not null and id % 4 <> 0 order by listing_id limit 25"),
    "precision_seen": with_views(["v_event"], "select listing_id, arg_min(case k % 3 when 0 then 'building' when 1 then 'street' else 'area' end, (k, event_id)) as precision from v_event group by listing_id"),
    "travel_backfill": with_views(["v_listing"], f"select listing_id, {rnd('walk_minutes / 7', 1)} as minutes, {rnd('walk_km / 7', 2)} as km, 'walk' as mode, case when drive_minutes is not null then precision else 'street' end as precision, '2024-02-05T00:00:00Z' as computed_at, suburb as address, walk_minutes is not null as routed from v_listing where lat is not null"),
    "fold_measured": with_views(["v_listing"], "select listing_id, case when drive_minutes > 30 then drive_minutes else walk_minutes end as minutes from v_listing"),
    "arrive_by_mismatches": with_views(["v_event"], "select 'origin-' || user_id as origin, case when k % 3 = 1 then '2026-09-15T09:00:00+10:00' end as arrive_by from v_event where mode = 'transit' and k % 3 <> 0"),
    "arrive_by": f"select event_id, {_moment(2, '09:00')} as tuesday, {_moment(0, '18:30')} as sunday, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso, strftime({_LOCAL}, '%Y-%m-%d') as local_day, strftime({_LOCAL}, '%Y-%m-%d') || 'c' as third_id from events",
    "probe_times": """
        with c as (select event_id, ts, unnest(range(0, 216)) as h from events),
        hours as (select event_id, date_trunc('hour', ts + interval 2 day) + h * interval 1 hour as moment from c),
        found as (select event_id, min(moment) as moment from hours where hour(timezone('Australia/Sydney', timezone('UTC', moment))) = 9 and dayofweek(timezone('Australia/Sydney', timezone('UTC', moment))) not in (0, 6) group by event_id)
        select event_id, case when event_type = 'error' then rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') else strftime(moment, '%Y-%m-%d %H:%M:%S') end as probe_utc from events join found using (event_id)""",
    "next_run_id": f"""with now as (select max(ts) as ts from events), offered as (select strftime({_LOCAL}, '%Y-%m-%d') || chr(cast(97 + i as int)) as run_id from now, range(0, 26) t(i))
        select min(run_id) as run_id from offered where run_id not in (select strftime({_LOCAL}, '%Y-%m-%d') || chr(cast(97 + event_id % 3 as int)) from events where event_type = 'error')""",
    "config_hash": """select c_custkey as custkey, sha256('{"office":{"lat":' || c_nationkey || ',"lon":null,"address":"' || c_name || '"},"commute_assumption":{"day":"' || c_mktsegment || '"},"walk":{"poi_radius_m":1200}}') as config_hash from customer""",
    "resolve_addresses": """
        with q as (select c_custkey as query_id, c_nationkey as n, unnest(range(0, 5)) as rank from customer),
        c as (select *, case query_id % 3 when 0 then 'kent street' when 1 then 'point road' else 'old south head road' end as want,
            case (query_id + rank) % 4 when 0 then 'kent street' when 1 then 'point road' when 2 then 'head lane' else case when (query_id + rank) % 2 = 1 then 'kent street' end end as cand,
            rank = 3 or (query_id + rank) % 5 <> 0 as area, rank % 2 = 0 as exact from q),
        ok as (select * from c where area and cand is not null and (contains(cand, want) or contains(want, cand) or list_contains(string_split(cand, ' '), string_split(want, ' ')[1])))
        select c_custkey as query_id, arg_min(query_id + rank * 0.1::double, (not exact, rank)) as lat, case when count(ok.rank) > 0 then 151.0::double end as lon,
        case when arg_min(exact, (not exact, rank)) then 'building' when count(ok.rank) > 0 then 'street' end as precision, cast(arg_min(rank, (not exact, rank)) as int) as rank
        from customer left join ok on c_custkey = query_id group by c_custkey""",
    "provider_precision": """select case when o_orderstatus = 'F' then 'building' when o_orderpriority in ('5-LOW', '2-HIGH') then 'street' else 'area' end as precision, count(*) as addresses from orders group by 1""",
    "building_addresses": with_views(["v_doc"], "select listing_id, " + ", ".join(f"{expr} as {name}" for name, expr in _ADDR.items()) + " from v_doc"),
}
