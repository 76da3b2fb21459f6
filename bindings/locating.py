"""Queries over positions: nearest POIs, grid cells, suburbs, the envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.functions.numbers import round_half_up, whole
from listingflow.operators import nearest as N
from listingflow.operators import places as P
from listingflow.sources import pois as S

from .scoring import listings
from .settings import WALKING
from .sqltext import hav, rnd
from .views import table, view, with_views


def poi_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_poi")


def nearest_poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_listing").select("listing_id", "lat", "lon")
    return N.nearest_pois(rows, poi_rows(spark, sf_dir), WALKING.poi_radius_m).select(
        "listing_id", "kind", "is_major_chain", "osm_id", "name", whole(F.col("distance_m")).alias("distance_m")
    )


def walkability(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_listing").select("listing_id", "lat", "lon")
    w = N.walkability(rows, poi_rows(spark, sf_dir), WALKING)
    columns = [
        F.col(f"walkability.{kind}.{name}").alias(f"{kind}_{name}")
        for kind in ("cafe", "supermarket", "gym") for name in ("status", "source", "name", "walk_minutes", "distance_m")
    ]
    return w.select("listing_id", *columns, F.col("walkability.supermarket.is_major_chain").alias("is_major_chain"))


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = N.request_cells(view(spark, sf_dir, "v_listing"), WALKING.poi_radius_m)
    return cells.select(
        "cell_lat", "cell_lon", "listings",
        *[round_half_up(F.col(side), 6).alias(side) for side in ("south", "west", "north", "east")],
    )


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as map elements; the same element can arrive from several tiles."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    tags = [
        ("amenity", F.when(size % 5 == 0, F.lit("cafe")).when(size % 5 == 1, F.lit("gym")).when(size % 5 == 2, F.lit("pub"))),
        ("shop", F.when(size % 7 == 0, F.lit("supermarket"))),
        ("leisure", F.when(size % 11 == 0, F.lit("fitness_centre"))),
        ("name", F.when(F.col("p_partkey") % 6 == 1, F.concat(F.lit("Coles "), "p_name")).when(F.col("p_partkey") % 6 == 2, F.concat(F.lit("anytime fitness "), "p_name"))
         .when(F.col("p_partkey") % 6 == 3, F.lit("  ")).when(F.col("p_partkey") % 6 > 3, F.col("p_name"))),
    ]
    point = F.struct((F.lit(-33.9) + size / 1000).alias("lat"), (F.lit(151.1) + size / 1000).alias("lon"))
    return p.select(
        F.col("p_partkey").alias("tile_pos"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("node")).otherwise(F.lit("way")).alias("type"),
        (F.col("p_partkey") % 100).alias("id"),
        F.when(F.col("p_partkey") % 3 == 0, point["lat"]).alias("lat"), F.when(F.col("p_partkey") % 3 == 0, point["lon"]).alias("lon"),
        F.when(F.col("p_partkey") % 3 == 1, point).alias("center"),
        F.map_from_entries(F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("k"), v.alias("v"))) for k, v in tags]))).alias("tags"),
    )


def poi_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.admit_pois(elements(spark, sf_dir))


def distinct_pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.distinct_pois(S.admit_pois(elements(spark, sf_dir)), "tile_pos").select("osm_id", "kind", "name", "is_major_chain", "lat", "lon")


def observed_rents(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.observed_rents(view(spark, sf_dir, "v_listing"), "2024-02-01a", "2024-02-01T00:00:00Z")

    def text(name: str):
        return F.array_join(F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")

    return out.select("suburb_key", text("median_pw_by_beds").alias("medians"), text("sample_by_beds").alias("samples"), "considered", "run_id")


def part_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians by brand and size: most buckets miss the sample."""
    rows = table(spark, sf_dir, "part").select("p_brand", "p_size", (F.col("p_partkey") * 7 % 997 + 100).cast("int").alias("price_pw"))
    return P.observed_medians(rows, ["p_brand", "p_size"])


def place_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    place = view(spark, sf_dir, "v_place")
    gaz = view(spark, sf_dir, "v_profile").select("suburb_key", F.lit(-30.0).alias("lat"), F.lit(150.0).alias("lon"))
    # Listings of precincts carry no position, so the later sources have to answer for them.
    rows = view(spark, sf_dir, "v_listing").join(place.select("suburb_key", "kind"), "suburb_key").withColumns(
        {c: F.when(F.col("kind") != "precinct", F.col(c)) for c in ("lat", "lon")}
    )
    envelope = place.filter("transit_minutes is not null").select("suburb_key", "lat", "lon")
    return rows, envelope, gaz


def place_suburbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = P.place_suburbs(*place_frames(spark, sf_dir))
    return placed.select("suburb_key", *[round_half_up(F.col(c), 4).alias(c) for c in ("lat", "lon")], "source")


def new_suburbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, envelope, _ = place_frames(spark, sf_dir)
    nowhere = envelope.filter("lat > 0")
    out = P.new_suburbs(rows, view(spark, sf_dir, "v_profile"), envelope, nowhere)
    return out.select("suburb_key", "name", "postcode", "listings", "source", "placeable")


def centroid_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = view(spark, sf_dir, "v_profile").select("suburb_key", "lat", "lon")
    envelope = view(spark, sf_dir, "v_place").select("suburb_key", "lat", "lon")
    fixes = P.centroid_corrections(profiles, envelope)
    settled = P.centroid_corrections(P.realigned(profiles, fixes), envelope).agg(F.count("*")).scalar()
    return fixes.select("suburb_key", whole(F.col("metres")).alias("metres"), "to_lat", "to_lon", settled.alias("left_after"))


def places_with_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_place").withColumn(
        "indicative_minutes",
        F.when(F.col("transit_minutes").isNotNull(), F.create_map(F.lit("office:transit"), F.col("transit_minutes")))
        .otherwise(F.create_map().cast("map<string,double>")),
    ).drop("transit_minutes", "walk_minutes")


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = P.envelope(places_with_minutes(spark, sf_dir), -33.8675, 151.2045, "office:transit", 45, keep_unmeasured_km=12)
    tagged = P.tagged_places(kept, "office")
    return tagged.select("canonical", "kind", F.try_element_at("indicative_minutes", F.lit("office:transit")).alias("minutes"),
                         F.try_element_at("km_from", F.lit("office")).alias("km"))


def envelope_by_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = P.envelope(places_with_minutes(spark, sf_dir), -33.8675, 151.2045, "office:transit", None, 10)
    return kept.select("canonical", round_half_up(F.col("km"), 2).alias("km"))


def envelope_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifteen nearest places of the envelope."""
    kept = P.envelope(places_with_minutes(spark, sf_dir), -33.8675, 151.2045, "office:transit", 45, keep_unmeasured_km=12)
    return kept.limit(15).select("canonical", "minutes")


def enumerated_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' nations as suggestions: many duplicates, some of the wrong kind or postcode."""
    s = table(spark, sf_dir, "supplier").join(view(spark, sf_dir, "v_place"), F.col("s_nationkey") == F.col("nationkey"))
    found = s.select(
        "name", "state", "postcode", F.col("s_suppkey").alias("asked_pos"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit("region")).when(F.col("s_suppkey") % 4 == 1, F.lit("precinct")).otherwise(F.lit("suburb")).alias("kind"),
        F.when(F.col("s_suppkey") % 5 == 0, F.lit("2999")).otherwise(F.col("postcode")).alias("asked_postcode"),
    )
    return P.distinct_places(found, 2000, 2020).select("canonical", "kind", "postcode")


def postcode_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = view(spark, sf_dir, "v_place")
    gaz = place.select("canonical", "postcode", "kind").unionByName(
        place.select(F.concat(F.lit("Upper "), "canonical").alias("canonical"), "postcode", F.lit("suburb").alias("kind"))
    )
    configured = place.filter("transit_minutes is not null").select(F.lower("canonical").alias("canonical"))
    return P.postcode_gaps(gaz, configured)


def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers stand for places: nations with several suppliers claim one key several times."""
    s = table(spark, sf_dir, "supplier").join(view(spark, sf_dir, "v_place"), F.col("s_nationkey") == F.col("nationkey"))
    return P.repeated_keys(P.with_suburb_key(s.drop("suburb_key")))


QUERIES = {
    "nearest_poi": nearest_poi, "walkability": walkability, "grid_cells": grid_cells, "poi_admission": poi_admission,
    "distinct_pois": distinct_pois, "observed_rents": observed_rents, "part_medians": part_medians,
    "place_suburbs": place_suburbs, "new_suburbs": new_suburbs, "centroid_corrections": centroid_corrections,
    "envelope": envelope, "envelope_by_km": envelope_by_km, "envelope_nearest": envelope_nearest, "enumerated_places": enumerated_places,
    "postcode_gaps": postcode_gaps, "repeated_suburb_keys": repeated_keys,
}

_NEAR = f"""
pts as (select distinct lat, lon from v_listing where lat is not null),
pair as (select pts.lat, pts.lon, p.kind, p.is_major_chain, p.osm_id, p.name, {hav('pts.lat', 'pts.lon', 'p.lat', 'p.lon')} as m from pts, v_poi p),
best as (select lat, lon, kind, is_major_chain, min(m) as m, arg_min(osm_id, (m, osm_id)) as osm_id, arg_min(name, (m, osm_id)) as name from pair where m <= 1200 group by all)
"""
_KIND = """{k} as (select lat, lon, arg_min(name, (not is_major_chain, m)) as name, arg_min(m, (not is_major_chain, m)) as m, arg_min(is_major_chain, (not is_major_chain, m)) as chain from best where kind = '{k}' group by lat, lon)"""
_BLOCK = "case when l.lat is null then 'unavailable' when {k}.m is null then 'none_found' else 'ok' end as {k}_status, case when l.lat is not null then 'overpass+detour' end as {k}_source, {k}.name as {k}_name, {minutes} as {k}_walk_minutes, cast(floor({k}.m + 0.5::double) as int) as {k}_distance_m"
_ELEMENT = """
el as (select *, p_partkey as tile_pos, case when p_partkey % 3 = 0 then 'node' else 'way' end || '/' || (p_partkey % 100) as osm_id,
    case when p_size % 5 = 0 then 'cafe' when p_size % 7 = 0 then 'supermarket' when p_size % 11 = 0 or p_size % 5 = 1 then 'gym' when p_partkey % 6 = 2 then 'gym' end as kind,
    case p_partkey % 6 when 1 then 'Coles ' || p_name when 2 then 'anytime fitness ' || p_name when 4 then p_name when 5 then p_name end as name,
    case when p_partkey % 3 < 2 then -33.9::double + p_size / 1000 end as lat, case when p_partkey % 3 < 2 then 151.1::double + p_size / 1000 end as lon from part),
poi as (select tile_pos, kind, osm_id, name, lat, lon, kind = 'supermarket' and coalesce(name like 'Coles %', false) as is_major_chain from el where kind is not null and lat is not null and (name is not null or kind = 'gym'))
"""
_KM = hav("-33.8675::double", "151.2045::double", "lat", "lon") + " / 1000.0::double"

ORACLES = {
    "nearest_poi": with_views(["v_listing", "v_poi"], f"with {_NEAR} select listing_id, kind, is_major_chain, osm_id, name, cast(floor(m + 0.5::double) as int) as distance_m from v_listing join best using (lat, lon)"),
    "walkability": with_views(
        ["v_listing", "v_poi"],
        f"with {_NEAR}, " + ", ".join(_KIND.format(k=k) for k in ("cafe", "supermarket", "gym")) + " select listing_id, "
        + ", ".join(_BLOCK.format(k=k, minutes=rnd(f"{k}.m * 1.35::double / 80.0::double", 1)) for k in ("cafe", "supermarket", "gym"))
        + ", supermarket.chain as is_major_chain from v_listing l " + " ".join(f"left join {k} on l.lat = {k}.lat and l.lon = {k}.lon" for k in ("cafe", "supermarket", "gym")),
    ),
    "grid_cells": with_views(
        ["v_listing"],
        f"""with c as (select cast(floor(lat / 0.05::double) as bigint) as cell_lat, cast(floor(lon / 0.05::double) as bigint) as cell_lon, count(*) as listings from v_listing where lat is not null group by 1, 2),
        s as (select *, cell_lat * 0.05::double as s, cell_lon * 0.05::double as w, 1200 / 111000.0::double as m from c)
        select cell_lat, cell_lon, listings, {rnd('s - m', 6)} as south, {rnd('w - m / cos(radians(s))', 6)} as west, {rnd('s + 0.05::double + m', 6)} as north, {rnd('w + 0.05::double + m / cos(radians(s))', 6)} as east from s""",
    ),
    "poi_admission": f"with {_ELEMENT} select * from poi",
    "distinct_pois": f"with {_ELEMENT} select osm_id, " + ", ".join(f"arg_max_null({c}, tile_pos) as {c}" for c in ("kind", "name", "is_major_chain", "lat", "lon")) + " from poi group by osm_id",
    "observed_rents": with_views(
        ["v_listing"],
        f"""with b as (select suburb_key, beds, cast({rnd('median(price_pw)')} as int) as m, count(*) as n from v_listing where price_pw > 0 group by 1, 2 having count(*) >= 5)
        select suburb_key, string_agg(beds || ':' || m, ',' order by beds) as medians, string_agg(beds || ':' || n, ',' order by beds) as samples,
        (select count(*) from v_listing l where l.suburb_key = b.suburb_key and price_pw > 0) as considered, '2024-02-01a' as run_id from b group by suburb_key""",
    ),
    "part_medians": f"select p_brand, p_size, cast({rnd('median(cast(p_partkey * 7 % 997 + 100 as int))')} as int) as median_pw, count(*) as sample from part group by 1, 2 having count(*) >= 5",
    "place_suburbs": with_views(
        ["v_listing", "v_place", "v_profile"],
        f"""with l as (select v.suburb_key, avg(v.lat) as lat, avg(v.lon) as lon from v_listing v join v_place p using (suburb_key) where p.kind <> 'precinct' and v.lat is not null group by 1)
        select k.suburb_key, {rnd("case when l.lat is not null then round(l.lat, 6) when p.transit_minutes is not null then p.lat when g.suburb_key is not null then -30.0::double end", 4)} as lat,
        {rnd("case when l.lat is not null then round(l.lon, 6) when p.transit_minutes is not null then p.lon when g.suburb_key is not null then 150.0::double end", 4)} as lon,
        case when l.lat is not null then 'listings' when p.transit_minutes is not null then 'envelope' when g.suburb_key is not null then 'gazetteer' end as source
        from (select distinct suburb_key from v_listing) k left join l using (suburb_key) left join v_place p on p.suburb_key = k.suburb_key left join v_profile g on g.suburb_key = k.suburb_key""",
    ),
    "new_suburbs": with_views(
        ["v_listing", "v_place", "v_profile"],
        """select p.suburb_key, p.name, p.postcode, count(*) as listings, case when p.kind <> 'precinct' and count(l.lat) > 0 then 'listings' when p.transit_minutes is not null then 'envelope' end as source,
        (p.kind <> 'precinct' and count(l.lat) > 0) or p.transit_minutes is not null as placeable
        from v_listing l join v_place p using (suburb_key) where p.suburb_key not in (select suburb_key from v_profile) group by p.suburb_key, p.name, p.postcode, p.kind, p.transit_minutes""",
    ),
    "centroid_corrections": with_views(
        ["v_place", "v_profile"],
        f"""with d as (select p.suburb_key, e.lat as to_lat, e.lon as to_lon, {hav('p.lat', 'p.lon', 'e.lat', 'e.lon')} as m from v_profile p join v_place e using (suburb_key))
        select suburb_key, cast(floor(m + 0.5::double) as int) as metres, to_lat, to_lon, 0::bigint as left_after from d where m > 1""",
    ),
    "envelope": with_views(["v_place"], f"with d as (select *, {_KM} as km from v_place) select canonical, kind, transit_minutes as minutes, {rnd('km', 2)} as km from d where case when transit_minutes is null then km <= 12 else transit_minutes <= 45 end"),
    "envelope_by_km": with_views(["v_place"], f"with d as (select *, {_KM} as km from v_place) select canonical, {rnd('km', 2)} as km from d where km <= 10"),
    "envelope_nearest": with_views(
        ["v_place"],
        f"with d as (select *, {_KM} as km from v_place) select canonical, transit_minutes as minutes from d where case when transit_minutes is null then km <= 12 else transit_minutes <= 45 end order by transit_minutes nulls last, km limit 15",
    ),
    "enumerated_places": with_views(
        ["v_place"],
        """select canonical, arg_min(case when s_suppkey % 4 = 1 then 'precinct' else 'suburb' end, s_suppkey) as kind, postcode from supplier join v_place on s_nationkey = nationkey
        where s_suppkey % 4 <> 0 and s_suppkey % 5 <> 0 and postcode between '2000' and '2020' group by canonical, postcode""",
    ),
    "postcode_gaps": with_views(["v_place"], "select postcode, count(*) * 2 as places, count(*) as in_envelope, count(*) as missing from v_place where transit_minutes is not null group by postcode"),
    "repeated_suburb_keys": with_views(["v_place"], "select suburb_key, count(*) as places from supplier join v_place on s_nationkey = nationkey group by 1 having count(*) > 1"),
}
