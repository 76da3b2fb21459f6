"""Views that give the test tables the shape of listings, captures, journeys, pages and searches.

The text is plain SQL that Spark and DuckDB read alike, so a query and its oracle start from the
same rows. Every view keeps every row or key of its table; hits and misses both occur because some keys are spelled in a
way that the other side does not have (localities, former suburbs, routes of another mode).
"""

from __future__ import annotations

from functools import lru_cache
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

PHRASES = [
    "Fully furnished studio apartment with kitchenette.",
    "Shared kitchen and shared modern bathroom, $250 per room.",
    "Room for rent in a quiet share house, bills included.",
    "A true one bedroom (not a studio) in the heart of it.",
    "The studio-style living area opens to a balcony.",
    "Moments from cafes and a yoga studio.",
    "This spacious studio is fully renovated.",
    "Private room with ensuite, flatmates wanted.",
    "Sunny two bedroom apartment with lounge room.",
    "Communal   kitchen<br/>and laundry&nbsp;facilities.",
    "House consists of 6 rooms, 2 rooms still available.",
    "Studio | 1 Bathroom | Furnished",
    "Bedsitter close to everything, co-living welcome.",
    "Spacious room only, suits single person, $220 per person.",
    "Fully furnished studios in the heart of town &amp; more.",
    "Boarding house with lockable rooms, master room left.",
    "Light filled terrace with shared amenities and courtyard.",
    "No text signal here at all.",
]
PRICES = [
    "$650 per week", "$650 - $700 per week", "$650 pw + $30 parking", "Contact agent", "$2,600 per month",
    "$2,400 pcm ($554 pw)", "From $99", "$480.50 weekly", "", "$31,200 p.a.", "$1,150", "$450",
]
TYPES = [
    "Apartment", "Studio", "House", "Town House", "Villa", "Flat", "Semi-Detached", "Terrace House", "Duplex", "Acreage",
]
SIZES = ["80m²", "1,200 m²", "12.4", "450.6m²", "n/a", "", "house 95 sqm"]


def pick(values: list[str], index: str) -> str:
    """SQL choosing a literal by position."""
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} {arms} end"


VIEWS: dict[str, str] = {}

VIEWS["v_listing"] = """
select o_orderkey as id, cast(o_orderkey as string) as listing_id, o_custkey as custkey, c_nationkey as nationkey,
  case when o_orderkey % 17 = 0 then null else cast(300 + floor(o_totalprice / 5e2) as int) end as price_pw,
  cast(o_orderkey % 5 as int) as beds, cast(1 + o_orderkey % 2 as int) as baths, cast(o_orderkey % 3 as int) as car_spaces,
  case when o_orderkey % 4 = 0 then null else cast(30 + (o_orderkey * 7) % 90 as int) end as area_sqm,
  case o_orderpriority when '1-URGENT' then 'apartment' when '2-HIGH' then 'house' when '3-MEDIUM' then 'unit'
    when '5-LOW' then 'townhouse' else 'other' end as property_type,
  n_name as suburb, cast(2000 + n_nationkey as string) as postcode,
  lower(replace(n_name, '_', '-')) || '-' || cast(2000 + n_nationkey as string) as suburb_key,
  case when o_custkey % 23 = 0 then null else -33.9e0 + ((o_custkey * 37) % 1000) / 1e4 end as lat,
  case when o_custkey % 23 = 0 then null else 151.1e0 + ((o_custkey * 91) % 1000) / 1e4 end as lon,
  case when o_orderkey % 5 = 0 then null else ((o_orderkey * 13) % 600) / 1e1 end as walk_minutes,
  case when o_orderkey % 5 = 0 then null else floor(((o_orderkey * 13) % 600) / 1e1 * (60 + o_orderkey % 50)) / 1e3 end as walk_km,
  case when (o_orderkey + 1) % 5 = 0 then null else ((o_orderkey * 7) % 600) / 1e1 end as drive_minutes,
  case when (o_orderkey + 1) % 5 = 0 then null else floor(((o_orderkey * 7) % 600) / 1e1 * 600) / 1e3 end as drive_km,
  case when (o_orderkey + 2) % 5 = 0 then null else ((o_orderkey * 11) % 600) / 1e1 end as transit_minutes,
  case when (o_orderkey + 2) % 5 = 0 then null else floor(((o_orderkey * 11) % 600) / 1e1 * 500) / 1e3 end as transit_km,
  case o_orderkey % 3 when 0 then 'building' when 1 then 'street' else 'area' end as precision,
  case o_custkey % 5 when 0 then 'unavailable' when 1 then 'none_found' else 'ok' end as cafe_status,
  case when o_custkey % 5 > 1 then ((o_custkey * 3) % 220) / 1e1 end as cafe_minutes,
  case o_custkey % 7 when 0 then 'unavailable' when 1 then 'none_found' else 'ok' end as shop_status,
  case when o_custkey % 7 > 1 then ((o_custkey * 5) % 220) / 1e1 end as shop_minutes,
  case o_custkey % 11 when 0 then 'unavailable' when 1 then 'none_found' else 'ok' end as gym_status,
  case when o_custkey % 11 > 1 then ((o_custkey * 9) % 220) / 1e1 end as gym_minutes,
  o_orderkey % 19 = 0 as is_share, o_orderkey % 13 = 0 as is_studio, cast(o_orderkey % 4 as int) as photo_count,
  o_orderstatus as order_status, o_totalprice as total_price
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
"""

VIEWS["v_profile"] = """
select n_nationkey as nationkey, lower(replace(n_name, '_', '-')) || '-' || cast(2000 + n_nationkey as string)
    || case when r_name = 'MIDDLE EAST' then '-former' else '' end as suburb_key,
  n_name as name, cast(2000 + n_nationkey as string) as postcode,
  case when n_nationkey % 7 = 0 then null else (n_nationkey * 4) / 1e2 end as crime,
  case when n_nationkey % 5 = 0 then null else cast(n_nationkey % 11 as int) end as decile,
  n_nationkey % 3 = 0 as has_published, n_nationkey % 4 <> 0 as has_observed,
  -33.9e0 + n_nationkey / 1e2 + case when n_nationkey % 2 = 0 then 0e0 else n_nationkey / 1e4 end as lat,
  151.1e0 + n_nationkey / 1e2 as lon
from {nation} join {region} on n_regionkey = r_regionkey
"""

VIEWS["v_place"] = """
select n_nationkey as nationkey, n_name || ' NSW ' || cast(2000 + n_nationkey as string) as canonical, n_name as name,
  'NSW' as state, cast(2000 + n_nationkey as string) as postcode,
  lower(replace(n_name, '_', '-')) || '-' || cast(2000 + n_nationkey as string) as suburb_key,
  case when r_name = 'ASIA' then 'precinct' else 'suburb' end as kind,
  -33.9e0 + n_nationkey / 1e2 as lat, 151.1e0 + n_nationkey / 1e2 as lon, cast(n_nationkey as int) as location_pos,
  case when n_nationkey % 6 = 0 then null else cast(n_nationkey * 3 as double) end as transit_minutes,
  case when n_nationkey % 4 = 0 then null else cast(n_nationkey * 9 as double) end as walk_minutes,
  case when n_nationkey % 5 = 0 then null else n_nationkey * 15 / 1e1 end as office_km
from {nation} join {region} on n_regionkey = r_regionkey
"""

VIEWS["v_poi"] = """
select 'node/' || cast(s_suppkey as string) as osm_id, s_name as name,
  case s_suppkey % 3 when 0 then 'cafe' when 1 then 'supermarket' else 'gym' end as kind,
  s_suppkey % 3 = 1 and s_suppkey % 2 = 1 as is_major_chain,
  -33.9e0 + ((s_suppkey * 53) % 1000) / 1e4 as lat, 151.1e0 + ((s_suppkey * 29) % 1000) / 1e4 as lon
from {supplier}
"""

VIEWS["v_event"] = """
select event_id, user_id, cast(user_id as string) as listing_id, event_type, value, ts,
  cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
  case event_type when 'view' then 'drive' when 'purchase' then 'transit' else 'walk' end as mode
from {events}
"""

VIEWS["v_capture"] = """
select case mode when 'walk' then 0 when 'drive' then 1 else 2 end as group_pos, cast(event_id as bigint) as row_pos,
  'office:' || mode as travel_key, mode, listing_id,
  case when event_type = 'signup' then ' ' else
    cast(1 + user_id % 90 as string) || ' Nation St, NATION_' || cast(user_id % 25 as string) || ', NSW '
    || cast(2000 + user_id % 25 as string) end as address,
  'https://example.com/' || listing_id as url,
  '$' || cast(cast(300 + floor(value * 10) as int) as string) || ' per week' as price,
  cast(k % 5 as int) as bedrooms,
  case when k % 10 = 0 then null else ((event_id * 7) % 600) / 1e1 end as minutes,
  case when k % 10 = 0 then null else ((event_id * 7) % 600) / 1e2 end as km,
  case k % 3 when 0 then 'building' when 1 then 'street' else 'area' end as precision, k, user_id
from {v_event} where event_type <> 'error'
"""

VIEWS["v_rejection"] = """
select case when k % 3 = 0 then 0 when k % 3 = 1 then 1 else 2 end as group_pos, event_id as row_pos,
  case k % 3 when 0 then 'office:walk' when 1 then 'office:drive' else 'office:transit' end as travel_key,
  case k % 3 when 0 then 'walk' when 1 then 'drive' else 'transit' end as mode,
  cast(user_id + 75 as string) as listing_id,
  case when k % 13 = 0 then null else 'https://example.com/' || cast(user_id + 75 as string) end as url,
  cast(1 + user_id % 90 as string) || case when k < 20 then 'A' else '' end || ' Far St' as address,
  -33.9e0 + k / 1e3 as lat, 151.1e0 + k / 1e3 as lon,
  case when k % 4 = 0 then null else ((event_id * 7) % 900) / 1e1 end as minutes,
  case when k % 4 = 0 then null else ((event_id * 7) % 900) / 1e2 end as km, 'building' as precision
from {v_event} where event_type = 'error'
"""

VIEWS["v_sighting"] = """
select listing_id, user_id, substr(cast(ts as string), 1, 10) as run_id,
  cast(300 + 50 * floor(min(value) / 5e1) as int) as price_pw
from {v_event} group by listing_id, user_id, substr(cast(ts as string), 1, 10)
"""

VIEWS["v_leg"] = """
select l_orderkey as journey_id, l_suppkey as pair_id, datediff('day', timestamp '1992-01-01 00:00:00', l_shipdate) as day,
  l_partkey as partkey, l_suppkey as suppkey, l_linenumber as linenumber, l_quantity as quantity,
  l_extendedprice as price, l_discount as discount, l_tax as tax, l_returnflag as returnflag, l_linestatus as linestatus,
  case l_suppkey % 5 when 0 then 1 when 1 then 5 when 2 then 9 when 3 then 99 else 100 end as product_class,
  cast(l_quantity * 60 as bigint) as seconds,
  cast(floor(l_extendedprice / 1e1) as double) as path_m,
  case when l_tax = 0 then null else cast(floor(l_quantity) * 80 as double) end as distance_m,
  case when l_partkey % 11 = 0 then null else datediff('day', timestamp '1992-01-01 00:00:00', l_shipdate) * 600 + (l_partkey % 5) * 60 end as departure,
  case when l_suppkey % 7 = 0 then null else datediff('day', timestamp '1992-01-01 00:00:00', l_shipdate) * 600 + (l_partkey % 5) * 60 + cast(l_quantity * 60 as bigint) end as arrival
from {lineitem}
"""

VIEWS["v_doc"] = f"""
select doc_id, cast(doc_id as string) as listing_id, text || ' ' || {pick(PHRASES, 'doc_id % 18')} as description,
  {pick(PHRASES, 'doc_id % 18')} || ' ' || text as headline_first,
  {pick(TYPES, 'doc_id % 10')} as property_text, {pick(PRICES, 'doc_id % 12')} as price_text,
  {pick(SIZES, 'doc_id % 7')} as size_text, cast(doc_id % 7 as int) as bedrooms, source, lang, n_chars,
  case doc_id % 6 when 0 then 'Room ' || cast(doc_id % 40 as string) || '/50 Frederick St, Sydney, NSW 2000'
    when 1 then 'Fully Furnished 3/' || cast(100 + doc_id % 90 as string) || ' Kent St, Sydney NSW 2000'
    when 2 then 'Studio ' || cast(600 + doc_id % 40 as string) || '-640 George Street, Haymarket, NSW 2000'
    when 3 then cast(1 + doc_id % 90 as string) || 'A Point Rd., Pyrmont, NSW 2009'
    when 4 then ' ' else '12 Nowhere Lane' end as address
from {{documents}}
"""


def _esc(text: str) -> str:
    return f"replace(replace({text}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"')"


_ITEM = """'{{"listing":{{"id":"' || cast(page_id * 10 + {n} as string) || '","_links":{{"canonical":{{"href":"' || url || '"}}}},"address":{{"display":{{"fullAddress":"'
  || cast(1 + page_id % 90 as string) || ' Kent St, Sydney, NSW 2000"' || case when page_id % 4 = 0 then ',"geocode":{{"latitude":-33.' || cast(800 + page_id % 100 as string) || ',"longitude":151.2}}' else '' end
  || '}},"suburb":"Sydney","state":"NSW","postcode":"2000"}},"price":{{"display":"$' || cast(400 + page_id % 300 as string) || ' per week"}},"propertyType":{{"display":"Apartment"}},"generalFeatures":{{"bedrooms":{{"value":'
  || cast(page_id % 5 as string) || '}}}},"propertySizes":{{"building":{{"displayValue":"' || cast(50 + page_id % 60 as string) || '"' || case when page_id % 2 = 0 then ',"sizeUnit":"sqm"' else ',"sizeUnit":{{"displayValue":"m2"}}' end
  || '}}}},"media":{{"images":[{{"templatedUrl":"https://img.example.com/{{size}}/' || cast(page_id as string) || '.jpg"}},{{}}]}}}}}}'"""
_ITEM = _ITEM.replace("{{", "\x01").replace("}}", "\x02")


def _item(n: int) -> str:
    return _ITEM.replace("{n}", str(n)).replace("\x01", "{").replace("\x02", "}")


_PAYLOAD = (
    """case when page_id % 5 = 3 then '{"details":{"listing":' || """ + _item(7) + """ || ',"relatedListings":[{"id":"5"},{"id":6},{}]}}'
  else '{"rentSearch":{"results":{"exact":{"items":[' || """ + _item(1) + """ || ',' || """ + _item(2) + """ || ']},"surrounding":{"items":['
  || case when page_id % 3 = 0 then """ + _item(3) + """ else '' end || ']},"pagination":{"maxPageNumberAvailable":' || cast(1 + page_id % 9 as string)
  || '},"totalResultsCount":' || cast(page_id % 50 as string) || '}}}' end"""
)
_BLOB = (
    """'{"app":{"n":1,"urqlClientCache":"' || """
    + _esc("""'{"bad":{"data":"{oops"},"skip":{"x":1},"h":{"data":"' || """ + _esc("payload") + """ || '"}}'""")
    + """ || '"},"m":3}'"""
)
VIEWS["v_page_payload"] = "select page_id, url, html, " + _PAYLOAD.replace("{", "{{").replace("}", "}}") + " as payload from {pages}"
VIEWS["v_page"] = (
    "select page_id, url, html || case when page_id % 10 = 9 then '<script>window.ArgonautExchange={{\"app\":;</script>' else "
    "'<script>window.ArgonautExchange=' || " + _BLOB.replace("{", "{{").replace("}", "}}") + " || ';</script>' end as html from {v_page_payload}"
)


def references(name: str) -> list[str]:
    return sorted({field for _, field, _, _ in Formatter().parse(VIEWS[name]) if field})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return table(spark, sf_dir, name)
    sources = {ref: view(spark, sf_dir, ref) for ref in references(name)}
    # DuckDB and Spark agree on the text except for the unit argument of datediff.
    text = VIEWS[name].replace("datediff('day',", "datediff(DAY,")
    return spark.sql(text, **sources)


@lru_cache(maxsize=None)
def closure(name: str) -> tuple[str, ...]:
    """Views a view needs, in dependency order, itself last."""
    order: list[str] = []
    for ref in references(name):
        if ref not in TABLES:
            order += [v for v in closure(ref) if v not in order]
    return tuple([*order, name])


def with_views(names: list[str], body: str) -> str:
    """An oracle: the views as common table expressions, then ``body`` (which may start with more)."""
    order: list[str] = []
    for name in names:
        order += [v for v in closure(name) if v not in order]
    parts = []
    for name in order:
        text = VIEWS[name].format(**{ref: ref for ref in references(name)})
        parts.append(f"{name} as ({text})")
    body = body.strip()
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body
