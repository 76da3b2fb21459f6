"""Queries over free text and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.functions import signals as G
from listingflow.functions import text as X
from listingflow.functions.patterns import trimmed
from listingflow.operators.reports import signal_review as review
from listingflow.sources import pages as W

from .captures import AREA_SQL, PRICE_SQL, TYPE_SQL
from .views import table, view, with_views

ROOM_NO_LOOKAHEAD = [(name, p) for name, p in G.ROOM_SIGNALS if "(?!" not in p]
STUDIO_NO_LOOKAHEAD = [(name, p) for name, p in G.STUDIO_SIGNALS if "(?!" not in p]


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.with_evidence(view(spark, sf_dir, "v_doc"), "description", "property_text", "address", "price_text", "bedrooms")


def _long(rows: DataFrame, column: str) -> DataFrame:
    # Outer: an inner explode would copy the rules into a filter below it.
    long = rows.select("listing_id", F.explode_outer(column).alias("e"))
    return long.filter("e is not null").select("listing_id", "e.signal", "e.quote")


def room_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(evidence(spark, sf_dir), "room_evidence")


def room_signals_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules SQL can restate: every one without a look-ahead."""
    names = [name for name, _ in ROOM_NO_LOOKAHEAD] + ["room_address", "beds_vs_price"]
    return room_signals(spark, sf_dir).filter(F.col("signal").isin(*names))


def studio_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(evidence(spark, sf_dir), "studio_evidence")


def studio_signals_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [name for name, _ in STUDIO_NO_LOOKAHEAD] + [G.STUDIO_TYPE_SIGNAL]
    return studio_signals(spark, sf_dir).filter(F.col("signal").isin(*names))


def signal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evidence(spark, sf_dir).select(
        F.explode_outer(F.concat(G.signal_names(F.col("room_evidence")), G.signal_names(F.col("studio_evidence")))).alias("signal")
    ).filter("signal is not null")
    return rows.groupBy("signal").agg(F.count("*").alias("listings"))


def signal_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review(evidence(spark, sf_dir)).select("listing_id", "kind", "flagged", F.array_join("notes", " | ").alias("notes"))


def parse_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices, areas and types; prices also out of whole documents that mention dollars."""
    rows = view(spark, sf_dir, "v_doc")
    return rows.select(
        "listing_id", X.weekly_rent(F.col("price_text")).alias("price_pw"), X.weekly_rent(F.col("description")).alias("text_price_pw"),
        X.area_sqm(F.col("size_text")).alias("area_sqm"), X.property_type(F.col("property_text")).alias("property_type"),
    )


def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_doc")
    price = X.weekly_rent(F.col("price_text"))
    return rows.select(
        "listing_id", X.snippet(F.col("description")).alias("snippet"), X.snippet(F.col("headline_first"), 40).alias("headline"),
        X.price_display(F.col("price_text"), price).alias("price_display"),
    )


def feature_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each conversation turn as features: normalised, blanks out, first occurrence kept."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", "role", F.array_join(X.feature_list(F.split("text", " ", -1)), ",").alias("features"))


def media_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    url = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("https://img.example.com/{size}/a-{size}/"), key))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("https://img.example.com/1024x768/b/800x600/"), key))
        .otherwise(F.concat(F.lit("https://img.example.com/12345x768/"), key))
    )
    path = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("/images/listings/"), key, F.lit("/01.webp")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("listings/"), key, F.lit("/02.thumb.webp")))
        .otherwise(F.concat(F.lit("images/mylistings/"), key, F.lit("/01.webp")))
    )
    files = F.transform(F.sequence(F.lit(1), (F.col("o_orderkey") % 3 + 1).cast("int")), lambda i: F.format_string("%02d.webp", i))
    photos = X.photo_paths(key, files)
    return o.select(
        F.col("o_orderkey").alias("id"), X.sized_image_url(url).alias("url"), X.listing_id_of_key(path).alias("owner"),
        F.get(photos, F.lit(0))["src"].alias("hero"), F.element_at(photos, -1)["thumb"].alias("last_thumb"),
        X.locality_query(F.col("o_orderpriority"), F.col("o_orderstatus"), F.lit("NSW")).alias("locality"),
    )


def suburb_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = view(spark, sf_dir, "v_doc")
    text = F.col("description")
    return d.select("listing_id", X.suburb_key(text, F.lit("2000")).alias("suburb_key"), X.feature_key(text).alias("feature"),
                    trimmed(text).alias("trimmed"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.page_payloads(view(spark, sf_dir, "v_page"))


def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.search_rows(payloads(spark, sf_dir), "page_id")
    flat = rows.select("page_id", "total_results", "total_pages", "row_pos", "is_surrounding", *W.normalised_item(F.col("item")))
    return flat.select(
        "page_id", "total_results", "total_pages", "row_pos", "is_surrounding", "listing_id", "url", "address", "suburb", "postcode",
        "price", "property_text", "bedrooms", "building_size", F.array_join("images", ",").alias("images"),
        F.col("coords.lat").alias("lat"), F.col("coords.lng").alias("lng"),
    )


def listing_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.detail_rows(payloads(spark, sf_dir), "page_id")
    flat = rows.select("page_id", F.array_join("related_ids", ",").alias("related"), *W.normalised_item(F.col("item")))
    return flat.select("page_id", "related", "listing_id", "url", "price", "bedrooms", "building_size", F.col("coords.lat").alias("lat"))


QUERIES = {
    "room_signals": room_signals, "room_signals_checked": room_signals_checked, "studio_signals": studio_signals,
    "studio_signals_checked": studio_signals_checked, "signal_counts": signal_counts, "signal_review": signal_review,
    "parse_prices": parse_prices, "snippets": snippets, "feature_lists": feature_lists, "media_paths": media_paths,
    "suburb_keys": suburb_keys, "extract_pages": extract_pages, "listing_details": listing_details,
}


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _plain(text: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({text}, '<[^>]+>', ' ', 'g'), '&nbsp;', ' ', 'gi'), '&amp;', '&', 'gi'), '\\s+', ' ', 'g')"


def _rules(rules, searched: str, quoted: str, source: str) -> str:
    """One branch per rule: match, its offset (length of the shortest prefix), the quote around it."""
    parts = []
    for name, pattern in rules:
        p = _q(pattern)
        at = f"length(regexp_extract({searched}, '(?is)^(.*?)(?:{p})', 1)) + 1" if not pattern.startswith("^") else "1"
        parts.append(
            f"select listing_id, '{name}' as signal, {quoted} as q, {at} as s, length(regexp_extract({searched}, '(?is){p}')) as n from {source} where regexp_matches({searched}, '(?is){p}')"
        )
    return " union all ".join(parts)


_MARK = "chr(1) || "
_AMENITY, _STUDIO_WORD = G.AMENITY_NOUN, "studios?"
_TRIGGER = r"\b(?:shar(?:e|ed|ing)|communal|common)\s+"
# RE2 has no look-ahead: the words a rule must not run over get a mark in front, and its words may not start with one.
_MARKED_ROOM = [(f"shared_{noun}", rf"{_TRIGGER}(?:\w+[\s,-]+){{0,2}}\x01?{noun}") for noun in ("kitchen", "bathroom")]
_MARKED_STUDIO = [("studio_offered", rf"\b(?:{G.STUDIO_LEAD})\s+(?:[\w'’-][\w'’\x01-]*[\s,-]+){{0,4}}\x01studio\b")]
# What follows the white space must be "room" anyway, so the look-ahead of this rule excludes nothing.
_OFFERED_ROOM = [(name, pattern.replace(rf"(?!{G.HOUSE_PART_ROOM}\b)", "")) for name, pattern in G.ROOM_SIGNALS if name == "offered_room"]


def _marked_rules(rules, words: str, searched: str, quoted: str, source: str) -> str:
    """Rules over a text whose ``words`` are marked; offsets and lengths are counted without marks."""
    parts = []
    for name, pattern in rules:
        p, text = _q(pattern), f"regexp_replace({searched}, '(?i)\\b({words})\\b', {_MARK}'\\1', 'g')"
        parts.append(
            f"select listing_id, '{name}' as signal, {quoted} as q, length(replace(regexp_extract({text}, '(?is)^(.*?)(?:{p})', 1), chr(1), '')) + 1 as s, "
            f"length(replace(regexp_extract({text}, '(?is){p}'), chr(1), '')) as n from {source} where regexp_matches({text}, '(?is){p}')"
        )
    return " union all ".join(parts)


_QUOTE = """case when s - 30 > 1 then '…' else '' end || trim(substr(q, greatest(1, s - 30), least(length(q), s + n - 1 + 30) - greatest(1, s - 30) + 1)) || case when s + n - 1 + 30 < length(q) then '…' else '' end"""


def _mask(text: str, pattern: str) -> str:
    p = "(?i)" + _q(pattern)
    return (
        f"list_aggregate(list_transform(list_zip(string_split_regex({text}, '{p}'), regexp_extract_all({text}, '{p}')), "
        f"lambda x: coalesce(x[1], '') || coalesce(repeat(' ', length(x[2])), '')), 'string_agg', '')"
    )


_MASKS = "masked0 as (select listing_id, property_text, trim(" + _plain("description") + ") as t, trim(" + _plain("description") + ") as m from v_doc)" + "".join(
    f", masked{i + 1} as (select listing_id, property_text, t, {_mask('m', p)} as m from masked{i})" for i, p in enumerate(G.NOT_A_STUDIO_OFFER)
)
_DOC_PRICE = PRICE_SQL.format(p="price_text")
_ADDRESS_AND_PRICE = f"""select listing_id, 'room_address' as signal, address as quote from v_doc where regexp_matches(lower(address), '^\\s*(?:room|rm)\\s*\\.?\\s*[0-9]')
        union all select listing_id, 'beds_vs_price', bedrooms || ' bedrooms at ' || price_text from v_doc where bedrooms >= 5 and ({_DOC_PRICE}) < 500"""
_TYPED = "select listing_id, 'rea_property_type' as signal, 'REA property type: ' || property_text as quote from v_doc where regexp_matches(lower(property_text), '\\bstudio')"
_LOWERED = f"lowered as (select *, lower({_plain('description')}) as t from v_doc)"
_ROOM_FREE = _rules(ROOM_NO_LOOKAHEAD, "t", "t", "lowered")
_STUDIO_FREE = _rules(STUDIO_NO_LOOKAHEAD, "m", "t", "masked4")
_ROOM = f"""{_LOWERED}, room_hits as ({_ROOM_FREE} union all {_rules(_OFFERED_ROOM, "t", "t", "lowered")} union all {_marked_rules(_MARKED_ROOM, _AMENITY, "t", "t", "lowered")}),
        room as (select listing_id, signal, {_QUOTE} as quote from room_hits union all {_ADDRESS_AND_PRICE})"""
_STUDIO = f"""{_MASKS}, studio_hits as ({_STUDIO_FREE} union all {_marked_rules(_MARKED_STUDIO, _STUDIO_WORD, "m", "t", "masked4")}),
        studio as (select listing_id, signal, {_QUOTE} as quote from studio_hits union all {_TYPED})"""
_ROOM_ORDER = [name for name, _ in G.ROOM_SIGNALS] + ["room_address", "beds_vs_price"]
_STUDIO_ORDER = [G.STUDIO_TYPE_SIGNAL] + [name for name, _ in G.STUDIO_SIGNALS]


def _loose(kind: str, text: str, pattern: str, context: int) -> str:
    """The first three distinct surroundings of a loose pattern in listings without evidence of the kind."""
    p = "(?i)" + _q(pattern)
    return f"""
        {kind}_split as (select listing_id, t, string_split_regex(t, '{p}') as pieces, regexp_extract_all(t, '{p}') as found from (select listing_id, {text} as t from v_doc)),
        {kind}_at as (select listing_id, t, unnest(range(1, len(found) + 1)) as i, pieces, found from {kind}_split),
        {kind}_spot as (select listing_id, i, t, length(found[i]) as n, length(array_to_string(pieces[1:i], '')) + length(array_to_string(found[1:i - 1], '')) + 1 as s from {kind}_at),
        {kind}_near as (select listing_id, i, '…' || trim(substr(t, greatest(1, s - {context}), s + n + {context} - greatest(1, s - {context}))) || '…' as quote from {kind}_spot),
        {kind}_grouped as (select listing_id, quote, min(i) as i from {kind}_near group by 1, 2),
        {kind}_loose as (select listing_id, string_agg(quote, ' | ' order by i) as notes from (select *, row_number() over (partition by listing_id order by i) as k from {kind}_grouped) where k <= 3 group by 1)"""


def _reviewed(kind: str, order: list[str]) -> str:
    return f"""select listing_id, '{kind}' as kind, true as flagged, string_agg(signal || ': ' || quote, ' | ' order by list_position({order}, signal)) as notes from {kind} group by 1
        union all select listing_id, '{kind}', false, notes from {kind}_loose where listing_id not in (select listing_id from {kind})"""


ORACLES = {
    "room_signals": with_views(["v_doc"], f"with {_ROOM} select * from room"),
    "studio_signals": with_views(["v_doc"], f"with {_STUDIO} select * from studio"),
    "signal_counts": with_views(["v_doc"], f"with {_ROOM}, {_STUDIO} select signal, count(*) as listings from (select signal from room union all select signal from studio) group by 1"),
    "signal_review": with_views(
        ["v_doc"],
        f"""with {_ROOM}, {_STUDIO}, {_loose("room", "lower(" + _plain("description") + ")", G.ROOM_LOOSE, G.ROOM_LOOSE_CONTEXT)}, {_loose("studio", _plain("description"), G.STUDIO_LOOSE, G.STUDIO_LOOSE_CONTEXT)}
        {_reviewed("room", _ROOM_ORDER)} union all {_reviewed("studio", _STUDIO_ORDER)}""",
    ),
    "room_signals_checked": with_views(
        ["v_doc"],
        f"with {_LOWERED}, hits as ({_ROOM_FREE}) select listing_id, signal, {_QUOTE} as quote from hits union all {_ADDRESS_AND_PRICE}",
    ),
    "studio_signals_checked": with_views(
        ["v_doc"],
        f"with {_MASKS}, hits as ({_STUDIO_FREE}) select listing_id, signal, {_QUOTE} as quote from hits union all {_TYPED}",
    ),
    "parse_prices": with_views(
        ["v_doc"],
        f"with d as (select *, property_text as t from v_doc) select listing_id, {_DOC_PRICE} as price_pw, {PRICE_SQL.format(p='description')} as text_price_pw, {AREA_SQL} as area_sqm, {TYPE_SQL} as property_type from d",
    ),
    "snippets": with_views(
        ["v_doc"],
        f"""with c as (select *, trim(regexp_replace(description, '\\s+', ' ', 'g')) as d, trim(regexp_replace(headline_first, '\\s+', ' ', 'g')) as h, {_DOC_PRICE} as p from v_doc),
        e as (select *, left(d, 499) as dc, left(h, 39) as hc from c)
        select listing_id, case when length(d) <= 500 then d when contains(dc, ' ') and 499 - position(' ' in reverse(dc)) > 300 then rtrim(left(dc, 499 - position(' ' in reverse(dc)))) || '…' else rtrim(dc) || '…' end as snippet,
        case when length(h) <= 40 then h when contains(hc, ' ') and 39 - position(' ' in reverse(hc)) > 24 then rtrim(left(hc, 39 - position(' ' in reverse(hc)))) || '…' else rtrim(hc) || '…' end as headline,
        case when trim(price_text) <> '' then trim(price_text) when p is not null then '$' || p || ' per week' else 'Contact agent' end as price_display from e""",
    ),
    "feature_lists": """
        with w as (select conv_id, turn, role, unnest(string_split(text, ' ')) as word, generate_subscripts(string_split(text, ' '), 1) as i from conversations),
        k as (select conv_id, turn, role, i, trim(regexp_replace(lower(trim(word)), '[^a-z0-9]+', '_', 'g'), '_') as f from w),
        first as (select conv_id, turn, role, f, min(i) as i from k where f <> '' group by all),
        lists as (select conv_id, turn, role, string_agg(f, ',' order by i) as features from first group by all)
        select c.conv_id, c.turn, c.role, coalesce(features, '') as features from conversations c left join lists using (conv_id, turn, role)""",
    "media_paths": """
        select o_orderkey as id, case o_orderstatus when 'F' then 'https://img.example.com/1600x1200/a-{size}/' || o_orderkey when 'O' then 'https://img.example.com/1600x1200/b/800x600/' || o_orderkey
          else 'https://img.example.com/12345x768/' || o_orderkey end as url,
        case when o_orderstatus in ('F', 'O') then cast(o_orderkey as varchar) end as owner, '/images/listings/' || o_orderkey || '/01.webp' as hero,
        '/images/listings/' || o_orderkey || '/0' || (o_orderkey % 3 + 1) || '.thumb.webp' as last_thumb, o_orderpriority || ', NSW ' || o_orderstatus || ', Australia' as locality from orders""",
    "suburb_keys": with_views(
        ["v_doc"],
        """select listing_id, trim(regexp_replace(lower(trim(description)), '[^a-z0-9]+', '-', 'g'), '-') || '-2000' as suburb_key,
        trim(regexp_replace(lower(description), '[^a-z0-9]+', '_', 'g'), '_') as feature, regexp_replace(description, '^\\s+|\\s+$', '', 'g') as trimmed from v_doc""",
    ),
    "extract_pages": with_views(
        ["v_page_payload"],
        """with r as (select page_id, url as page_url, unnest(case when page_id % 3 = 0 then [1, 2, 3] else [1, 2] end) as n from v_page_payload where page_id % 5 <> 3 and page_id % 10 <> 9)
        select page_id, cast(page_id % 50 as int) as total_results, cast(1 + page_id % 9 as int) as total_pages, cast(n - 1 as int) as row_pos, n = 3 as is_surrounding, cast(page_id * 10 + n as varchar) as listing_id,
        page_url as url, (1 + page_id % 90) || ' Kent St, Sydney, NSW 2000' as address, 'Sydney' as suburb, '2000' as postcode, '$' || (400 + page_id % 300) || ' per week' as price, 'Apartment' as property_text,
        cast(page_id % 5 as double) as bedrooms, (50 + page_id % 60) || case when page_id % 2 = 0 then 'sqm' else 'm2' end as building_size, 'https://img.example.com/1024x768/' || page_id || '.jpg' as images,
        case when page_id % 4 = 0 then cast('-33.' || (800 + page_id % 100) as double) end as lat, case when page_id % 4 = 0 then 151.2::double end as lng from r""",
    ),
    "listing_details": with_views(
        ["v_page_payload"],
        """select page_id, '5,6' as related, cast(page_id * 10 + 7 as varchar) as listing_id, url, '$' || (400 + page_id % 300) || ' per week' as price, cast(page_id % 5 as double) as bedrooms,
        (50 + page_id % 60) || case when page_id % 2 = 0 then 'sqm' else 'm2' end as building_size, case when page_id % 4 = 0 then cast('-33.' || (800 + page_id % 100) as double) end as lat
        from v_page_payload where page_id % 5 = 3 and page_id % 10 <> 9""",
    ),
}
