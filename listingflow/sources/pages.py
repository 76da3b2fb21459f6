"""Listing pages: the hydration blob inside a ``<script>``, three JSON layers deep, as rows.

All three layers are decoded with Spark's own JSON functions. A layer that does not parse becomes
null and drops out; the other entries of the page are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import java
from ..functions.text import size_display

# ---- Fixed values: where a page keeps its data --------------------------------------------
HYDRATION = r"window\.ArgonautExchange\s*=\s*(\{[\s\S]*?\})\s*;\s*(?:window\.|<\/script>|$)"
PAGE_IMAGE_SIZE = "1024x768"
PROFILE_QUERY = "?cid={cid}"
SEARCH_NODE = "Search$"
# -------------------------------------------------------------------------------------------

LISTING_JSON = """
    id STRING, __typename STRING, description STRING,
    _links STRUCT<canonical: STRUCT<href: STRING>>,
    address STRUCT<
        display: STRUCT<fullAddress: STRING, shortAddress: STRING,
                        geocode: STRUCT<latitude: STRING, longitude: STRING, lat: STRING, lon: STRING, lng: STRING>>,
        suburb: STRING, state: STRING, postcode: STRING,
        location: STRUCT<latitude: STRING, longitude: STRING, lat: STRING, lon: STRING, lng: STRING>,
        geolocation: STRUCT<latitude: STRING, longitude: STRING, lat: STRING, lon: STRING, lng: STRING>,
        coordinates: STRUCT<latitude: STRING, longitude: STRING, lat: STRING, lon: STRING, lng: STRING>>,
    location STRUCT<latitude: STRING, longitude: STRING, lat: STRING, lon: STRING, lng: STRING>,
    geolocation STRUCT<latitude: STRING, longitude: STRING, lat: STRING, lon: STRING, lng: STRING>,
    price STRUCT<display: STRING, information: STRING>,
    propertyType STRUCT<display: STRING>,
    generalFeatures STRUCT<bedrooms: STRUCT<value: DOUBLE>, bathrooms: STRUCT<value: DOUBLE>,
                           parkingSpaces: STRUCT<value: DOUBLE>, studies: STRUCT<value: DOUBLE>>,
    propertySizes STRUCT<land: STRUCT<displayValue: STRING, sizeUnit: STRING>,
                         building: STRUCT<displayValue: STRING, sizeUnit: STRING>>,
    listingCompany STRUCT<name: STRING, id: STRING, ratingsReviews: STRUCT<avgRating: DOUBLE, totalReviews: INT>>,
    listers ARRAY<STRUCT<name: STRING, jobTitle: STRING, _links: STRUCT<canonical: STRUCT<href: STRING>>>>,
    inspections ARRAY<STRUCT<startTime: STRING, endTime: STRING, display: STRUCT<longLabel: STRING>>>,
    auction STRUCT<dateTime: STRUCT<value: STRING, display: STRUCT<longLabel: STRING>>>,
    media STRUCT<images: ARRAY<STRUCT<templatedUrl: STRING>>, floorplans: ARRAY<STRUCT<templatedUrl: STRING>>>,
    dateSold STRUCT<value: STRING, display: STRING>
"""


def _entries(variant: Column) -> Column:
    """The members of a JSON object as ``array<struct<key, value>>``; null for anything else."""
    members = F.try_variant_get(variant, "$", "map<string,variant>")
    return F.map_entries(F.when(F.schema_of_variant(variant).startswith("OBJECT"), members))


def _text(variant: Column) -> Column:
    """The text of a JSON string; null for numbers and objects."""
    return F.when(F.schema_of_variant(variant) == "STRING", F.try_variant_get(variant, "$", "string"))


def page_payloads(pages: DataFrame, html: str = "html") -> DataFrame:
    """``payloads``: the decoded responses of each page in order, as an array of variants in the page's own row.

    Every other column of ``pages`` is carried.
    """
    keep = [c for c in pages.columns if c != html]
    blob = F.try_parse_json(F.regexp_extract(html, java(HYDRATION), 1))

    def answers(e: Column) -> Column:
        data = F.try_variant_get(e["value"], "$.data", "variant")
        return F.try_parse_json(_text(data))

    def some(payloads: Column) -> Column:
        # flatten() of an array with one null in it is null.
        return F.coalesce(payloads, F.array().cast("array<variant>"))

    def caches(e: Column) -> Column:
        return some(F.transform(_entries(F.try_parse_json(_text(e["value"]))), answers))

    layers = F.transform(_entries(F.col("blob")), lambda e: some(F.flatten(F.transform(_entries(e["value"]), caches))))
    staged = pages.select(*keep, blob.alias("blob"))
    return staged.select(*keep, F.filter(F.flatten(layers), lambda p: p.isNotNull()).alias("payloads"))


def _member(variant: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(variant, path, kind)


def _json(variant: Column) -> Column:
    return F.when(variant.isNotNull(), F.to_json(variant))


def search_rows(payloads: DataFrame, page_key: str) -> DataFrame:
    """Result rows of search pages: the searched locality, then the surrounding ones (tagged).

    A page's first payload holding search results answers for it.
    """

    def results(path: str, kind: str):
        return lambda e: _member(e["value"], path, kind)

    def node(payload: Column) -> Column:
        named = _entries(payload)
        by_name = F.get(
            F.filter(named, lambda e: e["key"].rlike(SEARCH_NODE) & results("$.results", "variant")(e).isNotNull()),
            F.lit(0),
        )
        by_shape = F.get(
            F.filter(named, lambda e: results("$.results.exact.items", "array<variant>")(e).isNotNull()), F.lit(0)
        )
        return F.coalesce(by_name, by_shape)["value"]

    first = F.get(
        F.filter(F.transform("payloads", node), lambda n: _member(n, "$.results.exact.items", "array<variant>").isNotNull()),
        F.lit(0),
    )
    nodes = payloads.select(page_key, first.alias("node"))
    surrounding = _member(F.col("node"), "$.results.surrounding.items", "array<variant>")
    both = F.concat(
        F.transform(
            _member(F.col("node"), "$.results.exact.items", "array<variant>"),
            lambda v: F.struct(_json(v).alias("item"), F.lit(False).alias("is_surrounding")),
        ),
        F.transform(
            F.coalesce(surrounding, F.array().cast("array<variant>")),
            lambda v: F.struct(_json(v).alias("item"), F.lit(True).alias("is_surrounding")),
        ),
    )
    rows = nodes.select(
        page_key, _member(F.col("node"), "$.results.totalResultsCount", "int").alias("total_results"),
        _member(F.col("node"), "$.results.pagination.maxPageNumberAvailable", "int").alias("total_pages"),
        # Outer: an inner explode would decode the page once more in a filter below it.
        F.posexplode_outer(both).alias("row_pos", "r"),
    ).filter("r is not null")
    return rows.select(
        page_key, "total_results", "total_pages", "row_pos", "r.is_surrounding", _typed(F.col("r.item")).alias("item")
    )


def _typed(item: Column) -> Column:
    """An item as a struct; some pages wrap it once more under ``listing``."""
    return F.from_json(F.coalesce(F.get_json_object(item, "$.listing"), item), LISTING_JSON)


def detail_rows(payloads: DataFrame, page_key: str) -> DataFrame:
    """The listing of a detail page: ``details.listing`` wins over any node with an id and an address."""

    def related(payload: Column) -> Column:
        ids = F.transform(
            _member(payload, "$.details.relatedListings", "array<variant>"),
            lambda r: F.coalesce(_member(r, "$.id", "string"), F.lit("")),
        )
        return F.filter(ids, lambda i: i != "")

    def inner(e: Column) -> Column:
        return F.coalesce(_member(e["value"], "$.listing", "variant"), e["value"])

    def usable(e: Column) -> Column:
        named = F.coalesce(_member(inner(e), "$.id", "string"), F.lit("")) != ""
        return F.coalesce(named & _member(inner(e), "$.address", "variant").isNotNull(), F.lit(False))

    def wrapped_item(payload: Column) -> Column:
        return _json(_member(payload, "$.details.listing", "variant"))

    def loose_item(payload: Column) -> Column:
        return _json(inner(F.get(F.filter(_entries(payload), usable), F.lit(0))))

    # The wrapped form of any payload is preferred to the loose form of every payload.
    wrapped = F.get(F.filter("payloads", lambda p: wrapped_item(p).isNotNull()), F.lit(0))
    loose = F.get(F.filter(F.transform("payloads", loose_item), lambda item: item.isNotNull()), F.lit(0))
    found = payloads.select(page_key, wrapped.alias("wrapped"), loose.alias("loose"))
    nodes = found.select(
        page_key, F.coalesce(wrapped_item(F.col("wrapped")), F.col("loose")).alias("item"), related(F.col("wrapped")).alias("related_ids"),
        _json(_member(F.col("wrapped"), "$.details.recentSales", "variant")).alias("recent_sales"),
        _json(_member(F.col("wrapped"), "$.details.marketInsights", "variant")).alias("market_insights"),
    )
    kept = nodes.withColumn("item", F.explode_outer(F.array("item"))).filter("item is not null")
    return kept.select(
        page_key, _typed(F.col("item")).alias("item"), "related_ids", "recent_sales", "market_insights"
    )


def coordinates(item: Column) -> Column:
    """The first usable of six places a position may be, else null; (0, 0) is not a position."""
    address = item["address"]
    places = [
        address["display"]["geocode"], address["location"], address["geolocation"], address["coordinates"],
        item["location"], item["geolocation"],
    ]

    def number(text: Column) -> Column:
        return F.when(F.trim(text) == "", F.lit(0.0)).otherwise(text.try_cast("double"))

    def point(place: Column) -> Column:
        lat = number(F.coalesce(place["latitude"], place["lat"]))
        lon = number(F.coalesce(place["longitude"], place["lon"], place["lng"]))
        return F.when(
            ~F.isnan(lat) & ~F.isnan(lon) & ((lat != 0) | (lon != 0)), F.struct(lat.alias("lat"), lon.alias("lng"))
        )

    return F.coalesce(*[point(p) for p in places])


def _image_urls(media: Column) -> Column:
    urls = F.filter(F.transform(media, lambda m: m["templatedUrl"]), lambda u: u.isNotNull() & (u != ""))
    return F.transform(
        urls,
        lambda u: F.when(
            F.locate("{size}", u) > 0,
            F.concat(
                F.left(u, F.locate("{size}", u) - 1), F.lit(PAGE_IMAGE_SIZE),
                F.substring(u, F.locate("{size}", u) + 6, F.length(u)),
            ),
        ).otherwise(u),
    )


def normalised_item(item: Column) -> list[Column]:
    """The flat listing columns of one page item, each with its fallbacks."""
    address, price, features = item["address"], item["price"], item["generalFeatures"]
    land, building = item["propertySizes"]["land"], item["propertySizes"]["building"]
    company, sold = item["listingCompany"], item["dateSold"]
    return [
        F.coalesce(item["id"], F.lit("")).alias("listing_id"),
        item["_links"]["canonical"]["href"].alias("url"),
        F.coalesce(address["display"]["fullAddress"], address["display"]["shortAddress"], F.lit("")).alias("address"),
        address["suburb"].alias("suburb"),
        address["state"].alias("state"),
        address["postcode"].alias("postcode"),
        F.coalesce(price["display"], price["information"], F.lit("")).alias("price"),
        item["propertyType"]["display"].alias("property_text"),
        features["bedrooms"]["value"].alias("bedrooms"),
        features["bathrooms"]["value"].alias("bathrooms"),
        features["parkingSpaces"]["value"].alias("car_spaces"),
        features["studies"]["value"].alias("studies"),
        size_display(land["displayValue"], land["sizeUnit"]).alias("land_size"),
        size_display(building["displayValue"], building["sizeUnit"]).alias("building_size"),
        F.when(
            company.isNotNull(),
            F.struct(
                company["name"].alias("name"), company["id"].alias("id"),
                company["ratingsReviews"]["avgRating"].alias("avg_rating"),
                company["ratingsReviews"]["totalReviews"].alias("total_reviews"),
            ),
        ).alias("agency"),
        F.transform(
            item["listers"],
            lambda x: F.struct(
                x["name"].alias("name"), x["jobTitle"].alias("job_title"),
                F.replace(x["_links"]["canonical"]["href"], F.lit(PROFILE_QUERY), F.lit("")).alias("profile_url"),
            ),
        ).alias("agents"),
        F.transform(
            item["inspections"],
            lambda x: F.struct(
                x["startTime"].alias("start"), x["endTime"].alias("end"), x["display"]["longLabel"].alias("label")
            ),
        ).alias("inspections"),
        item["auction"]["dateTime"]["value"].alias("auction_at"),
        item["auction"]["dateTime"]["display"]["longLabel"].alias("auction_label"),
        item["description"].alias("description"),
        _image_urls(item["media"]["images"]).alias("images"),
        _image_urls(item["media"]["floorplans"]).alias("floorplans"),
        F.when(F.contains(item["__typename"], F.lit("Sold")), price["display"]).alias("sold_price"),
        F.coalesce(sold["value"], sold["display"]).alias("sold_date"),
        coordinates(item).alias("coords"),
    ]
