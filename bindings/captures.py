"""Queries over captures: flattening, totals, budgets, exclusion, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.functions.text import keyword_hit
from listingflow.operators import capture as C
from listingflow.operators import enrichment as E
from listingflow.operators import reports as R
from listingflow.operators.normalise import normalise
from listingflow.schemas import CAPTURE
from listingflow.sources import faults

from .settings import KEYWORDS
from .views import VIEWS, view, with_views


def capture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    leg = F.struct("minutes", "km", "mode", "precision")
    return view(spark, sf_dir, "v_capture").withColumn("travel", F.when(F.col("minutes").isNotNull(), leg))


def flatten_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = C.unique_listings(capture_rows(spark, sf_dir), ["address", "url", "price", "bedrooms"])
    legs = []
    for mode in ("walk", "drive", "transit"):
        leg = F.try_element_at(F.col("travel"), F.lit(f"office:{mode}"))
        legs += [leg["minutes"].alias(f"{mode}_minutes"), leg["precision"].alias(f"{mode}_precision")]
    return flat.select("listing_id", "address", "price", "bedrooms", *legs)


def group_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.group_totals(capture_rows(spark, sf_dir))


def blank_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.blank_addresses(capture_rows(spark, sf_dir))


def keyword_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_doc")
    hit = keyword_hit(F.col("property_text"), F.col("address"), KEYWORDS)
    return rows.select("listing_id", hit.alias("keyword")).filter("keyword is not null")


def travel_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = C.within_budget(capture_rows(spark, sf_dir), 30)
    return C.nearest_first(kept).select("row_pos", "listing_id", F.col("travel.minutes").alias("minutes"))


def travel_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = capture_rows(spark, sf_dir).withColumns(
        {"suburb": F.lit(None).cast("string"), "state": F.lit("NSW"), "postcode": F.lit(None).cast("string"),
         "coords": F.lit(None).cast("struct<lat:double,lng:double>")}
    )
    return C.over_budget(rows, 30).select(
        "listing_id", "url", "address", "state", F.col("travel.minutes").alias("minutes"), F.col("travel.km").alias("km")
    )


def travel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = capture_rows(spark, sf_dir).withColumn("building", F.lower(F.trim("address")))
    return C.travel_report(rows, ["mode"])


def page_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event stands for one page report; a third of the pages of a pass reported nothing."""
    e = view(spark, sf_dir, "v_event")
    pages = e.select(
        F.concat(F.lit("office:"), "mode").alias("travel_key"), F.col("event_id").alias("page_pos"),
        (F.col("k") % 3 != 0).alias("reported"),
        F.when(F.col("k") % 5 != 0, F.concat(F.lit("office "), F.col("user_id").cast("string"))).alias("origin"),
        F.when(F.col("k") % 2 == 0, F.col("mode")).alias("mode"),
        F.when(F.col("k") > 50, F.lit("router")).alias("router"),
        F.lit(None).cast("string").alias("geocoder"),
        *[
            F.when(F.col("k") % (i + 2) != 0, F.col("k") + i).cast("int").alias(name)
            for i, name in enumerate(C.REPORT_COUNTS)
        ],
    )
    return C.accumulate_reports(pages, "travel_key")


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = capture_rows(spark, sf_dir)
    sizes = rows.groupBy("listing_id").agg(F.count("*").alias("rows"))
    flat = C.unique_listings(rows, ["address", "price"]).join(sizes, "listing_id")
    excluded = keyword_hit(F.lit(None).cast("string"), F.col("address"), ["7 Nation"])
    problem = F.when(F.trim("address") == "", F.lit("no address"))
    walk = F.try_element_at(F.col("travel"), F.lit("office:walk"))["minutes"]
    return C.funnel(flat, F.col("rows"), excluded, problem, F.coalesce(walk <= 30, F.lit(False)))


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope suburbs no customer of the largest segment lives in stand for suburbs never searched."""
    places = view(spark, sf_dir, "v_place").select(F.col("canonical").alias("location"))
    searched = view(spark, sf_dir, "supplier").join(
        view(spark, sf_dir, "v_place"), F.col("s_nationkey") == F.col("nationkey")
    ).filter("s_acctbal > 8000").select(F.col("canonical").alias("location"))
    return C.coverage(places, searched)


def searched_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = view(spark, sf_dir, "v_place").select(F.col("canonical").alias("location"))
    searched = view(spark, sf_dir, "supplier").join(
        view(spark, sf_dir, "v_place"), F.col("s_nationkey") == F.col("nationkey")
    ).filter("s_acctbal > 8000").select(F.col("canonical").alias("location"))
    return C.searched_locations(places, searched)


def run_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of every document's run: a missing block by source, three carried notes each."""
    docs = view(spark, sf_dir, "v_doc")
    missing = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("walkability"))).when(
        F.col("doc_id") % 3 == 1, F.array(F.lit("a routed commute time"), F.lit("walkability"))
    ).otherwise(F.array().cast("array<string>"))
    carried = F.array(
        F.lit("Enrichment has not run for this milestone."), F.concat(F.lit("Partial search: "), "source"),
        F.lit("No listing in this run has a routed commute time."),
    )
    once = E.run_notes(E.enrichment_note(missing), carried)
    staged = docs.select("listing_id", missing.alias("missing"), once.alias("notes"))
    again = E.run_notes(E.enrichment_note(F.col("missing")), F.col("notes"))
    return staged.select("listing_id", F.array_join("notes", " / ").alias("notes"), (again == F.col("notes")).alias("settled"))


def tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_listing")
    return R.tallies(rows, ["property_type", "beds", "baths", "car_spaces", "suburb_key"])


def price_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.price_report(view(spark, sf_dir, "v_listing"))


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as source listings."""
    d = view(spark, sf_dir, "v_doc")
    none = F.lit(None).cast("string")
    return d.select(
        F.when(F.col("doc_id") % 50 == 0, F.lit("")).otherwise(F.col("listing_id")).alias("listing_id"), none.alias("url"), "address",
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" "), F.col("lang"), F.lit("-Ville "))).alias("suburb"), none.alias("state"),
        F.when(F.col("doc_id") % 9 == 0, F.lit("20x0")).when(F.col("doc_id") % 3 == 0, F.lit("2010")).alias("postcode"),
        F.col("price_text").alias("price"), F.col("property_text").alias("propertyType"), "bedrooms",
        F.lit(None).cast("int").alias("bathrooms"), (F.col("doc_id") % 3).cast("int").alias("carSpaces"),
        F.col("size_text").alias("buildingSize"), "description",
        F.array(F.concat(F.lit("https://img.example.com/800x600/"), F.col("listing_id"), F.lit(".jpg"))).alias("images"),
        F.lit(None).cast("struct<lat:double,lng:double>").alias("coords"),
        F.lit(None).cast("map<string,struct<minutes:double,km:double,mode:string,precision:string>>").alias("travel"),
    )


def normalise_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(source_rows(spark, sf_dir), "https://example.com/").select(
        "listing_id", "problem", "url", "address", "suburb", "postcode", "state", "suburb_key", "price_pw",
        "price_text", "beds", "baths", "car_spaces", "area_sqm", "area_source", "property_type",
        F.get("image_urls", F.lit(0)).alias("image_url"),
    )


def mapping_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listingflow.operators.normalise import problems

    return problems(normalise(source_rows(spark, sf_dir), "https://example.com/"))


#: One capture document per event, some of them faulty.
VIEWS["v_document"] = """
select event_id, case when event_id % 17 = 0 then left(text, 30) else text end as text from (
  select event_id, chr(123) || '"source": ' || case when event_id % 7 = 0 then '3' else '"s"' end || ', '
    || case when event_id % 5 = 0 then '' else '"captured_at": "t", ' end || '"groups": [' || chr(123) || '"origin": "office", "mode": "'
    || case event_type when 'error' then 'fly' else 'walk' end || '", "max_travel_minutes": 15, "results": [' || chr(123) || '"id": "'
    || cast(user_id as string) || '", "address": "a", "bedrooms": ' || case when event_id % 11 = 0 then '1.5' else '2' end || chr(125)
    || case when event_id % 13 = 0 then ', ' || chr(123) || '"id": 4' || chr(125) else '' end || ']' || chr(125) || ']' || chr(125) as text
  from {events})
"""


def document_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each capture document, by the path of the field."""
    return faults.fault_rows(view(spark, sf_dir, "v_document"), "event_id", "text", CAPTURE, faults.CAPTURE_RULES)


QUERIES = {
    "document_faults": document_faults,
    "flatten_capture": flatten_capture, "group_totals": group_totals, "blank_addresses": blank_addresses,
    "keyword_exclusion": keyword_exclusion, "travel_budget": travel_budget, "travel_rejects": travel_rejects,
    "travel_report": travel_report, "page_reports": page_reports, "funnel": funnel, "coverage": coverage,
    "searched_locations": searched_locations, "run_notes": run_notes, "tallies": tallies, "price_report": price_report,
    "normalise_listings": normalise_listings, "mapping_problems": mapping_problems,
}

_POS = "(group_pos, row_pos)"


def _last(mode: str) -> str:
    test = f"travel_key = 'office:{mode}' and minutes is not null"
    return f"arg_max(minutes, row_pos) filter ({test}) as {mode}_minutes, arg_max(precision, row_pos) filter ({test}) as {mode}_precision"


PRICE_SQL = """case when regexp_matches(lower({p}), '\\b(per month|pcm|per annum|p\\.?a\\.?)\\b') and not regexp_matches(lower({p}), 'week|pw|p/w') then null
  else (select cast(floor(min(v) + 0.5::double) as int) from (select try_cast(replace(unnest(regexp_extract_all({p}, '\\$\\s*([0-9,]+(?:\\.[0-9]+)?)', 1)), ',', '') as double) as v) where v between 100 and 5000) end"""
AREA_SQL = """case when try_cast(replace(regexp_extract(size_text, '([0-9,]+(?:\\.[0-9]+)?)', 1), ',', '') as double) between 15 and 600
  then cast(floor(try_cast(replace(regexp_extract(size_text, '([0-9,]+(?:\\.[0-9]+)?)', 1), ',', '') as double) + 0.5::double) as int) end"""
TYPE_SQL = """case when regexp_matches(lower(t), '\\bterrace\\b') then 'terrace' when regexp_matches(lower(t), '\\bduplex\\b') then 'duplex'
  when regexp_matches(lower(t), '\\btown\\s?house\\b') then 'townhouse' when regexp_matches(lower(t), '\\bvilla\\b') then 'townhouse'
  when regexp_matches(lower(t), '\\bstudio\\b') then 'other' when regexp_matches(lower(t), '\\b(apartment|penthouse)\\b') then 'apartment'
  when regexp_matches(lower(t), '\\b(unit|flat)\\b') then 'unit' when regexp_matches(lower(t), '\\b(house|semi[-\\s]?detached|cottage)\\b') then 'house' else 'other' end"""
_TAIL = "',\\s*([^,]+?),?\\s+([A-Z]{2,3})\\s+([0-9]{4})\\s*$'"
NORMALISED = f"""
src as (select case when doc_id % 50 = 0 then '' else listing_id end as lid, listing_id as photo_id, address, doc_id,
    case when doc_id % 3 = 0 then ' ' || lang || '-Ville ' end as sub, case when doc_id % 9 = 0 then '20x0' when doc_id % 3 = 0 then '2010' end as pc,
    regexp_matches(trim(address), {_TAIL}) as has_tail, price_text as p, property_text as t, size_text, bedrooms
  from v_doc),
placed as (select *, trim(coalesce(sub, case when has_tail then trim(regexp_extract(trim(address), {_TAIL}, 1)) end, '')) as suburb,
    trim(coalesce(pc, case when has_tail then regexp_extract(trim(address), {_TAIL}, 3) end, '')) as postcode,
    trim(coalesce(case when has_tail then regexp_extract(trim(address), {_TAIL}, 2) end, 'NSW')) as state from src),
normalised as (select case when lid = '' then '(missing)' else lid end as listing_id,
    case when lid = '' then 'no listing id' when suburb = '' or not regexp_matches(postcode, '^[0-9]{{4}}$') then 'unusable suburb/postcode ("' || suburb || '" ' || postcode || ')'
      when trim(address) = '' then 'no address' end as problem,
    'https://example.com/' || lid as url, trim(address) as address, suburb, postcode, state,
    trim(regexp_replace(lower(suburb), '[^a-z0-9]+', '-', 'g'), '-') || '-' || postcode as suburb_key,
    {PRICE_SQL.format(p='p')} as price_pw, trim(p) as price_text, coalesce(bedrooms, 0) as beds, 0 as baths, cast(doc_id % 3 as int) as car_spaces,
    {AREA_SQL} as area_sqm, case when ({AREA_SQL}) is not null then 'listing_text' end as area_source, {TYPE_SQL} as property_type,
    'https://img.example.com/1600x1200/' || photo_id || '.jpg' as image_url from placed)
"""
_COUNTS = ", ".join(
    f"cast(sum(case when k % {i + 2} <> 0 then k + {i} else 0 end) as bigint) as {name}" for i, name in enumerate(C.REPORT_COUNTS)
)
_MISS = "case when doc_id % 3 = 0 then 'No listing in this run has walkability, so the scoring factor that reads it sat out of every composite and confidence is lower than a fully enriched run''s. Run the enrich stages and replay this run to fill it in. / ' when doc_id % 3 = 1 then 'No listing in this run has a routed commute time or walkability, so the scoring factors that read them sat out of every composite and confidence is lower than a fully enriched run''s. Run the enrich stages and replay this run to fill them in. / ' else '' end"

ORACLES = {
    "document_faults": with_views(
        ["v_document"],
        "with e as (select event_id, event_type, event_id % 17 = 0 as cut from events) select event_id, '(root)' as path, 'not valid JSON' as fault from e where cut"
        + "".join(
            f" union all select event_id, '{path}', '{fault}' from e where not cut and {where}"
            for path, fault, where in (
                ("source", "expected string, found number", "event_id % 7 = 0"), ("captured_at", "required", "event_id % 5 = 0"),
                ("groups.0.mode", "expected one of walk, drive, transit, found fly", "event_type = 'error'"),
                ("groups.0.results.0.bedrooms", "expected a whole number", "event_id % 11 = 0"),
                ("groups.0.results.1.id", "expected string, found number", "event_id % 13 = 0"), ("groups.0.results.1.address", "required", "event_id % 13 = 0"),
            )
        ),
    ),
    "flatten_capture": with_views(
        ["v_capture"],
        f"""select listing_id, arg_min(address, {_POS}) as address, arg_min(price, {_POS}) as price, arg_min(bedrooms, {_POS}) as bedrooms,
        {_last('walk')}, {_last('drive')}, {_last('transit')} from v_capture group by listing_id""",
    ),
    "group_totals": with_views(["v_capture"], "select travel_key, count(distinct listing_id) as considered from v_capture group by travel_key"),
    "blank_addresses": with_views(
        ["v_capture"],
        f"select listing_id, count(*) as occurrences, arg_min(group_pos, {_POS}) as group_pos, arg_min(row_pos, {_POS}) as row_pos from v_capture where trim(address) = '' group by listing_id",
    ),
    "keyword_exclusion": with_views(
        ["v_doc"],
        "select * from (select listing_id, case "
        + " ".join(
            f"when regexp_matches(lower(property_text || ' ' || address), '\\b{pattern}') then '{word}'"
            for word, pattern in zip(KEYWORDS, ["studio", "room", "house boat", "st\\. cl"])
        )
        + " end as keyword from v_doc) where keyword is not null",
    ),
    "travel_budget": with_views(["v_capture"], "select row_pos, listing_id, minutes from v_capture where minutes is null or minutes <= 30"),
    "travel_rejects": with_views(["v_capture"], "select listing_id, url, address, 'NSW' as state, minutes, km from v_capture where minutes > 30"),
    "travel_report": with_views(
        ["v_capture"],
        """select mode, cast(count(*) as bigint) as listings, count(distinct lower(trim(address))) as unique_buildings, cast(count(minutes) as bigint) as routed,
        cast(count(*) - count(minutes) as bigint) as unresolved, count(*) filter (minutes is not null and precision = 'building') as building,
        count(*) filter (minutes is not null and precision = 'street') as street, count(*) filter (minutes is not null and precision = 'area') as area
        from v_capture group by mode""",
    ),
    "page_reports": with_views(
        ["v_event"],
        f"""select 'office:' || mode as travel_key, arg_min('office ' || user_id, event_id) filter (k % 5 <> 0) as origin,
        arg_min(mode, event_id) filter (k % 2 = 0) as mode, case when count(*) filter (k > 50) > 0 then 'router' end as router, null::varchar as geocoder,
        {_COUNTS} from v_event where k % 3 <> 0 group by v_event.mode""",
    ),
    "funnel": with_views(
        ["v_capture"],
        f"""with per as (select listing_id, count(*) as n, arg_min(address, {_POS}) as address,
          arg_max(minutes, row_pos) filter (mode = 'walk' and minutes is not null) as walk from v_capture group by listing_id),
        marked as (select *, regexp_matches(address, '\\b7 Nation') as ex, trim(address) = '' as bad from per)
        select cast(sum(n) as bigint) as captured, count(*) as unique_listings, count(*) filter (not ex and not bad) as usable, count(*) filter (ex) as excluded,
        count(*) filter (not ex and bad) as problems, count(*) filter (not ex and not bad and walk <= 30) as matched from marked""",
    ),
    "coverage": with_views(
        ["v_place"],
        "select canonical as location from v_place where nationkey not in (select s_nationkey from supplier where s_acctbal > 8000)",
    ),
    "searched_locations": with_views(
        ["v_place"],
        """select canonical as location from v_place where nationkey in (select s_nationkey from supplier where s_acctbal > 8000)
        and (select count(*) from v_place where nationkey not in (select s_nationkey from supplier where s_acctbal > 8000)) > 0""",
    ),
    "run_notes": with_views(["v_doc"], f"select listing_id, {_MISS} || 'Partial search: ' || source as notes, true as settled from v_doc"),
    "tallies": with_views(
        ["v_listing"],
        " union all ".join(
            f"select '{f}' as field, cast({f} as varchar) as value, count(*) as listings from v_listing group by {f}"
            for f in ("property_type", "beds", "baths", "car_spaces", "suburb_key")
        ),
    ),
    "price_report": with_views(
        ["v_listing"],
        """with sorted as (select price_pw, row_number() over (order by price_pw) - 1 as i, count(*) over () as n from v_listing where price_pw is not null)
        select (select count(*) from v_listing) as listings, (select count(price_pw) from v_listing) as priced, (select min(price_pw) from v_listing) as lowest,
        (select max(price_pw) from v_listing) as highest, (select price_pw from sorted where i = n // 2) as upper_median,
        (select count(area_sqm) from v_listing) as with_area, (select count(lat) from v_listing) as with_position""",
    ),
    "normalise_listings": with_views(["v_doc"], f"with {NORMALISED} select * from normalised"),
    "mapping_problems": with_views(["v_doc"], f"with {NORMALISED} select listing_id, problem as reason from normalised where problem is not null"),
}
