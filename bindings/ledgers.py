"""Queries over the ledger: folding, absence, history, rejections, photos."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.operators import ledger as L
from listingflow.operators import photos as P
from listingflow.operators.rejected import fold_rejected
from listingflow.session import checkpoint_root
from listingflow.sources import ledger_versions

from .views import VIEWS, table, view, with_views

RUN, PREVIOUS = "2024-02-01a", "2024-01-30"
#: What the ledger of these queries stores.
STORED = """
    listing_id STRING, url STRING, address STRING, suburb STRING, postcode STRING, lat DOUBLE, lon DOUBLE, first_seen_run STRING, last_seen_run STRING,
    status STRING, status_history ARRAY<STRUCT<run: STRING, status: STRING>>, price_history ARRAY<STRUCT<run: STRING, price_pw: INT>>, relist_count INT,
    facts_last STRUCT<beds: INT, baths: INT, car_spaces: INT, area_sqm: INT>, image_urls ARRAY<STRING>, image_files ARRAY<STRING>
"""

VIEWS["v_ledger"] = """
select cast(user_id as string) as listing_id, user_id, min(substr(cast(ts as string), 1, 10)) as first_run,
  max(substr(cast(ts as string), 1, 10)) as last_run,
  case user_id % 5 when 0 then 'leased' when 1 then 'unmatched' when 2 then 'stale' else 'active' end as status,
  case when user_id % 9 = 0 then null else cast(300 + 50 * floor(min(value) / 5e0) as int) end as price_pw,
  case when user_id % 4 = 0 then null else user_id / 1e3 end as lat
from {v_event} group by user_id
"""
VIEWS["v_new"] = """
select cast(user_id + 75 as string) as listing_id, user_id + 75 as user_id,
  case when user_id % 11 = 0 then null else cast(300 + 50 * floor(min(value) / 5e0) as int) end as price_pw,
  case when user_id % 3 = 0 then null else user_id / 1e3 end as lat, cast(min(k) % 5 as int) as beds
from {v_event} group by user_id
"""
VIEWS["v_back"] = """
select distinct cast(user_id + case when event_type = 'signup' and value > 60 then 40 else 75 end as string) as listing_id from {v_event}
"""
VIEWS["v_verdict"] = """
select listing_id, case when first_k % 3 = 0 then 'leased' when first_k % 3 = 1 then 'unmatched' else 'withdrawn' end as verdict
from (select listing_id, min(case when event_type = 'error' and value > 80 then k end) as first_k from {v_event} group by listing_id) as per_listing
where first_k is not null
"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = view(spark, sf_dir, "v_ledger")

    def point(run: str, name: str, value):
        return F.struct(F.col(run).alias("run"), value.alias(name))

    return v.select(
        "listing_id", F.concat(F.lit("u"), "listing_id").alias("url"), F.lit("old").alias("address"),
        F.lit("s").alias("suburb"), F.lit("2000").alias("postcode"), "lat", F.col("lat").alias("lon"),
        F.col("first_run").alias("first_seen_run"), F.col("last_run").alias("last_seen_run"), "status",
        F.when(F.col("status") == "active", F.array(point("first_run", "status", F.lit("active"))))
        .otherwise(F.array(point("first_run", "status", F.lit("active")), point("last_run", "status", F.col("status"))))
        .alias("status_history"),
        F.array(point("first_run", "price_pw", F.col("price_pw"))).alias("price_history"),
        (F.col("user_id") % 2).cast("int").alias("relist_count"),
        F.struct(*[(F.col("user_id") % (i + 2)).cast("int").alias(n) for i, n in enumerate(L.FACTS)]).alias("facts_last"),
        F.array(F.lit("a")).alias("image_urls"), F.array(F.lit("01.webp")).alias("image_files"),
    )


def new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_new").select(
        "listing_id", F.concat(F.lit("n"), "listing_id").alias("url"), F.lit("new").alias("address"),
        F.lit("s").alias("suburb"), F.lit("2001").alias("postcode"), "lat", F.col("lat").alias("lon"), "price_pw",
        "beds", F.lit(1).alias("baths"), F.lit(0).alias("car_spaces"), F.lit(None).cast("int").alias("area_sqm"),
    )


def folded(spark: SparkSession, sf_dir: str, allow_stale: bool) -> DataFrame:
    return L.fold_run(
        ledger(spark, sf_dir), new_rows(spark, sf_dir), view(spark, sf_dir, "v_back"),
        view(spark, sf_dir, "v_verdict"), RUN, PREVIOUS, allow_stale,
    )


def ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = folded(spark, sf_dir, True)
    return f.select(
        "listing_id", "url", "address", "postcode", "lat", "first_seen_run", "last_seen_run", "status",
        F.array_join(F.transform("status_history", lambda p: F.concat_ws(":", p["run"], p["status"])), ",").alias("status_history"),
        F.array_join(F.transform("price_history", lambda p: F.concat_ws(":", p["run"], F.coalesce(p["price_pw"].cast("string"), F.lit("-")))), ",").alias("price_history"),
        "relist_count", F.col("facts_last.beds").alias("beds"), F.size("image_files").alias("image_files"),
        "state", "prev_pw", "delta_pw", "absent_status", "absent",
    )


def ledger_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fold after a partial search: nothing may go stale."""
    f = folded(spark, sf_dir, False).filter("absent")
    return f.select("listing_id", "status", "absent_status", F.size("status_history").alias("points"))


def ledger_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold of ``ledger_merge`` into a ledger kept in buckets, as read back from its new version."""
    root = f"{checkpoint_root(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    ledger_versions.start_versions(ledger(spark, sf_dir), root, PREVIOUS)
    ledger_versions.fold_version(
        spark, root, PREVIOUS, new_rows(spark, sf_dir), view(spark, sf_dir, "v_back"), view(spark, sf_dir, "v_verdict"), RUN, PREVIOUS, True, schema=STORED,
    )
    return ledger_versions.read_version(spark, root, RUN, STORED).select(
        "listing_id", "url", "address", "postcode", "lat", "first_seen_run", "last_seen_run", "status",
        F.array_join(F.transform("status_history", lambda p: F.concat_ws(":", p["run"], p["status"])), ",").alias("status_history"),
        F.array_join(F.transform("price_history", lambda p: F.concat_ws(":", p["run"], F.coalesce(p["price_pw"].cast("string"), F.lit("-")))), ",").alias("price_history"),
        "relist_count", F.col("facts_last.beds").alias("beds"), F.size("image_files").alias("image_files"),
    )


def absence_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.absent_listings(
        ledger(spark, sf_dir), view(spark, sf_dir, "v_back"), view(spark, sf_dir, "v_verdict")
    ).select("listing_id", "last_seen_run")


def absence_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = view(spark, sf_dir, "v_doc")
    pages = d.select(
        "listing_id", (F.col("n_chars") % 4 != 0).alias("fetched"),
        F.when(F.col("doc_id") % 5 == 0, F.lit("LEASED")).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("Deposit taken "), "price_text"))
        .otherwise(F.col("price_text")).alias("price"),
    )
    return L.absence_verdicts(pages)


def partial_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelope = view(spark, sf_dir, "v_place")
    searched = table(spark, sf_dir, "supplier").filter("s_acctbal > 8000").select("s_nationkey").distinct()
    p = L.partial_search(searched, envelope)
    return p.select("*", L.partial_note(F.col("searched"), F.col("configured"), F.lit("...")).alias("note"))


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, "v_event")
    return e.select(
        "listing_id", F.substring(F.col("ts").cast("string"), 1, 10).alias("run_id"),
        (F.lit(300) + 50 * F.floor(F.col("value") / 50)).cast("int").alias("price_pw"),
    )


def ledger_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = sightings(spark, sf_dir)
    runs = seen.select("run_id").distinct().select(
        "run_id", F.date_diff(F.to_date("run_id"), F.lit("2024-01-01").cast("date")).alias("run_pos")
    )
    return L.sighting_history(seen, runs)


def rejected_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    leg = F.struct("minutes", "km", "mode", "precision")
    now = view(spark, sf_dir, "v_rejection").withColumn("travel", F.when(F.col("minutes").isNotNull(), leg))
    earlier = view(spark, sf_dir, "v_event").filter("event_type = 'view'").groupBy("user_id").agg(F.min("k").alias("k"))
    address = F.concat((F.lit(1) + F.col("user_id") % 90).cast("string"), F.when(F.col("user_id") % 2 == 0, F.lit("A")).otherwise(F.lit("")), F.lit(" Far St"))
    previous = earlier.select(
        (F.col("user_id") + 75).cast("string").alias("listing_id"), F.lit("old").alias("url"), address.alias("address"),
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"),
        F.create_map(
            F.lit("office:walk"),
            F.struct(
                F.col("k").cast("double").alias("minutes"), F.lit(1.0).alias("km"), F.lit("walk").alias("mode"),
                F.lit("street").alias("precision"), F.lit("then").alias("computed_at"), address.alias("address"),
            ),
            F.lit("home:walk"),
            F.struct(
                F.lit(5.0).alias("minutes"), F.lit(1.0).alias("km"), F.lit("walk").alias("mode"),
                F.lit("street").alias("precision"), F.lit("then").alias("computed_at"), address.alias("address"),
            ),
        ).alias("travel"),
        F.lit("2024-01-01a").alias("last_seen_run"),
    )
    tracked = view(spark, sf_dir, "v_ledger").filter("status <> 'active'").select("listing_id")
    out = fold_rejected(previous, now, tracked, RUN, "2024-02-01T00:00:00Z")
    legs = []
    for key in ("office:walk", "office:drive", "office:transit", "home:walk"):
        leg = F.try_element_at(F.col("travel"), F.lit(key))
        legs += [leg["minutes"].alias(key.replace(":", "_")), leg["computed_at"].alias(key.replace(":", "_") + "_at")]
    return out.select("listing_id", "url", "address", "lat", "lon", "last_seen_run", *legs)


def photo_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = view(spark, sf_dir, "v_doc")

    def urls(upto):
        return F.transform(F.sequence(F.lit(1), upto), lambda i: F.concat(F.lit("p"), i.cast("string")))

    rows = d.select(
        "listing_id", urls((F.col("n_chars") % 12 + 1).cast("int")).alias("image_urls"),
        F.when(F.col("doc_id") % 3 != 0, urls((F.col("n_chars") % 4 + 1).cast("int"))).alias("known_urls"),
        F.when(F.col("doc_id") % 3 != 0, F.transform(
            F.sequence(F.lit(1), (F.col("n_chars") % 4 + 1).cast("int")),
            lambda i: F.concat(F.lpad((i + F.col("doc_id") % 2).cast("int").cast("string"), 2, "0"), F.lit(".webp")),
        )).alias("files"),
    )
    return P.photo_plan(rows)


def orphan_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs are order years; the years of the smallest orders are removed. Keys come from documents and orders."""
    o = table(spark, sf_dir, "orders")
    runs = o.select(F.col("o_custkey").cast("string").alias("listing_id"), F.year("o_orderdate").cast("string").alias("run_id"))
    removed = runs.select("run_id").distinct().filter("run_id < '2000'")
    doomed = P.doomed_listings(runs, removed)
    keys = o.select(
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("images/listings/"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".webp")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("/images/listings/"), F.col("o_custkey").cast("string"), F.lit("/01.webp")))
        .otherwise(F.concat(F.lit("images/oldlistings/"), F.col("o_custkey").cast("string"), F.lit("/01.webp"))).alias("key")
    )
    return P.orphan_media(keys, doomed)


def run_removal(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs are order years, published listings the customers; every second year is removed."""
    o = table(spark, sf_dir, "orders")
    runs = o.select(F.col("o_custkey").cast("string").alias("listing_id"), F.year("o_orderdate").cast("string").alias("run_id"))
    years = runs.select("run_id").distinct().withColumn("position", F.col("run_id").cast("bigint"))
    return runs, years, years.filter("position % 2 = 0").select("run_id")


def cleared_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's photo record after the removal."""
    runs, _, removed = run_removal(spark, sf_dir)
    files = F.transform(F.sequence(F.lit(0), F.col("c_custkey") % 3), lambda i: F.concat(F.lit("0"), i.cast("string"), F.lit(".webp")))
    ledger = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("listing_id"), F.array("c_name").alias("image_urls"), files.alias("image_files")
    )
    left = P.cleared_photos(ledger, P.doomed_listings(runs, removed))
    return left.select("listing_id", F.array_join("image_urls", ",").alias("urls"), F.size("image_files").alias("files"))


def current_runs_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each year as the current run: what is shown after the removal."""
    _, years, removed = run_removal(spark, sf_dir)
    left = [P.current_run_after(years, removed, current).select(F.lit(current).alias("was"), "current_run") for current in ("1995", "1996", "2051")]
    return left[0].unionByName(left[1]).unionByName(left[2])


QUERIES = {
    "cleared_photos": cleared_photos, "current_run_after": current_runs_after,
    "ledger_merge": ledger_merge, "ledger_version": ledger_version, "ledger_absent": ledger_absent, "absence_set": absence_set,
    "absence_verdicts": absence_verdicts, "partial_search": partial_search, "ledger_history": ledger_history,
    "rejected_fold": rejected_fold, "photo_plan": photo_plan, "orphan_media": orphan_media,
}

_FOLD = """
fold as (select coalesce(o.listing_id, n.listing_id) as listing_id, o.listing_id is not null as known, n.listing_id is not null as seen, o.status as was, o.first_run, o.last_run,
    o.price_pw as oldp, n.price_pw as newp, o.lat as olat, n.lat as nlat, o.user_id as ou, n.beds as nbeds,
    o.listing_id is not null and n.listing_id is null and o.status = 'active' and coalesce(o.listing_id, n.listing_id) not in (select listing_id from v_back) as absent, v.verdict
  from v_ledger o full outer join v_new n on o.listing_id = n.listing_id left join v_verdict v on v.listing_id = coalesce(o.listing_id, n.listing_id)),
fated as (select *, case when absent then coalesce(verdict, case when {stale} and last_run <> '2024-01-30' then 'stale' end) end as fate, oldp is distinct from newp as moved,
    oldp is distinct from newp and oldp is not null and newp is not null as priced from fold)
"""
_STALE = _FOLD.format(stale="true")
_HISTORY = """
per_run as (select listing_id, substr(cast(ts as varchar), 1, 10) as run_id, cast(300 + 50 * floor(min(value) / 50) as int) as price_pw from v_event group by 1, 2),
pos as (select *, cast(date_diff('day', date '2024-01-01', cast(run_id as date)) as int) as run_pos from per_run),
step as (select *, lag(run_pos) over w as prev_pos, lag(price_pw) over w as prev_price, min(run_id) over (partition by listing_id) as first_seen_run from pos window w as (partition by listing_id order by run_pos)),
marked as (select *, coalesce(run_pos - prev_pos - 1, 0) as missed, prev_pos is not null and price_pw <> prev_price as moved from step)
"""

ORACLES = {
    "ledger_merge": with_views(
        ["v_ledger", "v_new", "v_back", "v_verdict"],
        f"""with {_STALE} select listing_id, case when seen then 'n' else 'u' end || listing_id as url, case when seen then 'new' else 'old' end as address,
        case when seen then '2001' else '2000' end as postcode, coalesce(nlat, olat) as lat, coalesce(first_run, '{RUN}') as first_seen_run,
        case when seen then '{RUN}' else last_run end as last_seen_run, case when seen then 'active' else coalesce(fate, was) end as status,
        case when not known then '{RUN}:active' else first_run || ':active' || case when was <> 'active' then ',' || last_run || ':' || was else '' end
          || case when seen and was <> 'active' then ',{RUN}:active' when fate is not null then ',{RUN}:' || fate else '' end end as status_history,
        case when not known then '{RUN}:' || coalesce(cast(newp as varchar), '-') else first_run || ':' || coalesce(cast(oldp as varchar), '-')
          || case when seen and moved then ',{RUN}:' || coalesce(cast(newp as varchar), '-') else '' end end as price_history,
        cast(case when not known then 0 else ou % 2 + case when seen and was in ('leased', 'withdrawn', 'stale') then 1 else 0 end end as int) as relist_count,
        case when seen then nbeds else cast(ou % 2 as int) end as beds, case when known then 1 end as image_files,
        case when not seen then null when not known then 'new' when was in ('leased', 'withdrawn', 'stale') then 'relisted' when priced then 'price_drop' else 'carried_over' end as state,
        case when known and seen and priced then oldp end as prev_pw, case when known and seen and priced then newp - oldp end as delta_pw, fate as absent_status, absent from fated""",
    ),
    "ledger_absent": with_views(
        ["v_ledger", "v_new", "v_back", "v_verdict"],
        f"with {_FOLD.format(stale='false')} select listing_id, coalesce(fate, was) as status, fate as absent_status, case when fate is null then 1 else 2 end as points from fated where absent",
    ),
    "absence_set": with_views(
        ["v_ledger", "v_back", "v_verdict"],
        "select listing_id, last_run as last_seen_run from v_ledger where status = 'active' and listing_id not in (select listing_id from v_back) and listing_id not in (select listing_id from v_verdict)",
    ),
    "absence_verdicts": with_views(
        ["v_doc"],
        """with p as (select listing_id, n_chars % 4 <> 0 as fetched, case doc_id % 5 when 0 then 'LEASED' when 1 then 'Deposit taken ' || price_text else price_text end as price from v_doc)
        select listing_id, case when fetched then case when regexp_matches(lower(price), 'leased|under application|deposit taken|application approved') then 'leased' else 'unmatched' end end as verdict,
        case when fetched then case when price = '' then 'page live' else price end end as evidence from p""",
    ),
    "partial_search": with_views(
        ["v_place"],
        """with c as (select (select count(distinct s_nationkey) from supplier where s_acctbal > 8000) as searched, (select count(*) from v_place) as configured)
        select searched, configured, searched > 0 and searched < configured as partial, 'Partial search: ' || searched || ' of ' || configured || ' configured locations were queried (...). Listings from the remaining '
        || (configured - searched) || ' are absent because they were never searched, not because none exist — so no listing was marked stale this run.' as note from c""",
    ),
    "ledger_history": with_views(
        ["v_event"],
        f"""with {_HISTORY} select listing_id, run_id, run_pos, first_seen_run, price_pw,
        case when prev_pos is null then 'new' when missed >= 2 then 'relisted' when moved then 'price_drop' else 'carried_over' end as state,
        case when moved then prev_price end as prev_pw, case when moved then price_pw - prev_price end as delta_pw, missed as missed_runs,
        cast(sum(case when missed >= 2 then 1 else 0 end) over (partition by listing_id order by run_pos) as int) as relist_count from marked""",
    ),
    "rejected_fold": with_views(
        ["v_rejection", "v_event", "v_ledger"],
        f"""with linked as (select *, (group_pos, row_pos) as pos from v_rejection where url is not null),
        last as (select listing_id, arg_max(address, pos) as address, arg_max(url, pos) as url, arg_max(lat, pos) as lat, arg_max(lon, pos) as lon from linked group by listing_id),
        cut as (select l.listing_id, max(l.pos) as broken from linked l join last using (listing_id) where l.address <> last.address group by l.listing_id),
        legs as (select l.listing_id, l.travel_key, arg_max(l.minutes, l.pos) as minutes from linked l left join cut using (listing_id) where l.minutes is not null and (cut.broken is null or l.pos > cut.broken) group by 1, 2),
        prev as (select cast(user_id + 75 as varchar) as listing_id, min(k) as k, cast(1 + user_id % 90 as varchar) || case when user_id % 2 = 0 then 'A' else '' end || ' Far St' as address from v_event where event_type = 'view' group by user_id),
        both_sides as (select coalesce(p.listing_id, n.listing_id) as listing_id, n.listing_id is not null as now, p.k, p.address as paddr, n.url, n.address, n.lat, n.lon,
            p.listing_id is not null and (n.listing_id is null or (c.broken is null and p.address = n.address)) as keeps,
            (select minutes from legs where legs.listing_id = n.listing_id and travel_key = 'office:walk') as w, (select minutes from legs where legs.listing_id = n.listing_id and travel_key = 'office:drive') as d,
            (select minutes from legs where legs.listing_id = n.listing_id and travel_key = 'office:transit') as t
          from prev p full outer join last n on p.listing_id = n.listing_id left join cut c on c.listing_id = n.listing_id)
        select listing_id, case when now then url else 'old' end as url, case when now then address else paddr end as address, case when now then lat else 0.0::double end as lat, case when now then lon else 0.0::double end as lon,
        case when now then '{RUN}' else '2024-01-01a' end as last_seen_run, coalesce(w, case when keeps then k::double end) as office_walk, case when w is not null then '2024-02-01T00:00:00Z' when keeps then 'then' end as office_walk_at,
        d as office_drive, case when d is not null then '2024-02-01T00:00:00Z' end as office_drive_at, t as office_transit, case when t is not null then '2024-02-01T00:00:00Z' end as office_transit_at,
        case when keeps then 5.0::double end as home_walk, case when keeps then 'then' end as home_walk_at
        from both_sides where listing_id not in (select listing_id from v_ledger where status <> 'active')""",
    ),
    "photo_plan": with_views(
        ["v_doc"],
        """with u as (select listing_id, doc_id, n_chars % 12 + 1 as offered, case when doc_id % 3 <> 0 then n_chars % 4 + 1 else 0 end as have from v_doc),
        p as (select listing_id, unnest(range(have + 1, offered + 1)) as i, have, case when have > 0 then have + doc_id % 2 else 0 end as highest from u)
        select listing_id, 'p' || i as url, lpad(cast(highest + i - have as varchar), 2, '0') || '.webp' as file from p where i <= 8""",
    ),
    "cleared_photos": """
        with runs as (select cast(o_custkey as varchar) as listing_id, year(o_orderdate) as y from orders),
        doomed as (select listing_id from runs group by listing_id having bool_and(y % 2 = 0))
        select cast(c_custkey as varchar) as listing_id, case when d.listing_id is null then c_name else '' end as urls,
        cast(case when d.listing_id is null then 1 + c_custkey % 3 else 0 end as int) as files from customer left join doomed d on d.listing_id = cast(c_custkey as varchar)""",
    "current_run_after": """
        with left_over as (select distinct year(o_orderdate) as y from orders where year(o_orderdate) % 2 = 1)
        select was, cast(max_by(y, (case when cast(y as varchar) = was then 1 else 0 end, y)) as varchar) as current_run
        from left_over, (select unnest(['1995', '1996', '2051']) as was) group by was""",
    "orphan_media": """
        with runs as (select cast(o_custkey as varchar) as listing_id, cast(year(o_orderdate) as varchar) as run_id, * from orders),
        doomed as (select listing_id from runs group by listing_id having max(run_id) < '2000')
        select case o_orderstatus when 'F' then 'images/listings/' || listing_id || '/' || o_orderkey || '.webp' else '/images/listings/' || listing_id || '/01.webp' end as key, listing_id
        from runs where o_orderstatus in ('F', 'O') and listing_id in (select listing_id from doomed)""",
}

# The same fold, without what the run decided beside each row.
ORACLES["ledger_version"] = f"""
    select listing_id, url, address, postcode, lat, first_seen_run, last_seen_run, status, status_history, price_history, relist_count, beds, image_files
    from ({ORACLES["ledger_merge"]}) as merged"""
