"""The predicate index against searches that stand in the plan, on many searches and odd rows."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from listingflow.config import SavedSearch
from listingflow.operators import predicates as P
from listingflow.operators import searches as Q

ROW = "id int, price_pw int, beds int, baths int, car_spaces int, property_type string, flags array<string>, row_no string, travel map<string, struct<minutes: double>>"


def some_searches(rng: random.Random, n: int) -> list[SavedSearch]:
    maybe = lambda value: value if rng.random() < 0.5 else None
    return [
        SavedSearch(
            f"s{k}", "office", rng.choice(["walk", "drive"]), rng.choice([5, 10, 10.5, 30]), f"S{k}", max_price_pw=maybe(rng.randrange(400, 900, 50)),
            min_price_pw=maybe(rng.randrange(300, 800, 50)), min_beds=maybe(rng.randrange(4)), max_beds=maybe(rng.randrange(4)), min_baths=maybe(rng.randrange(3)),
            min_car_spaces=maybe(rng.randrange(3)), property_types=maybe(tuple(rng.sample(["unit", "house", "villa"], 2))),
            exclude_flagged=tuple(rng.sample(["studio", "share_house", "no_price"], rng.randrange(3))),
        )
        for k in range(n)
    ]


def some_rows(rng: random.Random, n: int) -> list[tuple]:
    maybe = lambda value: None if rng.random() < 0.15 else value
    minutes = lambda: maybe(rng.choice([4.9, 5.0, 10.0, 10.5, 29.9, 31.0, float("nan")]))
    flags = lambda: maybe(rng.choice([[], ["studio"], ["share_house", "other"], ["studio", None], ["no_price"]]))
    legs = lambda: maybe({k: (minutes(),) for k in rng.sample(["office:walk", "office:drive", "home:walk"], 2)})
    rows = [
        (k % (n - 5), maybe(rng.randrange(300, 900, 25)), maybe(rng.randrange(5)), maybe(rng.randrange(4)), maybe(rng.randrange(4)), maybe(rng.choice(["unit", "house", "flat"])), flags(), "kept", legs())
        for k in range(n)
    ]
    return rows


def test_index_agrees_with_literal_predicates(spark):
    rng = random.Random(21)
    searches = some_searches(rng, 60)
    rows = spark.createDataFrame(some_rows(rng, 400), ROW).repartition(3)
    literal = Q.match_searches(rows, searches)
    indexed = P.match_search_index(rows, Q.searches_frame(spark, searches), block=16)
    assert indexed.columns == literal.columns
    plain = lambda df: Counter(str(r) for r in df.collect())
    assert plain(indexed) == plain(literal)
    none = P.match_search_index(rows, Q.searches_frame(spark, []))
    assert none.count() == 400 and none.where(F.size("matched_searches") > 0).count() == 0
    assert P.match_search_index(rows.limit(0), Q.searches_frame(spark, searches)).count() == 0


def test_ten_thousand_searches_emit_their_hits_only(spark):
    rng = random.Random(22)
    searches = some_searches(rng, 10_000)
    rows = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(some_rows(rng, 60))], ROW).drop("row_no").withColumn("row_no", F.col("id").cast("bigint"))
    index = P.predicate_index(Q.searches_frame(spark, searches)).cache()
    assert index.count() == 4  # two travel keys, two blocks each
    hits = P.search_hits(rows, index)
    got = Counter((r["row_no"], r["search_id"]) for r in hits.collect())
    joined = Q.match_search_table(rows, Q.searches_frame(spark, searches))
    wanted = Counter((r["id"], s) for r in joined.select("id", F.explode("matched_searches").alias("s")).collect() for s in [r["s"]])
    assert got == wanted and max(got.values()) == 1


def test_totals_equal_the_hits_counted(spark):
    """Small blocks and small grids, so that kinds meet several parts of several blocks; ids of searches repeat."""
    rng = random.Random(23)
    searches = some_searches(rng, 300)
    config = Q.searches_frame(spark, searches)
    config = config.unionByName(config.limit(40)).withColumn(
        "exclude_flagged", F.when(F.col("position") % 50 == 0, F.array(F.lit(None).cast("string"))).otherwise(F.col("exclude_flagged"))
    )
    rows = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(some_rows(rng, 500))], ROW).withColumn("row_no", F.when(F.col("id") % 40 > 0, F.col("id").cast("bigint"))).repartition(3)
    hits = P.search_hits(rows, P.predicate_index(config, 64).cache())
    wanted = {r["search_id"]: (r["n"], r["f"]) for r in hits.groupBy("search_id").agg(F.count("*").alias("n"), F.min("row_no").alias("f")).collect()}
    for cells in (1 << 20, 40):
        got = {r["search_id"]: (r["matched"], r["first_no"]) for r in P.search_totals(rows, config, block=128, cells=cells).collect()}
        assert got == wanted and len(wanted) > 200


def measured(rng: random.Random, n: int) -> tuple[list[SavedSearch], list[tuple]]:
    """Searches and rows whose minutes and prices are all different."""
    bound = lambda low, high: None if rng.random() < 0.2 else rng.uniform(low, high)
    searches = [
        SavedSearch(
            f"s{k % (n - 7)}", "office", "walk", rng.uniform(1, 60), f"S{k}", max_price_pw=bound(300, 1000), min_price_pw=bound(200, 800),
            min_beds=rng.choice([None, 1]), exclude_flagged=rng.choice([(), ("studio",)]),
        )
        for k in range(n)
    ]
    minutes = lambda: rng.choice([None, float("nan")]) if rng.random() < 0.03 else rng.uniform(0, 65)
    rows = [
        (k, float("nan") if rng.random() < 0.03 else bound(150, 1100), rng.choice([None, 0, 2]), 1, 0, "unit", rng.choice([[], ["studio"]]), {"office:walk": (minutes(),), "office:fly": (1.0,)})
        for k in range(n)
    ]
    return searches, rows


PRICED = "row_no long, price_pw double, beds int, baths int, car_spaces int, property_type string, flags array<string>, travel map<string, struct<minutes: double>>"


def test_totals_in_slabs_equal_the_hits_counted(spark, monkeypatch):
    """Legs folded by known bounds or not at all, in blocks and slabs, grids and trees."""
    searches, rows = measured(random.Random(24), 700)
    frame, config = spark.createDataFrame(rows, PRICED).repartition(3), Q.searches_frame(spark, searches)
    hits = P.search_hits(frame, P.predicate_index(config, 64).cache())
    wanted = {r["search_id"]: (r["n"], r["f"]) for r in hits.groupBy("search_id").agg(F.count("*").alias("n"), F.min("row_no").alias("f")).collect()}
    assert len(wanted) > 300
    for known, cells, spread in ((P.KNOWN, 1 << 20, 0), (0, 40, 0), (0, 40, 1000)):
        monkeypatch.setattr(P, "KNOWN", known)
        got = {r["search_id"]: (r["matched"], r["first_no"]) for r in P.search_totals(frame, config, block=64, cells=cells, spread=spread).collect()}
        assert got == wanted, (known, cells, spread)


def shuffled(df) -> int:
    """Bytes that a query wrote for its shuffles."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        else:
            total += node.metrics().apply("shuffleBytesWritten").value() if node.nodeName() == "Exchange" else 0
            todo += [node.children().apply(k) for k in range(node.children().length())]
    return total


def test_shuffles_of_totals_grow_with_their_input(spark):
    """Four times the rows and searches, in four times the blocks: rows once copied for every block made that sixteen times."""
    sizes = []
    for n in (2000, 8000):
        searches, rows = measured(random.Random(n), n)
        config = Q.searches_frame(spark, searches)
        sizes.append(shuffled(P.search_totals(spark.createDataFrame(rows, PRICED), config, block=128)))
    print(sizes)
    assert 0 < sizes[1] < 6 * sizes[0], sizes
