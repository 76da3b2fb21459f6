"""Exact deduplication by distributed most-significant-byte-first radix partitioning.

Documents are split by their leading bytes; groups that still hold several unfinished texts are split by the bytes that
follow, in steps that grow eightfold, until each group is a single document or all of its texts have ended together. Two
texts are equal exactly when they share a group to their end: no digest decides anything. A step counts groups by
partial aggregation, so a group holding a third of all rows leaves each task as one row, and only undecided documents
carry their remaining bytes on.

Defined cases: a null text counts as empty; equality is after lower-casing A-Z; of rows tied on the largest id (repeated
rows) exactly one stays; a null id is smaller than any other; an empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import lower_ascii, staged

FIRST_BYTES, GROWTH = 64, 8


def radix_groups(docs: DataFrame) -> DataFrame:
    """row, doc_id, text_sha256, step, group of every row; step and group are null for texts that occur once."""
    text = lower_ascii(F.coalesce("text", F.lit("")))
    live = docs.select("doc_id", text.alias("t")).select(
        F.lit(0).cast("long").alias("group"), "doc_id", F.sha2("t", 256).alias("text_sha256"), F.col("t").cast("binary").alias("rest")
    )
    width, step, done = FIRST_BYTES, 0, []
    while True:
        # substring() on binary counts bytes.
        lead, ended = F.expr(f"substring(rest, 1, {width})"), F.length("rest") <= width
        keyed = live.select("*", lead.alias("lead"), ended.alias("ended"))
        shared = keyed.groupBy("group", "lead", "ended").agg(F.count("*").alias("n")).where("n > 1")
        shared = staged(shared.select("group", "lead", "ended", F.monotonically_increasing_id().alias("next")), f"radix-groups-{step}")
        # The shared leads grow with the corpus: both sides are dealt by key, and Spark splits a hot key's side.
        split = keyed.join(shared.hint("merge"), ["group", "lead", "ended"], "left").select(
            F.col("next").alias("group"), "doc_id", "text_sha256", (F.col("next").isNotNull() & ~F.col("ended")).alias("open"),
            F.when(F.col("next").isNotNull() & ~F.col("ended"), F.expr(f"substring(rest, {width + 1})")).alias("rest"),
            *([F.monotonically_increasing_id().alias("row")] if step == 0 else ["row"]),
        )
        split = staged(split, f"radix-{step}")
        done.append(split.where("not open").select("row", "doc_id", "text_sha256", F.when(F.col("group").isNotNull(), F.lit(step)).alias("step"), "group"))
        live = split.where("open").drop("open")
        if live.isEmpty():
            return reduce(DataFrame.unionByName, done)
        width, step = width * GROWTH, step + 1


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    found = radix_groups(docs)
    single = found.where("group is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    many = found.where("group is not null")
    heads = many.groupBy("step", "group").agg(F.max(F.struct("doc_id", "row")).alias("head"), F.count("*").alias("group_size"))
    # Written first: Spark splits a hot group's side only where both sides of a join are plain exchanges.
    heads = staged(heads, "radix-heads")
    grouped = many.join(heads.hint("merge"), ["step", "group"]).select(
        "doc_id", F.col("head.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("head.row")).alias("kept"), "text_sha256"
    )
    return single.unionByName(grouped)
