"""Contiguous, balanced shards from prefix sums of byte sizes. DataFrame functions only.

Equal texts form a group and a group is never divided. Groups stand in one global order (largest first, then by digest);
their sizes are summed per range partition, the totals give each partition its offset, and the running total inside it
gives each group its place. The order is cut at equal byte targets: a group goes where its middle lies. Groups that
alone exceed an equal share get a shard each, at most one per shard, and the rest is shared equally by the others, so
sizes differ by no more than one group at a cut.

Defined cases: a null text counts as empty and has size 1; null ids rank first in their group; repeated rows each get a
slot; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingflow.llm.common import staged

#: Parts that the rows of one text are numbered in, so that a text holding a third of all rows is spread over many tasks.
SALTS = 1024


def shard_by_bytes(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    rows = staged(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("text_key"),
            F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"),
        ),
        "sizes",
    )
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    placed = staged(groups.repartitionByRange(F.desc("bytes"), F.asc("text_key")).withColumn("part", F.spark_partition_id()), "groups")

    # At most one group per shard can exceed an equal share; the largest ones come to the driver.
    largest = [r["bytes"] for r in placed.orderBy(F.desc("bytes"), "text_key").limit(shards).select("bytes").collect()]
    total = placed.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    alone = 0
    while alone < min(shards - 1, len(largest)) and largest[alone] * (shards - alone) > total - sum(largest[:alone]):
        alone += 1
    taken = sum(largest[:alone])

    by_part = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.sum("bytes").alias("b"), F.sum("n").alias("r")).select(
        "part", F.coalesce(F.sum("b").over(by_part), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("r").over(by_part), F.lit(0)).alias("rows_before")
    )
    inside = W.partitionBy("part").orderBy(F.desc("bytes"), "text_key").rowsBetween(W.unboundedPreceding, W.currentRow)
    start = F.col("bytes_before") + F.sum("bytes").over(inside) - F.col("bytes")
    first_row = F.col("rows_before") + F.sum("n").over(inside) - F.col("n")
    middle = (2 * (F.col("start") - taken) + F.col("bytes")) * (shards - alone) / (2 * max(total - taken, 1))
    cut = (
        placed.join(offsets, "part")
        .select("text_key", "bytes", start.alias("start"), first_row.alias("first_row"), F.row_number().over(W.partitionBy("part").orderBy(F.desc("bytes"), "text_key")).alias("at"), "part")
        .withColumn("shard", F.when(F.col("start") >= taken, F.least(F.lit(shards - 1), alone + F.floor(middle))).cast("int"))
    )
    # Groups before ``taken`` are the ones that stand alone, in order; their starts tell their number.
    number = F.lit(0)
    for k in range(1, alone):
        number = F.when(F.col("start") >= sum(largest[:k]), F.lit(k)).otherwise(number)
    cut = cut.withColumn("shard", F.coalesce("shard", number).cast("int"))
    first = cut.groupBy("shard").agg(F.min("first_row").alias("shard_row"))
    bases = cut.join(first, "shard").select("text_key", "shard", (F.col("first_row") - F.col("shard_row")).alias("base"))

    before = W.partitionBy("text_key").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    cells = (
        rows.groupBy("text_key", "salt").agg(F.count("*").alias("c"))
        .withColumn("ahead", F.coalesce(F.sum("c").over(before), F.lit(0)))
        .join(bases, "text_key")
        .select("text_key", "salt", "shard", (F.col("base") + F.col("ahead")).alias("base"))
    )
    in_cell = W.partitionBy("text_key", "salt").orderBy("doc_id", "size")
    return (
        rows.withColumn("k", F.row_number().over(in_cell))
        .join(cells, ["text_key", "salt"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("k") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
