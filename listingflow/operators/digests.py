"""Snapshots that know what is in them: comparing two runs reads only the buckets and columns that differ.

A snapshot is written in buckets of its key, one folder each, with a small table of digests beside it: per bucket and
field, what all rows of the bucket amount to. Two snapshots are compared by their digests first, the roots (all buckets
of a field together) before the buckets, and the rows of a bucket are read only where a digest differs; those rows are
compared value by value. Digests of unlike rows agree with a chance below 2 ** -90, and then a change goes unseen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .snapshots import SAMPLE_IDS, _comparable, change_report, left_run

#: Folders of a snapshot, and so rows of its digests per field.
BUCKETS = 256
#: The pseudo field whose digest stands for the keys themselves.
KEYS = "(keys)"


@dataclass(frozen=True)
class Snapshot:
    """Where a snapshot lies; ``fields`` are those it has digests of."""

    path: str
    key: str
    fields: tuple[str, ...]

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def digests(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/digests")


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, key: str, fields: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, field, rows, parity, total``: one row per bucket and field, the keys themselves included."""
    # As JSON with its nulls: hashes of arrays and structs skip them.
    written = {f: F.to_json(F.struct(_comparable(df, f).alias("v")), {"ignoreNullFields": "false"}) for f in fields}
    hashes = [F.struct(F.lit(f).alias("field"), F.xxhash64(F.lit(f), key, text).alias("h")) for f, text in {KEYS: F.lit(""), **written}.items()]
    each = df.select(bucket_of(F.col(key), buckets).alias("bucket"), F.explode(F.array(*hashes)).alias("d"))
    low = F.col("d.h").bitwiseAND(F.lit((1 << 31) - 1))
    return each.groupBy("bucket", F.col("d.field").alias("field")).agg(F.count("*").alias("rows"), F.bit_xor("d.h").alias("parity"), F.sum(low).alias("total"))


def write_snapshot(df: DataFrame, path: str, key: str, fields: Sequence[str], buckets: int = BUCKETS) -> Snapshot:
    """Write ``df`` in buckets, then the digests of what was written."""
    dealt = df.withColumn("bucket", bucket_of(F.col(key), buckets)).repartition(F.col("bucket"))
    dealt.write.partitionBy("bucket").parquet(f"{path}/rows")
    snapshot = Snapshot(path, key, tuple(fields))
    bucket_digests(snapshot.rows(df.sparkSession), key, fields, buckets).coalesce(1).write.parquet(f"{path}/digests")
    return snapshot


def differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """``field, bucket`` of every digest that differs or that only one side has. A field whose root agrees is not looked into."""
    root = lambda df: df.groupBy("field").agg(F.sum("rows").alias("rows"), F.bit_xor("parity").alias("parity"), F.sum("total").alias("total"))
    same = ["rows", "parity", "total"]
    agreed = root(before).join(root(after), ["field", *same], "left_semi").select("field")
    b, a = (df.join(agreed, "field", "left_anti").select("field", "bucket", F.struct(*same).alias(name)) for df, name in ((before, "b"), (after, "a")))
    return b.join(a, ["field", "bucket"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("field", "bucket")


def _parts(spark: SparkSession, before: Snapshot, after: Snapshot, fields: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]] | None:
    """The rows of the buckets in which one of ``fields`` differs, with those fields alone; None where none does."""
    found = differing(before.digests(spark), after.digests(spark)).where(F.col("field").isin(list(fields)))
    told = found.groupBy("field").agg(F.collect_set("bucket").alias("buckets")).collect()  # at most a row per field, BUCKETS numbers each
    if not told:
        return None
    buckets, changed = sorted({b for r in told for b in r["buckets"]}), [f for f in fields if f in {r["field"] for r in told}]
    read = [s.rows(spark).where(F.col("bucket").isin(buckets)).select(s.key, *[f for f in changed if f != KEYS]) for s in (before, after)]
    return read[0], read[1], [f for f in changed if f != KEYS]


def diff_report(spark: SparkSession, before: Snapshot, after: Snapshot, fields: Sequence[str], sample: int = SAMPLE_IDS) -> DataFrame:
    """``snapshots.change_report`` of two written snapshots keyed by ``listing_id``."""
    parts = _parts(spark, before, after, fields)
    if parts is None:
        return spark.createDataFrame([], "field string, listings bigint, sample string")
    return change_report(*parts, sample)


def left_snapshot(spark: SparkSession, before: Snapshot, after: Snapshot) -> DataFrame:
    """``snapshots.left_run`` of two written snapshots; with the sides exchanged, what appeared."""
    parts = _parts(spark, before, after, [KEYS])
    return left_run(parts[0], parts[1]) if parts else spark.createDataFrame([], "listing_id string")
