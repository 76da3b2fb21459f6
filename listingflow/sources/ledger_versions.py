"""The ledger in buckets of its key: a run writes anew only the buckets in which one of its rows changes.

``rows/version=<run>/bucket=<n>`` holds rows, ``versions/<run>`` says for every bucket under which run its rows lie. A
version shares the files of all buckets that its run left alone, older versions stay readable, and a version without its
marker ``committed/<run>``, which is made last and once, does not exist for readers. What reaches the driver are bucket
numbers, at most ``BUCKETS`` of them.

A run that changes more rows than there are buckets touches nearly all of them, whatever their keys; ``buckets`` is chosen by
the rows a run changes, and stays the same for all versions under one folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.digests import bucket_of
from ..operators.ledger import FOLD_COLUMNS, fold_run
from ..schemas import LEDGER
from ..session import cut_lineage
from .runs import marked, put_if_absent

BUCKETS = 256


def _placed(spark: SparkSession, root: str, version: str) -> dict[int, str]:
    """Under which run the rows of each bucket lie."""
    if version not in marked(spark, root, "committed"):
        raise ValueError(f"there is no version {version} of the ledger")
    return {r["bucket"]: r["version"] for r in spark.read.schema("bucket INT, version STRING").parquet(f"{root}/versions/{version}").collect()}


def _rows(spark: SparkSession, root: str, placed: dict[int, str], schema: str) -> DataFrame:
    if not placed:
        return spark.createDataFrame([], f"{schema}, bucket INT")
    paths = [f"{root}/rows/version={version}/bucket={bucket}" for bucket, version in sorted(placed.items())]
    return spark.read.option("basePath", f"{root}/rows").schema(f"{schema}, version STRING, bucket INT").parquet(*paths).drop("version")


def read_version(spark: SparkSession, root: str, version: str, schema: str = LEDGER) -> DataFrame:
    """All rows of a version."""
    return _rows(spark, root, _placed(spark, root, version), schema).drop("bucket")


def _write(rows: DataFrame, root: str, version: str, kept: dict[int, str], touched: list[int], buckets: int) -> None:
    """Rows, the version's own table, the marker. An unfinished attempt is replaced, a finished version never."""
    spark = rows.sparkSession
    if version in marked(spark, root, "committed"):
        raise ValueError(f"version {version} already exists; versions are immutable")
    dealt = rows.withColumn("bucket", bucket_of(F.col("listing_id"), buckets)).repartition("bucket").sortWithinPartitions("bucket", "listing_id")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/rows/version={version}")
    placed = {**kept, **dict.fromkeys(touched, version)}
    spark.createDataFrame(sorted(placed.items()), "bucket INT, version STRING").coalesce(1).write.mode("overwrite").parquet(f"{root}/versions/{version}")
    if not put_if_absent(spark, f"{root}/committed/{version}"):
        raise ValueError(f"version {version} was finished by someone else; versions are immutable")


def start_versions(ledger: DataFrame, root: str, version: str, buckets: int = BUCKETS) -> None:
    """Write a whole ledger as the first version."""
    rows = cut_lineage(ledger)
    held = [r["b"] for r in rows.select(bucket_of(F.col("listing_id"), buckets).alias("b")).distinct().collect()]
    _write(rows, root, version, {}, held, buckets)


def touched_buckets(ledger: DataFrame, listings: DataFrame, returned: DataFrame, verdicts: DataFrame,
                    previous_run: str | None, allow_stale: bool, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` of every row that the run changes: what it lists, and absent rows that have a verdict or go stale.

    Of ``ledger`` only listing_id, status and last_seen_run are read, and where nothing may go stale only rows that have a
    verdict matter.
    """
    seen = listings.select("listing_id")
    active = ledger.where("status = 'active'").select("listing_id", "last_seen_run")
    told = active.join(verdicts.where("verdict is not null").select("listing_id"), "listing_id", "left_semi")
    if allow_stale and previous_run is not None:
        told = told.unionByName(active.where(F.col("last_seen_run") != previous_run))
    absent = told.select("listing_id").join(returned.select("listing_id"), "listing_id", "left_anti").join(seen, "listing_id", "left_anti")
    return seen.unionByName(absent).select(bucket_of(F.col("listing_id"), buckets).alias("bucket")).distinct()


def fold_version(spark: SparkSession, root: str, version: str | None, listings: DataFrame, returned: DataFrame, verdicts: DataFrame, run_id: str,
                 previous_run: str | None, allow_stale: bool, buckets: int = BUCKETS, schema: str = LEDGER) -> DataFrame:
    """Fold a run into ``version`` (None: an empty ledger) and write the result as version ``run_id``.

    Returns the rows the run decided something about, as :func:`~listingflow.operators.ledger.fold_run` gives them; every
    other row of the new version is the old one. The arguments mean what they mean there.
    """
    before = _placed(spark, root, version) if version is not None else {}
    narrow = _rows(spark, root, before, schema)
    found = touched_buckets(narrow, listings, returned, verdicts, previous_run, allow_stale, buckets).collect()
    touched = sorted(r["bucket"] for r in found)
    old = _rows(spark, root, {b: before[b] for b in touched if b in before}, schema).drop("bucket")
    # Rows of untouched buckets come from nowhere here: no listing and no absence with a fate lies in one.
    folded = cut_lineage(fold_run(old, listings, returned, verdicts, run_id, previous_run, allow_stale))
    _write(folded.drop(*FOLD_COLUMNS), root, run_id, before, touched, buckets)
    return folded.where("state is not null or absent_status is not null")
