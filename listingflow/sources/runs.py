"""Published runs: immutable snapshots, versioned ledgers, a manifest that names a run once all of it is there.

Two markers decide who may write and what is read, both created only where they do not exist yet: ``reserved/<run id>``
belongs to the one publisher that created it, ``committed/<run id>`` is created last and makes the run visible. So of two
publishers of one id one is refused before it writes anything, and a run that stopped half-way is in no manifest.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import run_id_candidates
from ..schemas import MANIFEST
from .splits import write_sorted


def sorted_entries(entries: Column) -> Column:
    """A map as an array of entries ordered by key: the same content always reads the same."""
    return F.array_sort(F.map_entries(entries))


def next_run_id(moment: DataFrame, taken: DataFrame) -> DataFrame:
    """The first free id of the local day; a day with none left raises. ``moment``: one row ``utc_now``; ``taken``: ``run_id``."""
    offered = moment.select(F.explode(run_id_candidates(F.col("utc_now"))).alias("run_id"))
    return offered.join(taken.select("run_id"), "run_id", "left_anti").select(F.min("run_id").alias("run_id")).select(
        F.coalesce("run_id", F.raise_error(F.lit("no run id is left on this day")).cast("string")).alias("run_id")
    )


def taken_run(manifest: DataFrame, run_id: str) -> DataFrame:
    """Manifest rows that already hold ``run_id``; publishing is refused unless this is empty."""
    return manifest.filter(F.col("run_id") == run_id)


# ---- markers -----------------------------------------------------------------------------------


def put_if_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where it exists. Of any number of callers one gets True, on file systems whose create
    without overwriting is atomic (HDFS, stores with conditional writes); a local path is created exclusively."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(place.getParent())
    try:
        if system.getScheme() == "file":
            nothing = spark._sc._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(place.toUri().getPath()).toPath(), nothing)
        else:
            system.create(place, False).close()
        return True
    except Py4JJavaError as error:
        if any(known in error.java_exception.getClass().getName() for known in ("FileAlreadyExists", "AlreadyBeingCreated")):
            return False
        raise


def marked(spark: SparkSession, root: str, kind: str) -> list[str]:
    """The run ids that have a marker of a kind: names of files, one per run."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{kind}")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(place)] if system.exists(place) else []


def reserve_run_id(spark: SparkSession, root: str, moment: DataFrame) -> str:
    """The first id of the local day that nobody has; it is the caller's from now on. A day with none left raises."""
    taken = {run_id for kind in ("reserved", "committed") for run_id in marked(spark, root, kind)}
    for run_id in moment.select(run_id_candidates(F.col("utc_now")).alias("ids")).first()["ids"]:
        if run_id not in taken and put_if_absent(spark, f"{root}/reserved/{run_id}"):
            return run_id
    raise ValueError("no run id is left on this day")


# ---- manifest ----------------------------------------------------------------------------------


def manifest_rows(listings: DataFrame, created: DataFrame) -> DataFrame:
    """A manifest row per run. ``listings``: run_id, listing_state; ``created``: run_id, position, created_at,
    criteria_version, label. A run without listings has a row too."""
    counts = listings.groupBy("run_id").agg(F.count("*").alias("n"), F.count_if(F.col("listing_state") == "new").alias("new"))
    zero = F.lit(0).cast("bigint")
    return created.join(counts, "run_id", "left").select(
        "run_id", F.col("position").cast("bigint").alias("position"), F.coalesce("n", zero).alias("listing_count"), F.coalesce("new", zero).alias("new_count"),
        F.col("criteria_version").cast("int").alias("criteria_version"), F.left("run_id", F.lit(10)).alias("date"), "created_at", "label",
    )


def current_run(manifest: DataFrame) -> DataFrame:
    """One row ``current_run``: the last in append order, null before the first run."""
    return manifest.agg(F.max_by("run_id", F.struct("position", "run_id")).alias("current_run"))


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Manifest rows of the runs that are committed."""
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifest/*")
    return rows.where(F.col("run_id").isin(marked(spark, root, "committed")))


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """The manifest under ``root``, empty before the first run."""
    try:
        return read_manifest(spark, root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def publish_run(run_id: str, root: str, listings: DataFrame, ledger: DataFrame, suburbs: DataFrame,
                rejected: DataFrame, manifest_row: DataFrame, reserved: bool = False) -> None:
    """Write a run; readers see it only once all its parts exist.

    ``reserved``: the caller has the id already, from :func:`reserve_run_id` or because an earlier attempt of its own died
    before the commit; its parts are then replaced. Otherwise an id that anyone else has is refused, and so is, in
    either case, a run that is committed.
    """
    spark = listings.sparkSession
    if run_id in marked(spark, root, "committed"):
        raise ValueError(f"run {run_id} already exists; runs are immutable")
    if not put_if_absent(spark, f"{root}/reserved/{run_id}") and not reserved:
        raise ValueError(f"run {run_id} is being published already; runs are immutable")
    parts = {
        "runs/run_id": (listings, "listing_id"),
        "ledger/version": (ledger, "listing_id"),
        "suburbs/version": (suburbs, "suburb_key"),
        "rejected/version": (rejected, "listing_id"),
    }
    for folder, (part, key) in parts.items():
        write_sorted(part, f"{root}/{folder}={run_id}", [key], mode="overwrite")
    manifest_row.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/{run_id}")
    if not put_if_absent(spark, f"{root}/committed/{run_id}"):
        raise ValueError(f"run {run_id} was committed by someone else; runs are immutable")
