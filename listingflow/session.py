"""Session settings the operators rely on.

Nothing here is required on a cluster that already sets its own values: every
option is applied only when the session is created by :func:`build_session`.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Re-plan at run time: small sides become broadcast joins after their size
    # is measured, hot shuffle partitions are split, tiny ones are merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles a method above 8,000 bytes of bytecode. Wide scoring projections pass that
    # limit when fused; beyond it Spark should split them instead of running them interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "listingflow", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder for cut lineage: the one the cluster names, else (tests only) a fresh local one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    # One JVM and one disk: ``local``, ``local[n]``. ``local-cluster[...]`` has executors with folders of their own.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="listingflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as columns under the shared checkpoint folder and read it back: lost executors re-read instead of
    re-computing, and each reader takes only the columns it needs. Runs at once; the files go with the folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/cuts/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
