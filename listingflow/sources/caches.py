"""Memo tables of measured positions and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from ..functions.patterns import trimmed
from ..schemas import CACHE_FILE

# ---- Fixed values: licence terms of the one source whose positions expire ------------------
LICENSED_SOURCE = "google"
LICENCE_DAYS = 30
EXPIRY_WARNING_DAYS = 7
# -------------------------------------------------------------------------------------------
_DAY_MS = 86_400_000


def read_cache_documents(spark: SparkSession, path: str) -> DataFrame | None:
    """The raw text of each cache document, or None when there is nothing at ``path``."""
    try:
        return spark.read.text(path, wholetext=True).withColumn("source_path", F.col("_metadata.file_path"))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def cache_state(spark: SparkSession, documents: DataFrame | None) -> DataFrame:
    """``state`` (missing | ok | unreadable), key counts and bad keys per document.

    An unreadable document is still counted: those numbers say what losing it would cost.
    """
    if documents is None:
        return spark.createDataFrame(
            [("missing", 0, 0, 0)], "state STRING, routes INT, positions INT, bad_keys INT"
        )
    document = F.try_parse_json("value")

    def keys(section: str) -> Column:
        members = F.try_variant_get(document, f"$.{section}", "map<string,variant>")
        return F.coalesce(F.map_keys(members), F.array().cast("array<string>"))

    def blank(names: Column) -> Column:
        return F.size(F.filter(names, lambda k: trimmed(k) == ""))

    bad = blank(keys("routes")) + blank(keys("geo"))
    typed = F.from_json("value", CACHE_FILE, {"mode": "PERMISSIVE"})
    readable = document.isNotNull() & (bad == 0) & typed["routes"].isNotNull() & typed["geo"].isNotNull()
    return documents.select(
        F.when(readable, F.lit("ok")).otherwise(F.lit("unreadable")).alias("state"),
        F.size(keys("routes")).alias("routes"),
        F.size(keys("geo")).alias("positions"),
        bad.alias("bad_keys"),
    )


def cached_positions(documents: DataFrame) -> DataFrame:
    typed = documents.select(F.from_json("value", CACHE_FILE).alias("c"))
    return typed.select(F.explode("c.geo").alias("key", "p")).select("key", "p.*")


def cached_routes(documents: DataFrame) -> DataFrame:
    typed = documents.select(F.from_json("value", CACHE_FILE).alias("c"))
    return typed.select(F.explode("c.routes").alias("key", "r")).select("key", "r.*")


def table_health(rows: DataFrame, key: str, corrupt: str | None = None) -> DataFrame:
    """Row counts of a cache kept as a table: total, blank keys, unreadable rows."""
    broken = F.col(corrupt).isNotNull() if corrupt else F.lit(False)
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(F.coalesce(trimmed(F.col(key)), F.lit("")) == "").alias("blank_keys"),
        F.count_if(broken).alias("unreadable"),
    )


def position_expired(src: Column, at_ms: Column, now_ms: Column, days: int = LICENCE_DAYS) -> Column:
    """Only licensed positions expire; an undated one counts as expired."""
    licensed = F.coalesce(src == LICENSED_SOURCE, F.lit(False))
    return licensed & (at_ms.isNull() | (now_ms - at_ms > days * _DAY_MS))


def cache_expiry(positions: DataFrame, now_ms: Column) -> DataFrame:
    """Counts by provenance: permanent, licensed, expired, expiring within the warning period."""
    licensed = F.coalesce(F.col("src") == LICENSED_SOURCE, F.lit(False))
    expired = position_expired(F.col("src"), F.col("at"), now_ms)
    soon = position_expired(F.col("src"), F.col("at"), now_ms, LICENCE_DAYS - EXPIRY_WARNING_DAYS)
    return positions.agg(
        F.count_if(~licensed).alias("permanent"),
        F.count_if(licensed).alias("licensed"),
        F.count_if(expired).alias("expired"),
        F.count_if(soon & ~expired).alias("expiring_soon"),
    )
