"""Configuration fingerprint: changes exactly when a change makes cached measurements mean something else."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def config_hash(office: Column, commute: Column, walk: Column) -> Column:
    """SHA-256 over office position and address, commute assumption and walking settings; labels do not count."""
    material = F.struct(office.alias("office"), commute.alias("commute_assumption"), walk.alias("walk"))
    return F.sha2(F.to_json(material, {"ignoreNullFields": "false"}), 256)
