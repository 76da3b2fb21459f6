"""Sorted output whose files hold the same bytes however many tasks wrote them.

Spark's own range partitioning samples its bounds, so the same rows come out in other files each time. Here the bounds are
counted: a range of keys with too many rows is divided by the next character in which its keys differ, again and again, and
neighbouring ranges are put together up to the size of a file. What the driver sees are counts per range, at most about
``most_files`` ranges and the characters that follow in those that are too large.
"""

from __future__ import annotations

import json
import math
import os
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

ROWS_PER_FILE, MOST_FILES = 1_000_000, 10_000


def ordered_text(column: Column, kind: T.DataType) -> Column:
    """A text that orders as the values do."""
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        whole = F.unix_date(column) if isinstance(kind, T.DateType) else column.cast("timestamp") if isinstance(kind, T.TimestampNTZType) else column
        whole = F.unix_micros(whole) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else whole
        return F.when(column.isNotNull(), F.lpad(F.hex(whole.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    raise TypeError(f"files cannot be divided by a key of type {kind.simpleString()}")


def range_of(key: Column, bounds: Sequence[str]) -> Column:
    """Which range a key lies in: the number of ``bounds`` up to it, found by halving; a null lies before all."""
    if not bounds:
        return F.lit(0)
    listed = F.from_json(F.lit(json.dumps(list(bounds), ensure_ascii=False)), "array<string>")  # a literal when it runs

    def halved(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["low"] + s["high"], 1)
        undecided, before = s["low"] < s["high"], key < F.get(listed, middle)
        return F.struct(
            F.when(undecided & ~before, middle + 1).otherwise(s["low"]).alias("low"), F.when(undecided & before, middle).otherwise(s["high"]).alias("high")
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    return F.when(key.isNull(), F.lit(0)).otherwise(F.aggregate(steps, start, halved, lambda s: s["low"]))


def file_bounds(df: DataFrame, key: str, rows_per_file: int = ROWS_PER_FILE, most_files: int = MOST_FILES) -> list[str]:
    """The first keys (or what they begin with) of all files but the first. The same rows give the same bounds. Rows of
    one key stay together, so a key with more rows than a file should hold makes a larger file."""
    keys = cut_lineage(df.select(ordered_text(F.col(key), df.schema[key].dataType).alias("k")))
    bounds: list[str] = []
    whole = None
    while True:
        placed = keys.withColumn("r", range_of(F.col("k"), bounds))
        held = {r["r"]: r for r in placed.groupBy("r").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).collect()}
        whole = whole or max(rows_per_file, math.ceil(sum(r["n"] for r in held.values()) / most_files))
        wide = {k: len(os.path.commonprefix([r["low"], r["high"]])) + 1 for k, r in held.items() if r["n"] > whole and r["low"] != r["high"]}
        if not wide:
            break
        lengths = F.element_at(F.create_map(*[F.lit(x) for pair in wide.items() for x in pair]), F.col("r"))
        heads = placed.where(F.col("r").isin(list(wide)) & F.col("k").isNotNull()).select(F.substring("k", F.lit(1), lengths).alias("head"))
        counts = sorted((r["head"], r["n"]) for r in heads.groupBy("head").agg(F.count("*").alias("n")).collect())
        # Heads in a row that fit a file together need no bound between them.
        kept, size = [], whole + 1
        for head, n in counts:
            if size + n > whole or bisect_right(bounds, head) != (bisect_right(bounds, kept[-1]) if kept else -1):
                kept.append(head)
                size = 0
            size += n
        bounds = sorted({*bounds, *kept})
    out, size = [], held[0]["n"] if 0 in held else 0
    for k, bound in enumerate(bounds, 1):
        n = held[k]["n"] if k in held else 0
        if size + n > whole and size:
            out.append(bound)
            size = 0
        size += n
    return out


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def write_sorted(df: DataFrame, path: str, keys: list[str], mode: str = "errorifexists", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write in key order, the same rows to the same bytes: bounds are counted, rows of equal keys go by their other
    columns, and entries of a map by its keys."""
    for field in df.schema.fields:
        if isinstance(field.dataType, T.MapType) and _orderable(field.dataType.valueType):
            df = df.withColumn(field.name, F.map_from_entries(F.array_sort(F.map_entries(field.name))))
    bounds = file_bounds(df, keys[0], rows_per_file)
    ties = [f.name for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    number = range_of(ordered_text(F.col(keys[0]), df.schema[keys[0]].dataType), bounds)
    df.repartitionById(len(bounds) + 1, number).sortWithinPartitions(*keys, *ties).write.mode(mode).parquet(path)
