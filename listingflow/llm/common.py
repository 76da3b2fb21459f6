"""Helpers shared by the corpus operators: staged tables, byte views of texts, tokenizer files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.session import checkpoint_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, so that lost executors re-read instead of
    re-computing and every later branch sees the same rows."""
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def text_slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20, most_rows: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into slices of about ``most_bytes`` of text (one row at least); the column ``text`` as
    strings, null as empty. A slice bounds what a task holds decoded at once, however long the texts are."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for row, length in enumerate(lengths):
            if row > start and (size + length > most_bytes or row - start >= most_rows):
                part = batch.slice(start, row - start)
                yield part, [text or "" for text in part.column("text").to_pylist()]
                start, size = row, 0
            size += int(length)
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, [text or "" for text in part.column("text").to_pylist()]


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; every executor has the files installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """One tokenizer per Python worker; its own threads are off because Spark already fills the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)
