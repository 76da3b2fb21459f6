"""One large JSON document read by many tasks.

A document is divided into byte ranges. Three passes over the ranges, each in parallel: quotes are counted, so that every range
knows whether it begins inside a string; the brackets of each range are reduced to what they close and open; and, with the
open brackets before each range known by then, its values are cut out by path. Between passes only a small row per range
is shuffled. A value belongs to the range in which it ends. Brackets and strings are checked here, what is inside a value by
whoever parses it. Files are opened in the tasks, so a path must be one that ``pyarrow.fs`` knows: mounted, HDFS, S3, GCS.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import CACHE_FILE, REJECTION, SOURCE_LISTING
from ..session import cut_lineage

SPLIT_BYTES, MOST_TASKS = 32 << 20, 20_000
VALUES = "source_path string, path array<string>, at long, value string"
_STATES = "source_path string, file string, start long, stop long, inside boolean, state string"

_TOKEN = re.compile(rb'"(?:[^"\\]++|\\.)*+("|\\?\Z)|[{}\[\],:]', re.S)
_STRING_END = re.compile(rb'(?:[^"\\]++|\\.)*+("|\\?\Z)', re.S)
_ESCAPE = re.compile(rb"\\.", re.S)
_CLOSES = {"}": "{", "]": "["}


class _Window:
    """The bytes of a range, more where a string goes on past its end, and those before it on request."""

    def __init__(self, file: str, start: int, stop: int):
        local = re.match(r"file:/+", file)
        system, name = (fs.LocalFileSystem(), "/" + file[local.end() :]) if local else fs.FileSystem.from_uri(file)
        self.name, self.source, self.base, self.stop = file, system.open_input_file(name), start, stop
        self.data = self.source.read_at(stop - start, start)

    def grow(self) -> None:
        more = self.source.read_at(max(1 << 16, len(self.data)), self.base + len(self.data))
        if not more:
            raise ValueError(f"{self.name} ends inside a string")
        self.data += more

    def text(self, start: int, stop: int) -> bytes:
        before = self.source.read_at(min(stop, self.base) - start, start) if start < self.base else b""
        return before + self.data[max(start - self.base, 0) : max(stop - self.base, 0)]

    def escaped(self) -> bool:
        """Whether the first byte follows a backslash that is not escaped itself."""
        run, size = 0, 16
        while run < self.base:
            before = self.source.read_at(min(size, self.base), max(self.base - size, 0))
            run = len(before) - len(before.rstrip(b"\\"))
            if run < len(before):
                break
            size *= 4
        return run % 2 == 1

    def tokens(self, inside: bool) -> Iterator[tuple[str, int, int]]:
        """``(character, from, to)`` of strings and structural characters that begin in the range."""
        at, whole = 0, self.stop - self.base
        if inside:
            at = int(self.escaped())
            while (found := _STRING_END.match(self.data, at)).group(1) != b'"':
                self.grow()
            at = found.end()
        again = True
        while again:
            again = False
            for found in _TOKEN.finditer(self.data, at):
                if found.start() >= whole:
                    return
                kind = chr(self.data[found.start()])
                if kind == '"' and found.group(1) != b'"':
                    at, again = found.start(), True
                    self.grow()
                    break
                yield kind, self.base + found.start(), self.base + found.end()

    def wrong(self, at: int) -> ValueError:
        return ValueError(f"{self.name} is not valid JSON at byte {at}")


# A level is [bracket, position, key, first byte of its present value]. In a summary the levels that were open before the range
# have no bracket but, where they end in it, the one that closes them; their positions count from the range, and behind them
# is the number of brackets opened directly in them.


def _quotes(window: _Window) -> int:
    data = window.data[1:] if window.escaped() else window.data
    return _ESCAPE.sub(b"", data).count(b'"')


def _summary(window: _Window, inside: bool) -> dict:
    before, opened, said, idle = [[None, 0, None, None, 0]], [], None, True
    for kind, start, stop in window.tokens(inside):
        idle = False
        top = opened[-1] if opened else before[-1]
        if kind == '"':
            said = (start, stop)
            continue
        if kind == ":":
            # A key that was read in the range before is called False here.
            top[2], top[3] = json.loads(window.text(*said)) if said else False, stop
        elif kind == ",":
            top[1], top[3] = top[1] + 1, stop
        elif kind in "{[":
            before[-1][4] += not opened
            opened.append([kind, 0, None, stop])
        elif opened:
            if opened.pop()[0] != _CLOSES[kind]:
                raise window.wrong(start)
        else:
            top[0] = kind
            before.append([None, 0, None, None, 0])
        said = None
    return {"before": before, "opened": opened, "idle": idle, "said": json.loads(window.text(*said)) if said else None}


def _after(stack: list, said: str | None, begun: bool, summary: dict, file: str) -> list:
    """The open levels behind a range, given those before it; ``begun``: the document has been opened."""
    stack = [list(level) for level in stack]
    for closing, commas, key, value, inner in summary["before"]:
        if not stack:
            if closing or commas or value is not None or inner + begun > 1:
                raise ValueError(f"{file} goes on after its end")
            break
        level = stack[-1]
        level[1] += commas
        level[2] = said if key is False else level[2] if key is None else key
        level[3] = level[3] if value is None else value
        if closing and stack.pop()[0] != _CLOSES[closing]:
            raise ValueError(f"{file} closes a bracket it did not open")
    return stack + summary["opened"]


def _values(window: _Window, inside: bool, state: dict, wanted: Sequence[tuple], marks: Sequence[tuple]) -> Iterator[tuple]:
    stack, said = [list(level) for level in state["stack"]], state["said"]
    depths = {len(p) for p in (*wanted, *marks)}
    for kind, start, stop in window.tokens(inside):
        if kind == '"':
            said = (start, stop)
            continue
        if kind in "{[":
            stack.append([kind, 0, None, stop])
            continue
        top = stack[-1]
        if kind == ":":
            top[2], top[3] = json.loads(window.text(*said)) if isinstance(said, tuple) else said, stop
            continue
        if len(stack) in depths:
            path = [str(level[1]) if level[0] == "[" else level[2] or "" for level in stack]
            fits = [all(w in ("*", p) for w, p in zip(pattern, path)) and len(pattern) == len(path) for pattern in (*wanted, *marks)]
            if any(fits[: len(wanted)]):
                text = window.text(top[3], start).strip()
                if text:
                    yield path, top[3], text.decode()
            elif any(fits) and (start - top[3] > 4096 or window.text(top[3], start).strip()):
                yield path, top[3], None
        if kind == ",":
            top[1], top[3] = top[1] + 1, stop
        else:
            stack.pop()


def _spread(rows: DataFrame, tasks: int) -> DataFrame:
    """One range or a few to a task."""
    return rows.repartition(tasks)


def document_ranges(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The byte ranges of all documents under ``path`` and what is open where each begins, staged. A document whose
    brackets or strings do not close fails the job. Empty files have no range."""
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    offsets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.select(F.col("_metadata.file_path").alias("source_path"), F.col("path").alias("file"), "length", offsets.alias("start"))
    ranges = ranges.select("source_path", "file", "start", F.least(F.col("start") + split_bytes, "length").alias("stop"))
    tasks = min(max(ranges.count(), 1), MOST_TASKS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            n = [_quotes(_Window(r["file"], r["start"], r["stop"])) for r in rows]
            yield pa.RecordBatch.from_pylist([r | {"n": k} for r, k in zip(rows, n)], schema=batch.schema.append(pa.field("n", pa.int64())))

    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    quotes = _spread(ranges, tasks).mapInArrow(counted, "source_path string, file string, start long, stop long, n long")
    known = quotes.withColumn("inside", F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).drop("n")

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["state"] = json.dumps(_summary(_Window(r["file"], r["start"], r["stop"]), r["inside"]))
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema.append(pa.field("state", pa.string())))

    def folded(group: pa.Table) -> pa.Table:
        """The few hundred bytes of each range of one document, in order."""
        out, stack, said, begun = [], [], None, False
        for r in group.sort_by("start").to_pylist():
            summary = json.loads(r["state"])
            out.append(r | {"state": json.dumps({"stack": stack, "said": said})})
            stack = _after(stack, said, begun, summary, r["file"])
            begun = begun or not summary["idle"]
            said = said if summary["idle"] else summary["said"]
        if stack:
            raise ValueError(f"{out[-1]['file']} ends inside {len(stack)} brackets")
        return pa.Table.from_pylist(out, schema=group.schema)

    reduced = _spread(known, tasks).mapInArrow(summarised, _STATES)
    return cut_lineage(_spread(reduced.groupBy("file").applyInArrow(folded, _STATES), tasks))


def document_values(ranges: DataFrame, wanted: Sequence[str], marks: Sequence[str] = ()) -> DataFrame:
    """``source_path, path, at, value``: the JSON text of every value at a ``wanted`` path (``groups.*.results.*``; a star
    stands for any position or key) and the byte it begins at. At ``marks`` a row says only that there is a value."""
    patterns, present = [tuple(p.split(".")) for p in wanted], [tuple(p.split(".")) for p in marks]
    schema = pa.schema([("source_path", pa.string()), ("path", pa.list_(pa.string())), ("at", pa.int64()), ("value", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = []
                for found in _values(_Window(r["file"], r["start"], r["stop"]), r["inside"], json.loads(r["state"]), patterns, present):
                    rows.append(dict(zip(schema.names, (r["source_path"], *found))))
                    if len(rows) == 2_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _spread(ranges, min(max(ranges.count(), 1), MOST_TASKS)).mapInArrow(cut, VALUES)


def _position(n: int) -> Column:
    return F.get("path", F.lit(n)).cast("int")


def _typed(value: Column, kind: str) -> Column:
    """A JSON value under a declared type; text that does not fit fails the job."""
    return F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")), f"v {kind}", {"mode": "FAILFAST"})["v"]


def _groups(ranges: DataFrame) -> DataFrame:
    """``source_path, group_pos, travel_key`` of every pass."""
    parts = document_values(ranges, ["groups.*.origin", "groups.*.mode"], ["groups.*"])
    field, text = F.get("path", F.lit(2)), _typed(F.col("value"), "string")
    named = parts.groupBy("source_path", _position(1).alias("group_pos")).agg(
        F.max(F.when(field == "origin", text)).alias("origin"), F.max(F.when(field == "mode", text)).alias("mode")
    )
    return named.select("source_path", "group_pos", F.concat_ws(":", "origin", "mode").alias("travel_key"))


def capture_rows(ranges: DataFrame) -> DataFrame:
    """The rows of ``captures.capture_rows``, of captures too large for one task."""
    groups, listing = _groups(ranges), f"struct<{SOURCE_LISTING}>"
    found = document_values(ranges, ["groups.*.results.*", "results.*"])
    nested = found.where(F.size("path") == 4).select("source_path", _position(1).alias("group_pos"), _position(3).alias("row_pos"), "value")
    flat = found.where(F.size("path") == 2).select("source_path", F.lit(0).alias("group_pos"), _position(1).alias("row_pos"), "value")
    flat = flat.join(groups.select("source_path").distinct(), "source_path", "left_anti").withColumn("travel_key", F.lit(None).cast("string"))
    rows = nested.join(groups, ["source_path", "group_pos"], "left").unionByName(flat).withColumn("row", _typed(F.col("value"), listing))
    return rows.select("source_path", "group_pos", "row_pos", "travel_key", F.col("row.id").alias("listing_id"), "row.*").drop("id")


def rejected_rows(ranges: DataFrame) -> DataFrame:
    """The rows of ``captures.rejected_rows``, of captures too large for one task."""
    found = document_values(ranges, ["groups.*.filtered_by_travel.*"])
    rows = found.select("source_path", _position(1).alias("group_pos"), _position(3).alias("row_pos"), _typed(F.col("value"), f"struct<{REJECTION}>").alias("row"))
    return rows.join(_groups(ranges), ["source_path", "group_pos"], "left").select(
        "source_path", "group_pos", "row_pos", "travel_key", F.col("row.id").alias("listing_id"), "row.url", "row.address",
        F.col("row.coords.lat").alias("lat"), F.col("row.coords.lng").alias("lon"), "row.travel",
    )


def cached(ranges: DataFrame, section: str) -> DataFrame:
    """``key`` and the columns of ``section`` (``geo`` or ``routes``), of memo documents too large for one task."""
    kind = ranges.sparkSession.createDataFrame([], CACHE_FILE).schema[section].dataType.valueType.simpleString()
    found = document_values(ranges, [f"{section}.*"])
    return found.select(F.get("path", F.lit(1)).alias("key"), _typed(F.col("value"), kind).alias("v")).select("key", "v.*")
