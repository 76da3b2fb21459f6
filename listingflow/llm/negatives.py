"""Hard-negative mining: a secondary sort and one stream per anchor.

Every usable row gets whole-number components floor(scale * x); a score is the inner product of two rows. Scored rows are
keyed by (anchor, descending score, positives before negatives, id), dealt by anchor and sorted inside the partitions (the
DataFrame form of repartitionAndSortWithinPartitions). One iterator streams them: a positive opens a window from its own
score down to a share of it, a negative is emitted to every window that is open and not full, so an anchor holds its open
windows and nothing else.

What no window can take is not shuffled. Rows and anchors meet in cells of bounded size; a task keeps per anchor only the
first positives it has seen, and those of all tasks give each anchor its windows. In a second pass it keeps per anchor and
window only the first negatives. Both are exact: what a task drops is beaten by what it keeps.

Defined cases: a row takes no part without an id, a label or a vector, or with a null or non-finite component; rows of a
repeated id are rows of their own, and so are repeated anchors; rows of another length than the anchor's have no score with
it; an empty vector scores 0; equal scores go by id, then by the order rows were stored in; scores beyond 64 bits are held
at the nearest long; an anchor without positives, or whose positives score below zero, has no row; an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import staged

#: Rows, and anchors, of one cell; anchors scored side by side.
CELL, TOGETHER = 2048, 256
#: The largest long and the largest double.
MOST, FINITE = (1 << 63) - 1, float(np.finfo(np.float64).max)


@dataclass(frozen=True)
class Settings:
    """``anchors``: rows whose id is divisible by this ask; ``positives``: of the same label, per anchor; ``negatives``: per
    positive, with ``low`` to 100 hundredths of its score; ``scale`` of the components."""

    anchors: int = 100
    positives: int = 5
    negatives: int = 5
    low: int = 80
    scale: int = 256

    def floor(self, score: int) -> int:
        """The least score that a window of this positive takes."""
        return -(-self.low * score // 100)


def usable(rows: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(row, id, label, v): the rows that take part; ``row`` tells rows of one id apart."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    chosen = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False))
    )
    # Doubles: whole numbers of any size, exact below 2 ** 53 and held exactly above it.
    whole = F.transform("v", lambda x: _floored(x * scale))
    return chosen.select(F.monotonically_increasing_id().alias("row"), "id", "label", whole.alias("v"))


def _floored(x):
    """floor as a double: from 2 ** 52 on every double is whole, and ``floor`` would leave the range of a long."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(F.least(F.greatest(x, F.lit(-FINITE)), F.lit(FINITE)))


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as longs. Doubles add whole numbers exactly as long as no sum can reach 2 ** 53."""
    if not anchors.shape[1]:
        return np.zeros((len(anchors), len(rows)), np.int64)
    with np.errstate(over="ignore"):
        largest = np.abs(anchors).sum(1).max(initial=0) * np.abs(rows).max(initial=0)
    if largest < float(1 << 53):
        return (anchors @ rows.T).astype(np.int64)
    left, right = ([[int(x) for x in vector] for vector in side] for side in (anchors, rows))
    return np.array([[min(MOST, max(-MOST, sum(x * y for x, y in zip(a, r)))) for r in right] for a in left], np.int64)


@dataclass
class Side:
    """Anchors of one chunk and what is held for them."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    v: np.ndarray
    windows: list[list[tuple[int, int]]]
    held: list[dict]


def _first(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Positions of the first ``n`` by descending score, then id, then row."""
    at = np.arange(len(score))
    if len(at) > n:
        at = at[score >= np.partition(score, len(score) - n)[len(score) - n]]
    return at[np.lexsort((rows[at], ids[at], -score[at]))[:n]]


def _keep(held: dict, window, score, ids, rows, n: int) -> None:
    """Merge candidates into what one anchor holds for one window."""
    if len(score):
        at = _first(score, ids, rows, n)
        mine = held.get(window, []) + list(zip((-int(s) for s in score[at]), ids[at].tolist(), rows[at].tolist()))
        held[window] = sorted(mine)[:n]


def _scored(settings: Settings, positive: bool):
    """Cells, sorted, anchors first: per anchor what this task's rows offer. A chunk of anchors is held at a time."""
    names = ["anchor", "anchor_id", "negative", "score", "id", "row"]

    def flush(side: Side | None) -> Iterator[pa.RecordBatch]:
        if side is None:
            return
        out = []
        for k, held in enumerate(side.held):
            best = {(s, i, r) for found in held.values() for s, i, r in found}
            out += [(int(side.row[k]), int(side.id[k]), not positive, -s, i, r) for s, i, r in sorted(best)]
        columns = list(zip(*out)) if out else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    def meet(side: Side, rows: Side) -> None:
        for at in range(0, len(side.row), TOGETHER):
            scores = products(side.v[at : at + TOGETHER], rows.v)
            for k, score in enumerate(scores, at):
                same = rows.label == side.label[k]
                if positive:
                    mine = np.flatnonzero(same & (rows.row != side.row[k]))
                    _keep(side.held[k], 0, score[mine], rows.id[mine], rows.row[mine], settings.positives)
                    continue
                for low, high in side.windows[k]:
                    mine = np.flatnonzero(~same & (score >= low) & (score <= high))
                    _keep(side.held[k], (low, high), score[mine], rows.id[mine], rows.row[mine], settings.negatives)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side, chunk, cell, waiting = None, None, None, []

        def gathered(parts: list[pa.RecordBatch]) -> Side:
            one = pa.Table.from_batches(parts).combine_chunks()
            lists = one.column("windows").to_pylist()
            values, n = one.column("v").chunk(0).flatten().to_numpy(zero_copy_only=False), one.num_rows
            return Side(
                one.column("row").to_numpy(), one.column("id").to_numpy(), one.column("label").to_numpy(), values.reshape(n, len(values) // n),
                [[(settings.floor(s), s) for s in dict.fromkeys(w or [])] for w in lists], [{} for _ in range(n)],
            )

        def close() -> Iterator[pa.RecordBatch]:
            """The rows of one kind and cell are together."""
            nonlocal side, chunk
            if not waiting:
                return
            asks, here = cell[-1] == 0, cell[:2]
            if asks and here != chunk:
                yield from flush(side)
                side, chunk = gathered(waiting), here
            elif not asks and here == chunk:
                meet(side, gathered(waiting))
            waiting.clear()

        for batch in batches:
            at = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("n", "a", "r", "kind")], 1)
            edges = np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1
            for start, end in zip([0, *edges], [*edges, len(at)]):
                if start == end:
                    continue
                now = tuple(at[start].tolist())
                if now != cell:
                    yield from close()
                    cell = now
                waiting.append(batch.slice(start, end - start))
        yield from close()
        yield from flush(side)

    return read, "anchor long, anchor_id long, negative boolean, score long, id long, row long"


def _cells(rows: DataFrame, anchors: DataFrame, settings: Settings, positive: bool) -> DataFrame:
    """Scored candidates: every anchor meets every row of its length in one cell."""
    numbered = lambda df, name: df.groupBy("n").agg(F.ceil(F.count("*") / CELL).cast("int").alias(name))
    rows, anchors = (df.withColumn("n", F.size("v")) for df in (rows, anchors))
    sizes = staged(numbered(rows, "rs").join(numbered(anchors, "as"), "n"), "cells")  # one row per length of vectors
    mine = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    windows = F.col("windows") if "windows" in anchors.columns else F.lit(None).cast("array<long>")
    asks = anchors.join(sizes, "n").select("n", mine("as").alias("a"), every("rs").alias("r"), F.lit(0).alias("kind"), "row", "id", "label", "v", windows.alias("windows"))
    held = rows.join(sizes, "n").select("n", every("as").alias("a"), mine("rs").alias("r"), F.lit(1).alias("kind"), "row", "id", "label", "v", F.lit(None).cast("array<long>").alias("windows"))
    read, schema = _scored(settings, positive)
    # A chunk of anchors meets the rows of all its cells in a task one after the other.
    dealt = asks.unionByName(held).repartition("n", "a", "r").sortWithinPartitions("n", "a", "r", "kind")
    return dealt.mapInArrow(read, schema)


def _mined(settings: Settings):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened, windows = None, 0, []  # a window: positive, its score, the least score it takes, taken so far
        for batch in batches:
            out = []
            for a, name, negative, score, i in zip(*(batch.column(c).to_pylist() for c in ("anchor", "anchor_id", "negative", "score", "id"))):
                if a != anchor:
                    anchor, opened, windows = a, 0, []
                if not negative:
                    if opened < settings.positives and score >= 0:
                        windows.append([i, score, settings.floor(score), 0])
                    opened += 1
                    continue
                for window in windows:
                    if score >= window[2]:
                        window[3] += 1
                        out.append((name, window[0], window[3], i, window[1], score))
                windows = [w for w in windows if w[3] < settings.negatives and score >= w[2]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, kinds)], names)

    return read, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    held = staged(usable(rows, key, vector, label, settings.scale), "negatives-rows")
    anchors = held.where(F.col("id") % settings.anchors == 0)
    order = ["anchor", F.desc("score"), "negative", "id", "row"]
    offered = staged(_cells(held, anchors, settings, positive=True), "positives")
    first = staged(offered.repartition("anchor").sortWithinPartitions(*order).mapInArrow(_heads(settings.positives), offered.schema), "first-positives")
    # At most ``positives`` scores per anchor.
    windows = first.where("score >= 0").groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("windows"))
    asking = staged(anchors.join(windows, "row"), "anchors")
    scored = _cells(held, asking, settings, positive=False).unionByName(first)
    read, schema = _mined(settings)
    return scored.repartition("anchor").sortWithinPartitions(*order).mapInArrow(read, schema)


def _heads(n: int):
    """The first ``n`` rows of each anchor in a sorted partition."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, seen = None, 0
        for batch in batches:
            keep = []
            for k, a in enumerate(batch.column("anchor").to_pylist()):
                anchor, seen = (a, seen + 1) if a == anchor else (a, 1)
                if seen <= n:
                    keep.append(k)
            yield batch.take(pa.array(keep, pa.int64()))

    return read


def relabelled(label, key):
    """The label of the registered query: rows whose id is divisible by 7 move to the next of ten labels."""
    return F.when(key % 7 == 0, (label.cast("long") + 1) % 10).otherwise(label.cast("long"))
