"""Approximate nearest neighbours by cosine: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample; every vector goes to one leaf. A query walks the tree with a priority queue of
branches, nearest centre first, and visits as many leaves as calibration found necessary: the visits are widened until
the true neighbours of sample queries, found by brute force over all rows in blocks, are met with the wanted recall.
Leaves are searched where their vectors are; leaves with many vectors or queries are divided into cells, so none meets
in one task. Candidates are scored on the original vectors in double precision.

Defined cases: vectors that are null, zero or empty, or that hold null or non-finite numbers take no part, nor do rows
without an id; vectors of different lengths have no cosine, so each length is searched by itself; rows of a repeated id
are rows of their own, as queries and as candidates; equal scores go by id; fewer candidates than asked for are all
returned; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingflow.llm.common import staged


@dataclass(frozen=True)
class Settings:
    """``sample``: vectors the tree is fitted on; ``leaf``: vectors of the whole table that a leaf should hold, and ``least``
    the fewest of the sample it is cut from; ``trials``: sample queries that calibrate the visits; ``recall``: what they
    must reach; ``cell``: vectors or queries compared at once."""

    sample: int = 20_000
    branches: int = 8
    leaf: int = 2500
    least: int = 16
    trials: int = 256
    recall: float = 0.95
    cell: int = 4096
    seed: int = 6


def unit(rows: np.ndarray) -> np.ndarray:
    rows = np.asarray(rows, np.float64)
    largest = np.abs(rows).max(1, keepdims=True)
    rows = rows / np.where(largest > 0, largest, 1)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines row by row: equal vectors get equal scores wherever they stand."""
    q, r = np.asarray(query, np.float64), np.asarray(rows, np.float64)
    q, r = q / np.abs(q).max(), r / np.abs(r).max(1, keepdims=True)
    return (r * q).sum(1) / (np.sqrt((q * q).sum()) * np.sqrt((r * r).sum(1)))


class Tree:
    """Nodes hold a centre and their children; leaves are numbered."""

    def __init__(self, sample: np.ndarray, settings: Settings, leaf: int):
        rng = np.random.default_rng(settings.seed)
        self.centres, self.children, self.leaf_of = [np.zeros(sample.shape[1])], [[]], [-1]
        self.leaves = 0
        todo = [(0, sample)]
        while todo:
            node, rows = todo.pop()
            parts = self._parts(rows, settings, rng) if len(rows) > leaf else []
            if len(parts) < 2:
                self.leaf_of[node], self.leaves = self.leaves, self.leaves + 1
                continue
            for centre, part in parts:
                self.children[node].append(len(self.centres))
                todo.append((len(self.centres), part))
                self.centres.append(centre)
                self.children.append([])
                self.leaf_of.append(-1)
        self.centres = np.array(self.centres)

    @staticmethod
    def _parts(rows, settings, rng):
        centres = np.unique(rows[rng.permutation(len(rows))[: settings.branches]], axis=0)
        for _ in range(12):
            nearest = (rows @ centres.T).argmax(1)
            centres = unit(np.array([rows[nearest == k].sum(0) for k in range(len(centres)) if (nearest == k).any()]))
        nearest = (rows @ centres.T).argmax(1)
        return [(c, rows[nearest == k]) for k, c in enumerate(centres) if (nearest == k).any()]

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child, again and again."""
        out, todo = np.zeros(len(rows), np.int32), [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if not self.children[node]:
                out[at] = self.leaf_of[node]
            elif len(at):
                kids = self.children[node]
                nearest = (rows[at] @ self.centres[kids].T).argmax(1)
                todo.extend((kid, at[nearest == k]) for k, kid in enumerate(kids))
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """Up to ``most`` leaves, best bin first."""
        near, queue, out = self.centres @ query, [(-1.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                out.append(self.leaf_of[node])
            for kid in self.children[node]:
                heapq.heappush(queue, (-near[kid], kid))
        return out


def clean(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(row, id, v): the vectors that take part; ``row`` tells rows of one id apart."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)
    )
    return usable.select(F.monotonically_increasing_id().alias("row"), "id", "v")


def sampled(rows: DataFrame, n: int, of: int) -> list:
    """About ``n`` of ``of`` rows, chosen by a hash; nothing else leaves its task."""
    share = min(1.0, n / max(of, 1))
    least = math.ceil((1 - 2 * share) * (1 << 63)) if share < 1 else -(1 << 63)
    return sorted(rows.where(F.xxhash64("id", "row") >= F.lit(max(least, -(1 << 63)))).collect(), key=lambda r: (r["id"], r["row"]))


def _block(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = batch.column("id").to_numpy()
    return batch.column("row").to_numpy(), ids, np.asarray(batch.column("v").flatten()).reshape(len(ids), -1)


def best(own: int, query: np.ndarray, own_rows: np.ndarray, ids: np.ndarray, rows: np.ndarray, rough: np.ndarray, k: int) -> list[tuple[int, int, int, float]]:
    """The k nearest of ``rows`` but the query's own row, exactly scored; ``rough`` scores choose who is scored."""
    at = np.flatnonzero(own_rows != own)
    if len(at) > k:
        at = at[rough[at] >= np.partition(rough[at], len(at) - k)[len(at) - k] - 1e-9]
    score = cosine(query, rows[at]) if len(at) else np.zeros(0)
    top = np.lexsort((own_rows[at], ids[at], -score))[:k]
    return [(own, int(own_rows[at[t]]), int(ids[at[t]]), float(score[t])) for t in top]


FOUND = "query long, row long, vec_id long, score double"
_FOUND = pa.schema([("query", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _ordered(found: DataFrame, k: int) -> DataFrame:
    by = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def brute_force(indexed: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """Exact neighbours of a bounded list of queries (row, vector), over all rows in blocks."""
    names, wanted = [q[0] for q in queries], np.array([q[1] for q in queries], float)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, ids, rows = _block(batch)
            if len(ids):
                rough = unit(wanted) @ unit(rows).T
                found = [f for n, q, s in zip(names, wanted, rough, strict=True) for f in best(n, q, own, ids, rows, s, k)]
                yield pa.RecordBatch.from_pylist([dict(zip(_FOUND.names, f)) for f in found], schema=_FOUND)

    return _ordered(indexed.select("row", "id", "v").mapInArrow(read, FOUND), k)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every row whose id is divisible by ``every``."""
    rows = staged(clean(vectors, key, vector), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy("n").collect()  # a table has few lengths
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for n, count in sizes:
        out = out.unionByName(_nearest(rows if len(sizes) == 1 else rows.where(F.size("v") == n), count, every, k, settings))
    return out


def _nearest(rows: DataFrame, count: int, every: int, k: int, settings: Settings) -> DataFrame:
    """:func:`nearest` among ``count`` rows (row, id, v) of one length."""
    sample = sampled(rows, settings.sample, count)
    if not sample:  # a handful of rows, and the hash chose none
        sample = rows.limit(settings.least).collect()
    # Leaves stay of one size while the table grows, down to what the sample can tell apart; a small table has several too.
    leaf = max(settings.least, min(settings.leaf, count // settings.branches) * len(sample) // count)
    tree = Tree(unit(np.array([r["v"] for r in sample])), settings, leaf)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ids, values = _block(batch)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), batch.column("v"), pa.array(tree.assign(unit(values)) if len(ids) else [], pa.int32())], ["row", "id", "v", "leaf"])

    indexed = staged(rows.mapInArrow(placed, "row long, id long, v array<double>, leaf int"), "leaves")

    # Widen the visits until the sample queries' true neighbours are met.
    at = np.random.default_rng(settings.seed).permutation(len(sample))[: settings.trials]
    trials = [(sample[n]["row"], sample[n]["v"]) for n in at]
    truth = brute_force(indexed, trials, k)
    leaf_of = truth.join(indexed.select("row", "leaf"), "row").select("query", "leaf").collect()
    order = {q: {leaf: n for n, leaf in enumerate(tree.visits(unit(np.array([v]))[0], tree.leaves))} for q, v in trials}
    met = np.sort([order[r["query"]][r["leaf"]] for r in leaf_of]) if leaf_of else np.zeros(1, int)
    visits = int(met[min(len(met) - 1, int(np.ceil(settings.recall * len(met))))]) + 1

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ids, values = _block(batch)
            leaves = [tree.visits(q, visits) for q in unit(values)] if len(ids) else []
            row = pa.array(np.repeat(np.arange(len(ids)), [len(x) for x in leaves]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in ("row", "id", "v")), pa.array([x for y in leaves for x in y], pa.int32())], ["row", "id", "v", "leaf"])

    questions = staged(indexed.where(F.col("id") % every == 0).select("row", "id", "v").mapInArrow(asked, "row long, id long, v array<double>, leaf int"), "questions")
    parts = lambda df, name: df.groupBy("leaf").agg(F.ceil(F.count("*") / settings.cell).cast("int").alias(name))
    sizes = parts(indexed, "rows").join(parts(questions, "asks"), "leaf")  # one row per leaf: bounded by the sample
    mine = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = indexed.join(sizes, "leaf").select("leaf", mine("rows").alias("r"), spread("asks").alias("q"), "row", "id", "v")
    put = questions.join(sizes, "leaf").select("leaf", spread("rows").alias("r"), mine("asks").alias("q"), "row", "id", "v")

    def search(those: pd.DataFrame, these: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int, float]] = []
        if len(those) and len(these):
            wanted, values, own, ids = np.vstack(those["v"]), np.vstack(these["v"]), these["row"].to_numpy(), these["id"].to_numpy()
            ready = unit(values).T
            for first in range(0, len(wanted), 256):
                part = wanted[first : first + 256]
                for n, q, rough in zip(those["row"][first : first + 256], part, unit(part) @ ready, strict=True):
                    found += best(int(n), q, own, ids, values, rough, k)
        return pd.DataFrame(found, columns=_FOUND.names)

    cell = ["leaf", "r", "q"]
    found = put.groupBy(*cell).cogroup(held.groupBy(*cell)).applyInPandas(search, FOUND)
    # The query's own id: rows of ``found`` are few per query.
    names = indexed.where(F.col("id") % every == 0).select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return _ordered(found, k).join(names, "query").select("query_id", "rank", "vec_id", "score")
