"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Each document becomes a short vector of statistics of its whole text. Random Fourier features approximate a Gaussian
kernel over the standardised vectors; every task sums the normal equations of its rows and the sums are added by key,
so no row ever leaves its task. Scores made out of fold are calibrated by isotonic regression on a fixed grid.

Defined cases: a null or empty text has all statistics zero and is scored like any other; a null id is never labelled;
labels other than 0 and 1 and null labels teach nothing; a document labelled several times counts once with the mean
label; without any usable label every score is 0.5; repeated rows are scored one by one; an empty table gives an
empty result. Other columns of the inputs are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import staged, text_slices

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "mean_word", "long_words", "distinct_words", "distinct_lines", "upper", "digits",
    "spaces", "newlines", "stops", "commas", "exclaims", "bars", "symbols", "high_bytes", "entropy", "distinct_pairs", "zip_ratio",
)
WIDTH = len(STATISTICS)


@dataclass(frozen=True)
class Settings:
    """``features``: random features; ``folds``: out-of-fold scores; ``grid``: steps of the calibration grid per unit."""

    features: int = 256
    bandwidth: float = 4.0
    ridge: float = 1e-2
    folds: int = 4
    grid: int = 512
    seed: int = 20


def statistics(text: str) -> list[float]:
    import zlib

    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * WIDTH
    size, counts = len(raw), np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    n, bytes_of_words = max(1, len(words)), size - int(counts[[9, 10, 11, 12, 13, 32]].sum())
    shares = counts[counts > 0] / size
    punctuation = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    stops, commas, exclaims, bars = int(counts[46]), int(counts[44]), int(counts[33]), int(counts[124])
    # Compressibility block by block: every byte counts, memory stays fixed.
    packed = sum(len(zlib.compress(raw[i : i + 65536], 1)) for i in range(0, size, 65536))
    return [
        math.log1p(size), math.log1p(len(words)), math.log1p(len(lines)), bytes_of_words / n,
        sum(map((20).__lt__, map(len, words))) / n, len(set(words)) / n, len(set(lines)) / len(lines),
        int(counts[65:91].sum()) / size, int(counts[48:58].sum()) / size, int(counts[32]) / size, int(counts[10]) / size,
        stops / n, commas / n, exclaims / n, bars / n, (punctuation - stops - commas - exclaims - bars) / n,
        int(counts[128:].sum()) / size, float(-(shares * np.log2(shares)).sum()), len(set(zip(words, words[1:]))) / n, packed / size,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) of every row, over whole texts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", _arrow(id_type)), ("statistics", pa.list_(pa.float64()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(schema.field(0).type), pa.array([statistics(t) for t in texts], schema.field(1).type)], schema=schema
            )

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {id_type}, statistics array<double>")


def _arrow(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


class Kernel:
    """The random feature map of standardised statistics; the same for the same settings anywhere."""

    def __init__(self, settings: Settings, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(settings.seed)
        self.mean, self.spread = mean, spread
        self.directions = rng.standard_normal((len(mean), settings.features)) / settings.bandwidth
        self.phases = rng.uniform(0, 2 * np.pi, settings.features)
        self.scale = np.sqrt(2 / settings.features)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        standard = np.clip((rows - self.mean) / self.spread, -8, 8)
        waves = self.scale * np.cos(standard @ self.directions + self.phases)
        return np.hstack([waves, standard / 8, np.ones((len(rows), 1))])


@dataclass
class Model:
    kernel: Kernel
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.kernel(rows) @ self.weights, self.knots, self.levels), 0.0, 1.0)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("statistics").flatten()).reshape(-1, WIDTH)


def normal_equations(train: DataFrame, kernel: Kernel, folds: int) -> tuple[np.ndarray, np.ndarray]:
    """Per fold: the sums of z'z and z'y. Tasks emit their sums row by row of the matrix; rows of one number are added
    in one task each, a stream of fixed-size vectors, and folds x features rows come to the driver."""
    size = len(kernel.phases) + len(kernel.mean) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, size, size + 1))
        for batch in batches:
            fold, y = batch.column("fold").to_numpy(), batch.column("label").to_numpy()
            z = kernel(_rows(batch))
            for f in range(folds):
                at = fold == f
                total[f] += z[at].T @ np.hstack([z[at], y[at, None]])
        if total.any():
            f, i = np.divmod(np.arange(folds * size), size)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(i, pa.int32()), pa.array(list(total.reshape(-1, size + 1)), pa.list_(pa.float64()))], ["f", "i", "v"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for f, i, v in zip(batch.column("f").to_pylist(), batch.column("i").to_pylist(), np.asarray(batch.column("v").flatten()).reshape(-1, size + 1), strict=True):
                total[f, i] = total[f, i] + v if (f, i) in total else v.copy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["f", "i", "v"])

    schema = "f int, i int, v array<double>"
    gathered = train.mapInArrow(sums, schema).repartition(F.col("f"), F.col("i")).mapInArrow(added, schema)
    whole = np.zeros((folds, size, size + 1))
    for f, i, v in gathered.collect():
        whole[f, i] = v
    return whole[:, :, :size], whole[:, :, size]


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; the weighted mean position and level of every pooled block."""
    blocks: list[list[float]] = []
    for at, level, w in zip(x, y, weight, strict=True):
        blocks.append([at * w, level * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    pooled = np.array(blocks)
    return pooled[:, 0] / pooled[:, 2], pooled[:, 1] / pooled[:, 2]


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """``labelled``: (doc_id, statistics, label between 0 and 1), every row of which is learnt from."""
    moments = labelled.agg(
        *[F.avg(F.col("statistics")[i]).alias(f"m{i}") for i in range(WIDTH)],
        *[F.stddev_pop(F.col("statistics")[i]).alias(f"s{i}") for i in range(WIDTH)],
    ).first()
    if moments[0] is None:
        kernel = Kernel(settings, np.zeros(WIDTH), np.ones(WIDTH))
        return Model(kernel, np.zeros(settings.features + WIDTH + 1), np.zeros(1), np.full(1, 0.5))
    spread = np.array(moments[WIDTH:], float)
    kernel = Kernel(settings, np.array(moments[:WIDTH], float), np.where(spread > 1e-9, spread, 1.0))
    fold = F.pmod(F.crc32(F.concat(F.lit("fold "), F.col("doc_id").cast("string"))), F.lit(settings.folds)).cast("int")
    train = labelled.select(fold.alias("fold"), "statistics", F.col("label").cast("double").alias("label"))
    left, right = normal_equations(train, kernel, settings.folds)
    count = left[:, -1, -1].sum()
    penalty = settings.ridge * max(count, 1) / settings.features * np.eye(left.shape[1])
    penalty[-1, -1] = 1e-9  # the intercept stays free

    def solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.linalg.lstsq(a + penalty, b, rcond=None)[0]

    weights = solved(left.sum(0), right.sum(0))
    apart = np.array([solved(left.sum(0) - left[f], right.sum(0) - right[f]) for f in range(settings.folds)])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            raw = np.einsum("ij,ij->i", kernel(_rows(batch)), apart[fold])
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(np.clip(raw, -1, 2) * settings.grid).astype(np.int32)), batch.column("label")], ["bin", "label"])

    bins = train.mapInArrow(binned, "bin int, label double").groupBy("bin").agg(F.avg("label"), F.count("*")).orderBy("bin").collect()
    x, y, w = (np.array(c, float) for c in zip(*bins, strict=True))
    knots, levels = isotonic(x / settings.grid, y, w)
    return Model(kernel, weights, knots, levels)


def score_documents(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``stats``."""
    id_type = stats.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_rows(batch)))], ["doc_id", "score"])

    return stats.select("doc_id", "statistics").mapInArrow(scored, f"doc_id {id_type}, score double")


def held_out(doc_id: Column) -> Column:
    """The fifth of all documents whose labels are never learnt from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def learnt(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, Model]:
    """The statistics of every row and a model fitted to the labels of rows that are not held out."""
    stats = staged(document_statistics(docs), "statistics")
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.avg("quality").alias("label"))
    )
    return stats, fit(staged(stats.join(known, "doc_id"), "labelled"), settings)


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; labels of held-out rows are not read."""
    stats, model = learnt(docs, labels, settings)
    return score_documents(stats, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns. Scores depend on the text alone and are made
    where the row is read, so texts are not shuffled."""
    _, model = learnt(docs, labels, settings)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            rows = np.array([statistics(t) for t in texts]).reshape(-1, WIDTH)
            yield part.filter(pa.array(model.score(rows) >= threshold))

    return docs.mapInArrow(kept, docs.schema)
