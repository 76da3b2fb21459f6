"""SimHash near-deduplication with bit-sliced comparison.

Equal fingerprints collapse first. Two fingerprints within the radius agree on at least ``blocks - radius`` of their
blocks, so each is dealt to one bucket per choice of that many blocks: no link is lost. Inside a bucket fingerprints
stand in one order and bit planes hold bit b of all of them side by side: for one distance in that order, XOR of a plane
with itself shifted gives the differing bits of all neighbours at once, carry-save counters add them up, and a block is
abandoned as soon as every pair in it exceeds the radius. Buckets above a size are divided into chunks and every pair of
chunks is compared, so no bucket meets in one task and none is cut short. A task passes on only links that join what was
apart (a spanning forest), which leaves components as they are.

Defined cases: a text without words (null, empty, white space) has fingerprint zero; shorter texts than a shingle are
one shingle; repeated rows share a fingerprint; null ids never name a component unless no id is there; an empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingflow.llm.common import staged, text_slices, unused
from listingflow.llm.components import components

#: Largest bucket that is compared as one; larger ones are divided.
BUCKET = 2048
#: Fingerprints a task compares side by side.
SIDE_BY_SIDE = 16384


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = (ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = hashes[at : at + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_hash, fp) of every row, over whole texts; fp is the fingerprint as a signed long."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            values = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(values)], ["doc_id", "text_hash", "fp"])

    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    return keyed.mapInArrow(read, f"doc_id {id_type}, text_hash long, fp long")


class Forest:
    """Union-find over positions; ``labels`` are kept flat so that pairs already joined are skipped as arrays."""

    def __init__(self, n: int):
        self.labels = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Positions in ``a`` whose pair joined two trees."""
        la, lb = self.labels[a], self.labels[b]
        todo = np.flatnonzero(la != lb)
        if not len(todo):
            return todo
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while x in parent:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        used = []
        for k, x, y in zip(todo.tolist(), la[todo].tolist(), lb[todo].tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                used.append(k)
        moved = np.arange(len(self.labels))
        for x in parent:
            moved[x] = root(x)
        self.labels = moved[self.labels]
        return np.array(used, np.int64)


def _number(bits: np.ndarray) -> int:
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def near_pairs(values: np.ndarray, bucket: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of all pairs within ``radius`` bits in the same bucket; rows of one bucket stand together."""
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(bucket)]]))
    classes = np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
    for size_class in np.unique(classes[sizes > 1]):
        chosen = np.flatnonzero((classes == size_class) & (sizes > 1))
        at = np.concatenate([np.arange(starts[c], starts[c] + sizes[c]) for c in chosen])
        left = np.concatenate([np.arange(sizes[c])[::-1] for c in chosen])  # rows of the bucket that follow
        bits = np.unpackbits(values[at].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        planes = [_number(bits[:, b]) for b in range(64)]
        for lag in range(1, int(sizes[chosen].max())):
            active = _number(left >= lag)
            ones = twos = fours = over = 0
            for plane in planes:
                carry = plane ^ (plane >> lag)
                ones, carry = ones ^ carry, ones & carry
                if radius >= 1:
                    twos, carry = twos ^ carry, twos & carry
                if radius >= 3:
                    fours, carry = fours ^ carry, fours & carry
                # Counters wide enough for the radius: what exceeds them, or its value, is out for good.
                over |= carry | _exceeds(ones, twos, fours, radius)
                if not active & ~over:
                    break
            else:
                alive = active & ~over
                hit = np.flatnonzero(np.unpackbits(np.frombuffer(alive.to_bytes((len(at) + 7) // 8, "little"), np.uint8), bitorder="little"))
                yield at[hit], at[hit + lag]


def _exceeds(ones: int, twos: int, fours: int, radius: int) -> int:
    """Lanes whose three-bit count is above ``radius`` (0 to 7)."""
    out = 0
    equal = -1
    for bit, lane in ((4, fours), (2, twos), (1, ones)):
        if radius & bit:
            equal &= lane
        else:
            out |= equal & lane
            equal &= ~lane
    return out


def fingerprint_links(prints: DataFrame, radius: int = 3, blocks: int = 5, bucket: int = BUCKET) -> DataFrame:
    """(u, v): links between fingerprints of ``prints`` (fp, distinct) within ``radius`` bits, enough to join all that
    are connected."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    choices = [sum(masks[c] for c in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in choices]
    keys = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("choice", "part"))
    crowded = keys.groupBy("choice", "part").agg(F.count("*").alias("n")).where(F.col("n") > bucket)
    crowded = crowded.select("choice", "part", F.ceil(F.col("n") / bucket).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp", "choice"), F.col("chunks")).cast("int")
    dealt = (
        keys.join(crowded, ["choice", "part"], "left")
        .withColumn("chunk", F.coalesce(chunk, F.lit(0)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1)))
        .select("fp", "choice", "part", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"))
    )
    cell = ["choice", "part", "a", "b"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(fp: np.ndarray, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
            number = np.concatenate([[0], np.cumsum((cells[1:] != cells[:-1]).any(1))])
            # A repeated fingerprint in one cell would only link to itself.
            forest = Forest(len(fp))
            for i, j in near_pairs(fp.view(np.uint64), number, radius):
                new = forest.join(i, j)
                if len(new):
                    yield pa.RecordBatch.from_arrays([pa.array(fp[i[new]]), pa.array(fp[j[new]])], ["u", "v"])

        fp, cells = np.zeros(0, np.int64), np.zeros((0, 4), np.int64)
        for batch in batches:
            fp = np.concatenate([fp, batch.column("fp").to_numpy()])
            cells = np.vstack([cells, np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in cell])])
            while len(fp) > SIDE_BY_SIDE:
                changes = np.flatnonzero((cells[1:] != cells[:-1]).any(1)) + 1
                whole = changes[changes <= SIDE_BY_SIDE]
                end = whole[-1] if len(whole) else changes[0] if len(changes) else None
                if end is None:
                    break
                yield from linked(fp[:end], cells[:end])
                fp, cells = fp[end:], cells[end:]
        if len(fp):
            yield from linked(fp, cells)

    return dealt.repartition(*cell).sortWithinPartitions(*cell, "fp").mapInArrow(read, "u long, v long")


def fingerprint_groups(of_rows: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, component) of every fingerprint in ``of_rows``; a component is named by one of its fingerprints."""
    prints = staged(of_rows.select("fp").distinct(), "prints")
    joined = components(fingerprint_links(prints, radius)).select(F.col("node").alias("fp"), "component")
    return prints.join(joined, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    of_rows = staged(fingerprints(docs, shingle, seed), "fingerprints")
    groups = staged(fingerprint_groups(of_rows, radius), "groups")
    least = of_rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(groups, "fp")
    of_component = least.groupBy("component").agg(F.min("least").alias("component_id"))
    names = groups.join(of_component, "component").select("fp", "component_id")
    return of_rows.join(names, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for every id and text of ``kept`` (id, hash and other columns): the columns of ``docs``, then the others.
    No other column of ``kept`` may have a name of ``docs``."""
    key, text_key, number = (unused(docs, name) for name in ("llm_id", "llm_hash", "llm_k"))
    kept = kept.withColumnsRenamed({"id": key, "hash": text_key})
    # Rows of a kept id and text may repeat; numbering them needs no further shuffle.
    repeated = W.partitionBy(key, text_key).orderBy(F.lit(0))
    found = docs.join(kept, docs["doc_id"].eqNullSafe(F.col(key)) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(text_key)))
    return found.withColumn(number, F.row_number().over(repeated)).where(F.col(number) == 1).drop(key, text_key, number)
