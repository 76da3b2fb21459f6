"""Best-fit packing of tokenised documents after a dominance reduction.

Lengths are whole numbers up to the capacity, so the instance is fully described by one count per length; those counts
(at most ``capacity`` numbers, whatever the corpus) are planned on the driver. Martello and Toth's reduction first fixes
small sets that provably dominate every alternative for their largest member; the rest is packed best fit, longest
first. The plan says, per length, which rank goes to which sequence and place; pieces are ranked in parallel, by salted
running counts, and take their places.

Defined cases: a null or empty text is its end token alone; only documents longer than the capacity are cut; repeated
rows and null ids are packed like any other; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingflow.llm.codec import MEMO, plain_words
from listingflow.llm.common import load_tokenizer, staged, text_slices, tokenizer_path
from listingflow.llm.counts import SPACE, byte_letters

CAPACITY, END = 2048, 0
SALTS = 1024
Pattern = tuple[int, ...]


class RunIds(dict):
    """Ids of runs between white space as little-endian 32-bit numbers, made by the tokenizer when first asked for. The
    vocabulary drops white space, so a text's ids are those of its runs. Words are kept apart from the runs they stand
    in (with a capital, with a mark), so that each is encoded once; both memos are bounded."""

    def __init__(self, path: str):
        self.tokenizer, self.words, self.letters = load_tokenizer(path), {}, byte_letters()

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) > MEMO:
                self.words.clear()
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = self.words[word] = np.array([t.id for t in self.tokenizer.model.tokenize(letters)], "<u4").tobytes()
        return ids

    def __missing__(self, run: str) -> bytes:
        words = plain_words(run)
        if words:
            ids = b"".join(map(self.word, words))
        else:
            ids = np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) > MEMO:
            self.clear()
        self[run] = ids
        return ids


@lru_cache(maxsize=2)
def run_ids(path: str) -> RunIds:
    return RunIds(path)


def token_bytes(text: str, path: str) -> bytes:
    """Ids of a text as little-endian 32-bit numbers."""
    runs = _RUNS(text) if _ODD_SPACE(text) else text.split()
    return b"".join(map(run_ids(path).__getitem__, runs))


_ODD_SPACE, _RUNS = re.compile("[\x1c-\x1f]").search, re.compile(f"[^{SPACE}]+").findall


def pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""
    path, id_type = tokenizer_path(vocabulary), docs.schema["doc_id"].dataType.simpleString()
    end, step = np.array([END], "<u4").tobytes(), 4 * capacity

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, 4 << 20):
            row, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(texts):
                ids = token_bytes(text, path) + end
                for n, at in enumerate(range(0, len(ids), step)):
                    chunk = ids[at : at + step]
                    row.append(k)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(chunk) // 4)
                    crc.append(zlib.crc32(chunk))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


class _Sizes:
    """A multiset of lengths that stays sorted."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {s: c for s, c in counts.items() if c > 0}
        self.sizes = sorted(self.counts)

    def take(self, size: int, n: int = 1) -> None:
        self.counts[size] -= n
        if not self.counts[size]:
            del self.counts[size]
            self.sizes.remove(size)

    def largest(self, most: int) -> int | None:
        at = bisect.bisect_right(self.sizes, most)
        return self.sizes[at - 1] if at else None

    def smallest(self, n: int) -> list[int]:
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(n - len(out), self.counts[s])
            if len(out) == n:
                break
        return out


def dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Sets that dominate every feasible set with the same largest member, with how often each is fixed, and the lengths
    that remain. {w, k} dominates when k fills the sequence, when no two others fit beside w, or when at most two fit and
    no two are larger than k together; {w, k, b} when at most two fit and no fitting pair is larger in either member."""
    left, fixed = _Sizes(counts), []
    for w in sorted(left.counts, reverse=True):
        while left.counts.get(w):
            room, n = capacity - w, left.counts[w]
            others = _Sizes(left.counts | {w: n - 1})
            k = others.largest(room)
            if k is None:
                fixed.append(((w,), n))
                left.take(w, n)
                break
            small = others.smallest(3)
            found: Pattern | None = None
            if k == room or len(small) < 2 or small[0] + small[1] > room:
                found = (w, k)
            elif len(small) < 3 or sum(small) > room:
                best = _largest_pair(others, room)
                b = _Sizes(others.counts | {k: others.counts[k] - 1}).largest(room - k)
                if best is None or k >= best:
                    found = (w, k)
                elif b is not None and not _pair_above(others, b, room):
                    found = (w, k, b)
            if found is None:
                break
            times = min(left.counts[s] // found.count(s) for s in set(found))
            fixed.append((found, times))
            for s in set(found):
                left.take(s, times * found.count(s))
    return fixed, left.counts


def _largest_pair(others: _Sizes, room: int) -> int | None:
    best, sizes = None, others.sizes
    i, j = 0, len(sizes) - 1
    while i <= j:
        total = sizes[i] + sizes[j]
        if total > room:
            j -= 1
            continue
        if i != j or others.counts[sizes[i]] > 1:
            best = max(best or 0, total)
        i += 1
    return best


def _pair_above(others: _Sizes, b: int, room: int) -> bool:
    """Whether two lengths both above ``b`` fit together."""
    two = []
    for s in others.sizes[bisect.bisect_right(others.sizes, b) :]:
        two += [s] * min(2 - len(two), others.counts[s])
        if len(two) == 2:
            break
    return len(two) == 2 and sum(two) <= room


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, over counts: sequences with the same filling are kept once with their number."""
    closed: list[tuple[Pattern, int]] = []
    rooms: list[int] = []
    open_by_room: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)

    def add(room: int, pattern: Pattern, n: int) -> None:
        if not room:
            closed.append((pattern, n))
            return
        if not open_by_room[room]:
            bisect.insort(rooms, room)
        open_by_room[room].append((pattern, n))

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            at = bisect.bisect_left(rooms, w)
            if at == len(rooms):
                each = capacity // w
                if n >= each:
                    add(capacity - each * w, (w,) * each, n // each)
                    n %= each
                else:
                    add(capacity - n * w, (w,) * n, 1)
                    n = 0
                continue
            room = rooms[at]
            pattern, many = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms.pop(at)
            fit = room // w  # best fit goes on filling the sequence it has chosen
            if n >= fit:
                times = min(many, n // fit)
                add(room - fit * w, pattern + (w,) * fit, times)
                n -= times * fit
            else:
                times = 1
                add(room - n * w, pattern + (w,) * n, 1)
                n = 0
            if many > times:
                add(room, pattern, many - times)
    return closed + [p for v in open_by_room.values() for p in v]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Fillings and their numbers for all lengths."""
    fixed, rest = dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def placements(patterns: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset) in rank order."""
    places, ranks, sequence = defaultdict(list), defaultdict(int), 0
    for pattern, times in patterns:
        offset = 0
        for size in pattern:
            places[size].append((ranks[size], sequence, offset))
            ranks[size] += times
            offset += size
        sequence += times
    return {size: np.array(rows, np.int64) for size, rows in places.items()}


def ranked(cut: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0 (column ``rank``): numbers inside salted parts plus the parts before."""
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    ahead = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("k", F.row_number().over(inside))
    return numbered.join(ahead, ["length", "salt"]).select(*cut.columns, (F.col("ahead") + F.col("k") - 1).alias("rank"))


def packed(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    cut = staged(pieces(docs, vocabulary, capacity), "pieces")
    places = placements(plan({r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}, capacity))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for size in np.unique(lengths):
                at, rows = np.flatnonzero(lengths == size), places[int(size)]
                hit = np.searchsorted(rows[:, 0], ranks[at], "right") - 1
                sequence[at] = rows[hit, 1] + ranks[at] - rows[hit, 0]
                offset[at] = rows[hit, 2]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked(cut).mapInArrow(place, schema)
