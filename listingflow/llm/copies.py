"""Near copies by five-word shingles: wide SimHash fingerprints find candidates, exact Jaccard similarity decides.

Texts of equal shingle sets collapse first. Every distinct set has a fingerprint of 256 bits and ``KEYS`` keys, each made
of the smallest members of the set by ``KEY_MINIMA`` orders. Sets that share a key stand in one bucket, whose fingerprints are
compared bit-sliced: bit planes side by side, differing bits added by carry-save counters, a block abandoned once all its
pairs exceed ``RADIUS`` or are joined already. A key is shared by sets that share shingles, not by chance, so that the keys in
buckets grow with the near copies. Two sets of similarity 0.8 share no key with a chance of 0.0000006 and lie beyond the
radius with a chance of about 0.001.

Only candidates are read again. Of each group of linked fingerprints every set is compared with the group's first one on
whole shingle sets; those that reach the similarity are connected. The others are compared with all of their group, in
chunks, so that no group meets in one task; a task passes on only links that join what was apart. The work in a group of n
sets, m of them unlike the first, grows with n * (m + 1), not with n * n.

Defined cases: words are split at white space, A-Z lower-cased; texts without words are copies of each other; shorter texts
than a shingle are one shingle; the smallest id stays, a null id only where no id is there; of repeated rows one stays; an
empty table gives an empty result. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import staged, text_slices
from listingflow.llm.components import components
from listingflow.llm.simhash import BUCKET, SIDE_BY_SIDE, Forest, rows_of

SHINGLE, SIMILARITY = 5, 0.8
WORDS = 4
BITS, RADIUS = 64 * WORDS, 56
KEYS, KEY_MINIMA = 20, 3
#: Sets of one group that are compared side by side.
CHUNK = 512
_RNG = np.random.default_rng(5)
_SEEDS = _RNG.integers(0, 1 << 63, WORDS, np.uint64)
_ORDERS = _RNG.integers(0, 1 << 63, KEYS * KEY_MINIMA, np.uint64)
_PARTS = [f"f{k}" for k in range(WORDS)]


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    import xxhash

    words = text.encode().lower().split()
    n = max(1, len(words) - shingle + 1) if words else 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = (ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], 5) for a, b in zip(starts, stops)], np.uint64))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The bits of a shingle set's fingerprint: 1 where over half of its members have the bit."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255):  # sums of 255 bits fit a byte
        z = hashes[at : at + 255, None] + _SEEDS
        z = (z ^ (z >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        bits = np.unpackbits((z ^ (z >> np.uint64(32))).astype("<u8").view(np.uint8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return (counts * 2 > len(hashes)).astype(np.uint8)


def keys_of(hashes: np.ndarray) -> np.ndarray:
    """``KEYS`` numbers of a shingle set, each of its smallest members by ``KEY_MINIMA`` orders and of its own place."""
    least = np.full(len(_ORDERS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 255):
        z = (hashes[at : at + 255, None] ^ _ORDERS) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        least = np.minimum(least, z.min(axis=0))
    keys = np.arange(KEYS, dtype=np.uint64)
    for part in least.reshape(KEYS, KEY_MINIMA).T:
        keys = (keys ^ part) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(set, num, f0.., keys, doc_id, text_hash) of every row: ``set`` names its shingle set, ``num`` is a part of that name,
    f0.. are the words of its fingerprint."""
    import xxhash

    id_type = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            names, prints, keys = [], [], []
            for text in texts:
                hashes = shingles(text)
                names.append(xxhash.xxh128_hexdigest(hashes.astype("<u8").tobytes()))
                prints.append(np.packbits(wide_fingerprint(hashes), bitorder="little").view("<i8"))
                keys.append(keys_of(hashes))
            words = np.array(prints, np.int64).reshape(-1, WORDS)
            nums = np.array([int(n[:16], 16) for n in names], np.uint64).view(np.int64)
            columns = [pa.array(names, pa.string()), pa.array(nums), *(pa.array(words[:, k].copy()) for k in range(WORDS))]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * KEYS), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*columns, lists, part.column("doc_id"), part.column("text_hash")], ["set", "num", *_PARTS, "keys", "doc_id", "text_hash"])

    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    words = ", ".join(f"{f} long" for f in _PARTS)
    return keyed.mapInArrow(read, f"set string, num long, {words}, keys array<long>, doc_id {id_type}, text_hash long")


def _number(lanes: np.ndarray) -> int:
    return int.from_bytes(np.packbits(lanes, bitorder="little").tobytes(), "little")


def _above(counters: list[int], radius: int) -> int:
    """Lanes whose count, one counter per binary digit, is above ``radius``."""
    out, equal = 0, -1
    for digit in reversed(range(len(counters))):
        if radius >> digit & 1:
            equal &= counters[digit]
        else:
            out |= equal & counters[digit]
            equal &= ~counters[digit]
    return out


def near_links(nums: np.ndarray, words: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (u, v) between ``nums`` of one bucket whose fingerprints lie within ``radius`` bits, enough to join all that are
    connected; rows of one bucket stand together."""
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(bucket)]]))
    classes = np.ceil(np.log2(sizes)).astype(int)
    names, ids = np.unique(nums, return_inverse=True)
    forest = Forest(len(names))
    for size_class in np.unique(classes[sizes > 1]):
        chosen = np.flatnonzero((classes == size_class) & (sizes > 1))
        at = np.concatenate([np.arange(starts[c], starts[c] + sizes[c]) for c in chosen])
        left = np.concatenate([np.arange(sizes[c])[::-1] for c in chosen])  # rows of the bucket that follow
        bits = np.unpackbits(words[at].astype("<i8").view(np.uint8).reshape(len(at), -1), axis=1, bitorder="little")
        planes = [_number(bits[:, k]) for k in range(BITS)]
        for lag in range(1, int(sizes[chosen].max())):
            tree = forest.labels[ids[at]]
            # Pairs that other links have joined already need no comparison.
            active = _number((left[:-lag] >= lag) & (tree[:-lag] != tree[lag:]))
            counters, over = [0] * radius.bit_length(), 0
            for k, plane in enumerate(planes):
                if not active:
                    break
                carry = plane ^ (plane >> lag)
                for digit, counter in enumerate(counters):
                    counters[digit], carry = counter ^ carry, counter & carry
                over |= carry
                if k % 32 == 31:
                    active &= ~(over | _above(counters, radius))
            if active:
                hit = np.flatnonzero(np.unpackbits(np.frombuffer(active.to_bytes((len(at) + 7) // 8, "little"), np.uint8), bitorder="little"))
                u, v = at[hit], at[hit + lag]
                new = forest.join(ids[u], ids[v])
                if len(new):
                    yield nums[u[new]], nums[v[new]]


def alike(sets: list[np.ndarray], similarity: float = SIMILARITY) -> Iterator[tuple[int, int]]:
    """Links between positions of ``sets`` whose Jaccard similarity is reached, enough to join all that are connected."""
    sizes = np.array([len(s) for s in sets])
    dense = np.unique(np.concatenate(sets), return_inverse=True)[1] if len(sets) else np.zeros(0, np.int64)
    members = np.split(dense, np.cumsum(sizes)[:-1])
    marked = np.zeros(len(dense), bool)
    rest, queue, flat = np.arange(len(sets)), [], None
    while len(rest):
        if not queue:
            queue, rest, flat = [int(rest[0])], rest[1:], None
            continue
        one = queue.pop()
        if flat is None:
            flat, begins = np.concatenate([members[k] for k in rest]), np.concatenate([[0], np.cumsum(sizes[rest])])
        marked[members[one]] = True
        held = np.concatenate([[0], np.cumsum(marked[flat])])
        both = held[begins[1:]] - held[begins[:-1]]
        marked[members[one]] = False
        union = sizes[one] + sizes[rest] - both
        hit = both >= similarity * union - 1e-9
        if hit.any():
            found = rest[hit].tolist()
            yield from ((one, k) for k in found)
            queue += found
            rest, flat = rest[~hit], None


def print_links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(u, v): links between the sets of ``prints`` (num, f0.., keys, distinct) that share a key and whose fingerprints are near."""
    keys = prints.select("num", F.explode("keys").alias("key"))
    counted = keys.groupBy("key").agg(F.count("*").alias("n"))
    shared = staged(counted.where("n > 1").select("key", F.ceil(F.col("n") / bucket).cast("int").alias("chunks")), "shared-keys")
    # Crowded buckets are divided, and every pair of their parts is compared.
    chunk = F.pmod(F.xxhash64("num", "key"), F.col("chunks")).cast("int")
    dealt = (
        keys.join(shared, "key")
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("num", "key", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"))
        .join(prints.drop("keys"), "num")
    )
    cell = ["key", "a", "b"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            number = np.concatenate([[0], np.cumsum((rows[1:, :3] != rows[:-1, :3]).any(1))])
            for u, v in near_links(rows[:, 3], rows[:, 4:], number):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        columns = [*cell, "num", *_PARTS]
        held = np.zeros((0, len(columns)), np.int64)
        for batch in batches:
            held = np.vstack([held, np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in columns])])
            while len(held) > SIDE_BY_SIDE:
                changes = np.flatnonzero((held[1:, :3] != held[:-1, :3]).any(1)) + 1
                whole = changes[changes <= SIDE_BY_SIDE]
                end = whole[-1] if len(whole) else changes[0] if len(changes) else None
                if end is None:
                    break
                yield from linked(held[:end])
                held = held[end:]
        if len(held):
            yield from linked(held)

    return dealt.repartition(*cell).sortWithinPartitions(*cell, "num").mapInArrow(read, "u long, v long")


def candidates(sets: DataFrame) -> DataFrame:
    """(num, component, chunks) of sets whose fingerprints are near to another's; a component is named by its smallest ``num``."""
    prints = staged(sets.select("num", *_PARTS, "keys").distinct(), "prints")
    found = staged(components(print_links(prints)).select(F.col("node").alias("num"), "component"), "candidates")
    sizes = staged(found.groupBy("component").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "candidate-sizes")
    return found.join(sizes, "component").select("num", "component", "chunks")


def copy_links(docs: DataFrame, sets: DataFrame, chosen: DataFrame) -> DataFrame:
    """(u, v): links between sets of ``chosen`` whose similarity is reached. ``sets`` has set, num, first."""
    wanted = sets.join(chosen, "num").select("set", "num", "component", "chunks", F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash"))
    texts = rows_of(docs.select("doc_id", "text"), wanted).select("set", "num", "component", "chunks", "text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in text_slices(batches):
            hashes = [shingles(t).view(np.int64) for t in found]
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(h) for h in hashes])]).astype(np.int32)), pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64))
            )
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names[:-1]), lists], names)

    names = ["set", "num", "component", "chunks", "hashes"]
    held = staged(texts.mapInArrow(whole, "set string, num long, component long, chunks int, hashes array<long>"), "shingles")
    # A group meets its first set in as many places as it has chunks.
    place = F.pmod(F.xxhash64("set"), F.col("chunks")).cast("int")
    heads = held.where("num = component").select(
        "component", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("place"), F.col("set").alias("head"), F.col("hashes").alias("head_hashes")
    )
    both = F.size(F.array_intersect("hashes", "head_hashes"))
    settled = (F.col("set") == F.col("head")) | (both >= SIMILARITY * (F.size("hashes") + F.size("head_hashes") - both) - 1e-9)
    judged = staged(held.withColumn("place", place).join(heads, ["component", "place"]).select("set", "component", "head", settled.alias("settled")), "settled")
    rest = F.ceil(F.count_if(~F.col("settled")) / CHUNK).cast("int")
    sizes = judged.groupBy("component").agg(rest.alias("rest"), F.ceil(F.count_if("settled") / CHUNK).cast("int").alias("done")).where("rest > 0")
    # Parts 0 to rest - 1 hold what is not settled and meet every part; settled parts need not meet each other.
    open_sets = held.join(judged.join(sizes, "component").select("set", "settled", "rest", "done"), "set")
    own, count = F.xxhash64("set"), F.col("rest") + F.col("done")
    dealt = (
        open_sets.withColumn("part", F.when(F.col("settled"), F.col("rest") + F.pmod(own, F.col("done"))).otherwise(F.pmod(own, F.col("rest"))).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("settled"), F.col("rest")).otherwise(count) - 1)))
        .select("set", "component", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "hashes")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(rows: list[tuple[str, np.ndarray]]) -> pa.RecordBatch:
            pairs = [(rows[i][0], rows[j][0]) for i, j in alike([h for _, h in rows])]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["u", "v"])

        cell, rows = None, []
        for batch in batches:
            at = list(zip(*(batch.column(c).to_pylist() for c in ("component", "a", "b"))))
            lists = batch.column("hashes")
            begins, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k, (key, name) in enumerate(zip(at, batch.column("set").to_pylist())):
                if key != cell and rows:
                    yield linked(rows)
                    rows = []
                cell = key
                rows.append((name, flat[begins[k] : begins[k + 1]].copy()))
        if rows:
            yield linked(rows)

    cells = ["component", "a", "b"]
    found = dealt.repartition(*cells).sortWithinPartitions(*cells).mapInArrow(compared, "u string, v string")
    return judged.where("settled and set <> head").select(F.col("set").alias("u"), F.col("head").alias("v")).unionByName(found)


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per group of near copies, all columns: the smallest id, of repeated rows one."""
    of_rows = staged(shingle_sets(docs), "shingle-sets")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    firsts = staged(of_rows.groupBy("set", "num").agg(first), "set-names")
    chosen = staged(candidates(of_rows), "chosen")
    linked = components(copy_links(docs, firsts, chosen)).select(F.col("node").alias("set"), "component")
    groups = firsts.join(linked, "set", "left").select(F.coalesce("component", "set").alias("component"), "first")
    kept = groups.groupBy("component").agg(F.min("first").alias("first"))
    return rows_of(docs, kept.select(F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash")))
