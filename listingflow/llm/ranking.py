"""Ranked lexical search with bit-sliced Bloom signatures.

The index is built from all documents and knows no query. Documents of like size stand side by side in blocks; a block has
one bitmap over its documents per bit of their signatures. A document's signature holds each of its terms, and once more
for every power of two that the term's occurrences reach, so it tells how often a term can stand there: the bitmaps of a
term, ANDed, name every document that has it (and a few that have not). Weighted sums of those bitmaps bound what a
document can score.

The documents with the highest bounds are scored exactly, which gives every item the score it takes to be among its best;
every other document whose bound reaches that score is then scored exactly on its whole text, and only the rest, which
cannot get there, is left out. The number of documents scored has no limit.

Corpus counts (documents, terms, documents per term) cover all documents. Items are asked in chunks of about ``TERMS``
terms, so what a task is given does not grow with their number; two passes over the index serve a chunk. The filter of
terms that goes to every task is a bitmap of a fixed size: it only spares work, what passes is joined exactly.

Defined cases: a null or empty text has no term, and such a document is in no result; an item without terms, or with none
that any document has, has no row; every row of a repeated item is an item and every repeated document a document; null
ids come after all others among equal scores; empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listingflow.llm.common import staged, text_slices

#: Bits of a signature per entry, bitmaps per entry, the widest signature, and powers of two of occurrences told apart.
BITS, HASHES, WIDEST, LEVELS = 12, 3, 1 << 20, 6
#: Terms of the items that are asked together; documents whose bounds are added up at once.
TERMS, STRIP = 20_000, 256
#: Bytes of text whose postings a task holds at once.
SLICE = 4 << 20
#: Bits of the filter that goes to every task.
FILTER = 1 << 20
_MIX = np.random.default_rng(12).integers(0, 1 << 63, LEVELS, np.uint64) * np.uint64(2) + np.uint64(1)
#: Letters, digits and everything beyond ASCII stand for themselves (A-Z in lower case), the rest parts terms.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_LETTERS).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def places(hashes: np.ndarray, level: int, width: int) -> list[np.ndarray]:
    """The bits of an entry in a signature of ``width`` bits."""
    mixed = hashes * _MIX[level]
    return [((mixed >> np.uint64(21 * k)) & np.uint64(width - 1)).astype(np.int64) for k in range(HASHES)]


# ---- a filter of a fixed size --------------------------------------------------------------------


def filter_words(hashed: DataFrame) -> dict[int, int]:
    """The words of a bitmap with two bits per value of the column ``h``: at most ``FILTER / 64`` of them."""
    bits = F.explode(F.array(F.col("h").bitwiseAND(F.lit(FILTER - 1)), F.shiftrightunsigned("h", 40).bitwiseAND(F.lit(FILTER - 1))))
    words = hashed.select(bits.alias("b")).groupBy(F.shiftright("b", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits"))
    return {r["word"]: r["bits"] & ((1 << 64) - 1) for r in words.collect()}


def filter_bits(words: dict[int, int]) -> np.ndarray:
    whole = np.zeros(FILTER // 64, np.uint64)
    whole[list(words)] = np.array(list(words.values()), np.uint64)
    return np.unpackbits(whole.astype("<u8").view(np.uint8), bitorder="little").view(bool)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes.view(np.uint64)
    return bits[(h & np.uint64(FILTER - 1)).astype(np.int64)] & bits[((h >> np.uint64(40)) & np.uint64(FILTER - 1)).astype(np.int64)]


# ---- the index -----------------------------------------------------------------------------------


def _blocks(counts: np.ndarray, term: np.ndarray, doc: np.ndarray, hashes: np.ndarray, n_docs: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(width, documents, bitmaps) of the signatures of one slice; ``term``, ``doc`` and ``counts`` describe its postings."""
    levels = np.minimum(np.log2(counts).astype(np.int64), LEVELS - 1)
    entries = np.bincount(doc, levels + 1, n_docs)
    widths = np.clip(1 << np.ceil(np.log2(np.maximum(entries, 1) * BITS)).astype(np.int64), 64, WIDEST)
    for width in np.unique(widths[entries > 0]):
        chosen = np.flatnonzero((widths == width) & (entries > 0))
        column = np.full(n_docs, -1)
        column[chosen] = np.arange(len(chosen))
        mine = column[doc] >= 0
        bitmap = np.zeros((width, len(chosen)), bool)
        for level in range(LEVELS):
            here = mine & (levels >= level)
            for at in places(hashes[term[here]], level, int(width)):
                bitmap[at, column[doc[here]]] = True
        yield int(width), chosen, np.packbits(bitmap, axis=1).tobytes()


def index(docs: DataFrame, wanted: dict[int, int]) -> DataFrame:
    """Rows of two kinds. Blocks: width, bitmaps, and per document ids, hashes (of the text), sizes (terms) and most (the
    most occurrences of a term). Counts (``term``, ``docs``): documents of a slice that hold a term which ``wanted`` lets pass."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"width int, bitmaps binary, ids array<{id_type}>, hashes array<long>, sizes array<long>, most array<long>, term binary, docs long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_bits(wanted)
        for part, texts in text_slices(batches, SLICE, 1 << 16):
            known: dict[bytes, int] = {}
            found = []
            for text in texts:
                words = terms(text)
                for word in set(words).difference(known):
                    known[word] = len(known)
                found.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
            if not known:
                continue
            sizes = np.array([len(f) for f in found])
            cell, counts = np.unique(np.concatenate(found).astype(np.int64) * len(texts) + np.repeat(np.arange(len(texts)), sizes), return_counts=True)
            term, doc = np.divmod(cell, len(texts))
            words = list(known)
            hashes = hashes_of(words)
            most = np.zeros(len(texts), np.int64)
            np.maximum.at(most, doc, counts)
            columns = part.column("doc_id"), part.column("text_hash")
            for width, chosen, bitmaps in _blocks(counts, term, doc, hashes, len(texts)):
                lists = [pa.ListArray.from_arrays(pa.array([0, len(chosen)], pa.int32()), c.take(pa.array(chosen))) for c in columns]
                numbers = [pa.array([a[chosen].tolist()], pa.list_(pa.int64())) for a in (sizes, most)]
                yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([bitmaps], pa.binary()), *lists, *numbers, pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())], names)
            asked = np.flatnonzero(passes(bits, hashes))
            held = np.bincount(term, minlength=len(known))[asked]
            empty = [pa.nulls(len(asked), t) for t in (pa.int32(), pa.binary(), *[c.type for c in lists], *[pa.list_(pa.int64())] * 2)]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([words[k] for k in asked], pa.binary()), pa.array(held, pa.int64())], names)

    names = ["width", "bitmaps", "ids", "hashes", "sizes", "most", "term", "docs"]
    return docs.mapInArrow(read, schema)


# ---- bounds and scores ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Corpus:
    documents: int
    terms: int

    def weight(self, held: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * held + 1)))

    def length(self, size: int) -> int:
        return 100 - 50 + (50 * size * self.documents) // self.terms


@dataclass(frozen=True)
class Questions:
    """Items of one chunk: numbers, and per item its terms that documents hold, with weights."""

    items: list[int]
    terms: list[list[tuple[bytes, int]]]

    def scores(self, text: str, wanted: list[int], corpus: Corpus) -> list[tuple[int, int]]:
        """Exact scores above 0 of one document for the items at positions ``wanted``."""
        words = terms(text)
        found, out = Counter(words), []
        norm = 20 * corpus.length(len(words))
        for k in wanted:
            score = sum(w * ((1_000_000_000 * found[t]) // (1000 * found[t] + norm)) for t, w in self.terms[k] if t in found)
            if score > 0:
                out.append((self.items[k], score))
        return out


class Bounds:
    """Upper bounds of the scores of a block's documents, strip by strip."""

    def __init__(self, asked: Questions, corpus: Corpus):
        self.corpus = corpus
        words = sorted({t for listed in asked.terms for t, _ in listed})
        number = {t: k for k, t in enumerate(words)}
        self.hashes = hashes_of(words)
        self.at = np.array([number[t] for listed in asked.terms for t, _ in listed], np.int64)
        self.weights = np.array([w for listed in asked.terms for _, w in listed], np.int64)
        self.begins = np.cumsum([0, *[len(listed) for listed in asked.terms]])[:-1]

    def of(self, width: int, bitmaps: bytes, sizes: list[int], most: list[int]) -> Iterator[tuple[int, np.ndarray]]:
        """(first document, bounds[item, document]) of each strip."""
        slices = np.frombuffer(bitmaps, np.uint8).reshape(width, -1)
        norm = 20 * np.array([self.corpus.length(n) for n in sizes], np.int64)
        most = np.array(most, np.int64)
        for first in range(0, len(sizes), STRIP):
            strip = slices[:, first // 8 : (first + STRIP) // 8]
            here = slice(first, first + STRIP)
            bound, below = 0, np.zeros(len(norm[here]), np.int64)
            for level in range(LEVELS):
                a, *rest = places(self.hashes, level, width)
                present = strip[a]
                for b in rest:
                    present &= strip[b]
                held = np.flatnonzero(present.any(1))
                if not len(held):
                    break
                times = np.minimum((2 << level) - 1, most[here]) if level < LEVELS - 1 else most[here]
                value = (1_000_000_000 * times) // (1000 * times + norm[here])
                bound = bound + self._sums(present, held)[:, : len(value)] * (value - below)
                below = value
            yield first, bound if isinstance(bound, np.ndarray) else np.zeros((len(self.begins), len(norm[here])), np.int64)

    def _sums(self, present: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Weighted sums of the terms' bitmaps per item and document."""
        row = np.full(len(present), -1)
        row[held] = np.arange(len(held))
        mine = np.flatnonzero(row[self.at] >= 0)
        bits = np.unpackbits(present[held], axis=1)
        item = np.searchsorted(self.begins, mine, side="right") - 1
        heads = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
        out = np.zeros((len(self.begins), bits.shape[1]), np.int64)
        if len(heads):
            out[item[heads]] = np.add.reduceat(bits[row[self.at[mine]]] * self.weights[mine, None], heads, axis=0)
        return out


_BLOCK = ["width", "bitmaps", "ids", "hashes", "sizes", "most"]


def _candidates(blocks: DataFrame, asked: Questions, corpus: Corpus, id_type: str, k: int, reach: dict[int, int] | None) -> DataFrame:
    """(doc_id, text_hash, item position, bound): with ``reach``, every document whose bound gets there; without, the k
    highest bounds above 0 of each task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(asked, corpus)
        least = np.array([max(1, reach.get(i, 1)) for i in asked.items], np.int64)[:, None] if reach is not None else None
        best, where = np.zeros((len(asked.items), k), np.int64), np.zeros((len(asked.items), k), np.int64)
        ids, hashes, base = [], [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                width, bitmaps, sizes, most = (batch.column(c)[row].as_py() for c in ("width", "bitmaps", "sizes", "most"))
                own = [batch.column(c)[row].values for c in ("ids", "hashes")]
                for first, bound in bounds.of(width, bitmaps, sizes, most):
                    if least is not None:
                        item, doc = np.nonzero(bound >= least)
                        at = pa.array(doc + first)
                        yield pa.RecordBatch.from_arrays([own[0].take(at), own[1].take(at), pa.array(item.astype(np.int32)), pa.array(bound[item, doc])], names)
                        continue
                    both = np.concatenate([best, bound], axis=1)
                    places_ = np.concatenate([where, np.broadcast_to(np.arange(bound.shape[1]) + base + first, bound.shape)], axis=1)
                    top = np.argpartition(both, both.shape[1] - k, axis=1)[:, -k:]
                    best, where = np.take_along_axis(both, top, 1), np.take_along_axis(places_, top, 1)
                if least is None:
                    ids.append(own[0])
                    hashes.append(own[1])
                    base += len(sizes)
        if least is None and base:
            item, at = np.nonzero(best)
            chosen = pa.array(where[item, at])
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(ids).take(chosen), pa.concat_arrays(hashes).take(chosen), pa.array(item.astype(np.int32)), pa.array(best[item, at])], names)

    names = ["doc_id", "text_hash", "item", "bound"]
    return blocks.mapInArrow(read, f"doc_id {id_type}, text_hash long, item int, bound long")


def _score_rows(part: pa.RecordBatch, texts: list[str], wanted: list[list[int] | None], asked: Questions, corpus: Corpus) -> pa.RecordBatch:
    out = [(n, *s) for n, (text, items) in enumerate(zip(texts, wanted)) if items for s in asked.scores(text, items, corpus)]
    row, item, score = zip(*out) if out else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(score, pa.int64())], ["item", "doc_id", "score"])


def _likely_scores(docs: DataFrame, likely: DataFrame, asked: Questions, corpus: Corpus) -> DataFrame:
    """(item, doc_id, score) of the documents with the highest bounds: ``k`` per item of the chunk, few enough to be named
    to every task, by their texts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    wanted: dict[int, list[int]] = {}
    for r in likely.select("text_hash", "item").distinct().collect():
        wanted.setdefault(r["text_hash"], []).append(r["item"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(list(wanted), pa.int64())
        for batch in batches:
            for part, texts in text_slices([batch.filter(pc.is_in(batch.column("text_hash"), names))]):
                yield _score_rows(part, texts, [wanted[h] for h in part.column("text_hash").to_pylist()], asked, corpus)

    return docs.mapInArrow(read, f"item long, doc_id {id_type}, score long")


def _scored(docs: DataFrame, chosen: DataFrame, asked: Questions, corpus: Corpus) -> DataFrame:
    """(item, doc_id, score) of any number of candidates, read from whole texts."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # A document is asked for at most all items of the chunk.
    keyed = staged(chosen.groupBy("doc_id", "text_hash").agg(F.collect_set("item").alias("asked")), "ranking-keys").alias("k")
    met = docs.alias("d").join(keyed, (F.col("d.text_hash") == F.col("k.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            yield _score_rows(part, texts, part.column("asked").to_pylist(), asked, corpus)

    return met.select("d.doc_id", "d.text", "k.asked").mapInArrow(read, f"item long, doc_id {id_type}, score long")


def _highest(scored: DataFrame, k: int) -> DataFrame:
    by = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _chunk(docs: DataFrame, blocks: DataFrame, counts: DataFrame, mine: DataFrame, corpus: Corpus, k: int) -> DataFrame:
    """(item, rank, doc_id, score) of a chunk of items."""
    asking = mine.collect()
    vocabulary = mine.select(F.explode("terms").alias("term")).distinct()
    held = counts.join(vocabulary, "term", "left_semi").groupBy("term").agg(F.sum("docs").alias("n")).collect()
    weight = {bytes(r["term"]): corpus.weight(r["n"]) for r in held}
    listed = [(r["item"], [(bytes(t), weight[bytes(t)]) for t in r["terms"] if weight.get(bytes(t))]) for r in asking]
    asked = Questions(*map(list, zip(*[x for x in listed if x[1]]))) if any(x[1] for x in listed) else None
    id_type = docs.schema["doc_id"].dataType.simpleString()
    if asked is None:
        return docs.sparkSession.createDataFrame([], f"item long, rank int, doc_id {id_type}, score long")
    likely = _candidates(blocks, asked, corpus, id_type, k, None)
    by = W.partitionBy("item").orderBy(F.desc("bound"), "text_hash")
    likely = likely.withColumn("n", F.row_number().over(by)).where(F.col("n") <= k).drop("n")
    known = _highest(_likely_scores(docs, likely, asked, corpus), k)
    reach = {r["item"]: r["score"] for r in known.where(F.col("rank") == k).select("item", "score").collect()}
    able = _candidates(blocks, asked, corpus, id_type, k, reach)
    return _highest(staged(_scored(docs, able, asked, corpus), "ranking-scores"), k).select("item", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest-scoring documents of every row of ``items``."""
    id_types = docs.schema["doc_id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = [list(dict.fromkeys(terms(t))) for t in texts]
            flat = hashes_of([t for f in found for t in f]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(found, pa.list_(pa.binary())), lists], ["item_id", "terms", "hashes"])

    read_items = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).mapInArrow(read, f"item_id {id_types[1]}, terms array<binary>, hashes array<long>")
    asking = staged(read_items.select(F.monotonically_increasing_id().alias("item"), "item_id", "terms", "hashes"), "ranking-items")
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    indexed = staged(index(texts, filter_words(asking.select(F.explode("hashes").alias("h")))), "ranking-index")
    blocks, counts = indexed.where("width is not null").select(*_BLOCK), indexed.where("term is not null").select("term", "docs")
    total = blocks.agg(
        F.coalesce(F.sum(F.size("sizes")), F.lit(0)), F.coalesce(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)), F.lit(0))
    ).first()
    corpus = Corpus(total[0], total[1])
    chunks = math.ceil((asking.agg(F.sum(F.size("terms"))).first()[0] or 0) / TERMS)
    out = docs.sparkSession.createDataFrame([], f"item long, rank int, doc_id {id_types[0]}, score long")
    for chunk in range(chunks if corpus.terms else 0):
        mine = asking.where(F.pmod(F.xxhash64("item"), F.lit(chunks)) == chunk).select("item", "terms")
        out = out.unionByName(_chunk(texts, blocks, counts, mine, corpus, k))
    return out.join(asking.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
