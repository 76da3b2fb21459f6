"""Line deduplication over a range-partitioned, sorted table of line hashes.

Every long enough line becomes (hash of its key, document, position). The table is range-partitioned by hash and
document, so a line shared by a third of all documents spreads over several partitions, and sorted with the largest
document first. A task streams its partition: the first document of a run keeps its lines, and from the third document
on all others lose theirs. Runs that touch a partition's edge may go on in the next one; of those only the undecided
rows (lines of two documents at most) and a document count come out, and are settled by key. The result per document is
a compressed bitmap of the lines that stay, never text.

Defined cases: a null or empty text is one empty line; a null id is one document, smaller than any other; repeated rows
of one document count as one document and get the same bitmap; keys shorter than ``least`` code points always stay; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import staged, text_slices, unused

LINES = "h1 long, h2 long, doc long, text_hash long, pos int"
NO_ID = -(1 << 63)


def _document_key() -> list[Column]:
    """Decisions depend on a document's id and text alone; a row is found again by both."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]


def line_hashes(docs: DataFrame, least: int) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for part, texts in text_slices(batches):
            hashes, at, row = [], [], []
            for k, text in enumerate(texts):
                before = len(hashes)
                for pos, line in enumerate(text.encode().split(b"\n")):
                    key = line.strip()
                    if len(key) >= least and (key.isascii() or len(key.decode()) >= least):
                        hashes.append(digest(key.lower()))
                        at.append(pos)
                row.append(len(hashes) - before)
            both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            doc, text_hash = (np.repeat(part.column(c).to_numpy(), row) for c in ("doc", "text_hash"))
            whole = pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1])), pa.array(doc), pa.array(text_hash), pa.array(at, pa.int32())], ["h1", "h2", "doc", "text_hash", "pos"])
            for k in range(0, whole.num_rows, 50_000):
                yield whole.slice(k, 50_000)

    return docs.select(*_document_key(), "text").mapInArrow(read, LINES)


def _streamed(shared: int):
    """Sorted lines -> rows that lose (``docs`` null) and undecided rows at the partition's edges (``docs``: documents of
    the run inside this partition on its first row, else 0)."""
    names = ["h1", "h2", "doc", "text_hash", "pos"]

    def cut(rows: np.ndarray, docs) -> pa.RecordBatch:
        columns = [pa.array(rows[:, k]) for k in range(4)] + [pa.array(rows[:, 4].astype(np.int32))]
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(rows), pa.int64()) if docs is None else pa.array(docs, pa.int64())], [*names, "docs"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the run at hand: rows of its first documents (until there are enough), documents seen, is it the first run.
        held, seen, first = np.zeros((0, 5), np.int64), 0, True
        last_doc = None

        def settle(edge: bool):
            if edge and seen:
                keep = held if seen < shared else held[held[:, 2] == held[0, 2]]
                yield cut(keep, [seen] + [0] * (len(keep) - 1))

        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
            if not len(rows):
                continue
            new_run = np.ones(len(rows), bool)
            new_run[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
            new_run[0] = not seen or bool((rows[0, :2] != held[0, :2]).any())
            new_doc = new_run.copy()
            new_doc[1:] |= rows[1:, 2] != rows[:-1, 2]
            new_doc[0] |= rows[0, 2] != last_doc
            starts = np.flatnonzero(new_run)
            bounds = [(0, int(starts[0]) if len(starts) else len(rows), False)] if not new_run[0] else []
            # Whole runs inside the batch, vectorised: neither its first piece nor its last run.
            if len(starts) > 1:
                inner = slice(starts[0], starts[-1])
                run = np.cumsum(new_run[inner]) - 1
                rank = np.cumsum(new_doc[inner])
                rank = rank - rank[starts[:-1] - starts[0]][run]
                most = np.maximum.reduceat(rank, starts[:-1] - starts[0]) + 1
            for begin, end, _ in bounds:
                piece, fresh = rows[begin:end], new_doc[begin:end]
                order = seen + np.cumsum(fresh)
                was, seen = seen, int(order[-1])
                if was >= shared:
                    yield cut(piece[order > 1], None) if (order > 1).any() else cut(piece[:0], None)
                elif seen >= shared:
                    joined = np.vstack([held, piece])
                    yield cut(joined[joined[:, 2] != joined[0, 2]], None)
                    held = joined[joined[:, 2] == joined[0, 2]]
                else:
                    held = np.vstack([held, piece])
            if len(starts):
                yield from settle(first)
                if seen:
                    first = False
                if len(starts) > 1:
                    lose = (most[run] >= shared) & (rank > 0)
                    if first:  # the partition's very first run is inside this batch
                        edge = run == 0
                        docs_of = int(most[0])
                        body = rows[inner]
                        keep = body[edge & (rank == 0)] if docs_of >= shared else body[edge]
                        yield cut(keep, [docs_of] + [0] * (len(keep) - 1))
                        first = False
                    if lose.any():
                        yield cut(rows[inner][lose], None)
                begin = starts[-1]
                piece, fresh = rows[begin:], new_doc[begin:]
                order = np.cumsum(fresh)
                seen = int(order[-1])
                if seen >= shared:
                    yield cut(piece[order > 1], None)
                    held = piece[order == 1]
                else:
                    held = piece
            last_doc = rows[-1, 2]
        yield from settle(True)

    return read


def losing_lines(docs: DataFrame, least: int = 20, shared: int = 3) -> DataFrame:
    """(doc, text_hash, pos) of every line that goes."""
    lines = staged(line_hashes(docs, least), "lines")
    ordered = lines.repartitionByRange("h1", "h2", F.desc("doc")).sortWithinPartitions("h1", "h2", F.desc("doc"), "text_hash", "pos")
    found = staged(ordered.mapInArrow(_streamed(shared), LINES + ", docs long"), "line-runs")
    edges = found.where("docs is not null")
    totals = edges.groupBy("h1", "h2").agg(F.sum("docs").alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= shared)
    late = edges.join(totals, ["h1", "h2"]).where("doc <> keeper")
    return found.where("docs is null").select("doc", "text_hash", "pos").unionByName(late.select("doc", "text_hash", "pos"))


def keep_bitmaps(docs: DataFrame, least: int = 20, shared: int = 3) -> DataFrame:
    """(doc, text_hash, keep): bit i of the zlib-compressed bitmap tells whether line i stays. Lines beyond the bitmap
    stay; documents that lose nothing have no row."""
    gathered = losing_lines(docs, least, shared).groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("lost"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for lost in batch.column("lost").to_pylist():
                bits = np.ones((max(lost) // 8 + 1) * 8, bool)
                bits[lost] = False
                maps.append(zlib.compress(np.packbits(bits).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text_hash"), pa.array(maps, pa.binary())], ["doc", "text_hash", "keep"])

    return gathered.mapInArrow(packed, "doc long, text_hash long, keep binary")


def kept_lines(text: str, bitmap: bytes | None) -> tuple[list[str], int]:
    """The lines that stay and how many there were."""
    lines = text.split("\n")
    if bitmap is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[: len(lines)]
    gone = set(np.flatnonzero(bits == 0).tolist())
    return [line for k, line in enumerate(lines) if k not in gone], len(lines)


def with_bitmaps(docs: DataFrame, least: int = 20, shared: int = 3) -> DataFrame:
    """``docs`` and, as its last column, the bitmap of each row (null where every line stays)."""
    names = [unused(docs, name) for name in ("llm_doc", "llm_hash", "llm_keep")]
    maps = keep_bitmaps(docs, least, shared).select(*[F.col(c).alias(name) for c, name in zip(("doc", "text_hash", "keep"), names, strict=True)])
    doc, text_hash = _document_key()
    return docs.join(maps, (doc == F.col(names[0])) & (text_hash == F.col(names[1])), "left").drop(*names[:2])


def line_report(docs: DataFrame, least: int = 20, shared: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for every row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            n, dropped, digest = [], [], []
            for text, bitmap in zip(texts, part.column(2).to_pylist(), strict=True):
                lines, count = kept_lines(text, bitmap)
                n.append(count)
                dropped.append(count - len(lines))
                digest.append(hashlib.sha256("\n".join(lines).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digest)], ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return with_bitmaps(docs.select("doc_id", "text"), least, shared).mapInArrow(read, f"doc_id {id_type}, n_lines long, n_dropped long, kept_sha256 string")


def deduplicated(docs: DataFrame, least: int = 20, shared: int = 3) -> DataFrame:
    """``docs`` with the losing lines taken out of ``text``; every row and column stays."""
    marked = with_bitmaps(docs, least, shared)
    position = marked.columns.index("text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            nulls, maps = part.column(position).is_null().to_pylist(), part.column(part.num_columns - 1).to_pylist()
            new = [None if null else text if bitmap is None else "\n".join(kept_lines(text, bitmap)[0]) for text, bitmap, null in zip(texts, maps, nulls, strict=True)]
            columns = [pa.array(new, pa.string()) if k == position else part.column(k) for k in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, part.schema.names[:-1])

    return marked.mapInArrow(read, docs.schema)
