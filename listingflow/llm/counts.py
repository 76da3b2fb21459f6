"""Token counts by distinct pre-token: a byte-level BPE counts every distinct pre-token once, whatever its frequency.

Blocks of documents are reduced to postings (pre-token -> document, frequency). Postings are dealt by pre-token, sorted,
and streamed: each distinct pre-token is counted once, its count times each frequency is added to the block's documents,
and partial sums per block are added up. A pre-token that most texts hold has a long posting in every block; long postings
are dealt by pre-token and block, so that no task reads all of them, and counted once in each such part. Partial sums
name only the documents they touch, so they never outgrow the postings. Token ids are never built.

Defined cases: a null or empty text has no token; a special token's string inside a text is that one token; repeated rows
and null ids are counted row by row; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import load_tokenizer, text_slices, tokenizer_path

#: White space as the vocabulary's own pattern engine has it, for use inside a class.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the pre-token pattern that byte-level BPE vocabularies of this kind are trained with.
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Cells (documents) of partial sums that a task holds before it passes them on.
HELD_CELLS = 2_000_000

#: Documents of one block in a posting from which it counts as long, and the parts that a pre-token's long postings make.
LONG, PARTS = 256, 256

#: A block's number ends in its number of documents; documents inside a block have 16-bit numbers.
SIZE_BITS = 16
POSTINGS = pa.schema([("token", pa.string()), ("block", pa.int64()), ("docs", pa.binary()), ("freqs", pa.binary())])
POSTINGS_SQL = "token string, block long, docs binary, freqs binary"
#: Blocks stand under this in place of a pre-token when a row lists their documents.
NO_TOKEN = "\x00documents of "


@lru_cache(maxsize=1)
def pre_token_pattern():
    import regex

    return regex.compile(PRE_TOKEN)


def special_pattern(tokenizer):
    import re

    words = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return re.compile("(" + "|".join(map(re.escape, sorted(words, key=len, reverse=True))) + ")") if words else None


def pre_tokens(text: str, special) -> list[str]:
    """The pre-tokens of one text, special strings among them."""
    find = pre_token_pattern().findall
    if special is None or not special.search(text):
        return find(text)
    out: list[str] = []
    for k, piece in enumerate(special.split(text)):
        out.extend([piece] if k % 2 else find(piece))
    return out


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of 16-bit numbers as one binary value per run."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * 2
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(values.astype("<u2").tobytes())])


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of :func:`_binary`: all numbers, and how many each row has."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, "<u2")[ends[0] // 2 : ends[-1] // 2] if data else np.zeros(0, "<u2")), np.diff(ends) // 2


def _postings(path: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        special, number = special_pattern(load_tokenizer(path)), 0
        task = TaskContext.get().partitionId()
        for part, texts in text_slices(batches, most_rows=(1 << SIZE_BITS) - 1):
            known: dict[str, int] = defaultdict(lambda: len(known))
            found = [np.fromiter(map(known.__getitem__, pre_tokens(text, special)), np.int64) for text in texts]
            block, number = (((task << 24) + number) << SIZE_BITS) + len(texts), number + 1
            # The block's documents travel as one more row, dealt by a key of its own.
            ids = part.column("doc_id").cast(pa.int64())
            listed = np.stack([ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), [len(t.encode()) for t in texts]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([f"{NO_TOKEN}{block}"]), pa.array([block]), pa.array([listed], pa.binary()), pa.array([b""], pa.binary())], schema=POSTINGS)
            if not known:
                continue
            cell = np.concatenate(found) * len(texts) + np.repeat(np.arange(len(texts)), [len(f) for f in found])
            cell, freq = np.unique(cell, return_counts=True)
            if freq.max() > 65535:  # too often for one posting: several
                times = -(-freq // 65535)
                last = np.cumsum(times) - 1
                cell, rest = np.repeat(cell, times), freq - (times - 1) * 65535
                freq = np.full(len(cell), 65535)
                freq[last] = rest
            token, doc = np.divmod(cell, len(texts))
            per_token = np.bincount(token, minlength=len(known))
            # Frequencies are left out where all of a token's are one.
            often = np.bincount(token, freq > 1, len(known)) > 0
            whole = pa.RecordBatch.from_arrays(
                [pa.array(list(known)), pa.array(np.full(len(known), block)), _binary(doc, per_token), _binary(freq[often[token]], per_token * often)], schema=POSTINGS
            )
            for at in range(0, whole.num_rows, 20_000):
                yield whole.slice(at, 20_000)

    return read


def _partial_sums(path: str):
    """Postings sorted by token -> (block, documents touched and their sums of pieces), and the documents of each block."""
    schema = pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("sums", pa.binary()), ("listed", pa.binary())])

    def flush(bases: dict[int, int], held: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts = [held[at : at + (block & ((1 << SIZE_BITS) - 1))] for block, at in bases.items()]
        touched = [np.flatnonzero(part) for part in parts]
        docs = [at.astype("<u2").tobytes() for at in touched]
        sums = [part[at].astype("<u4").tobytes() for part, at in zip(parts, touched, strict=True)]
        blocks = list(bases)
        for k in range(0, len(blocks), 512):
            some = slice(k, k + 512)
            yield pa.RecordBatch.from_arrays([pa.array(blocks[some], pa.int64()), pa.array(docs[some], pa.binary()), pa.array(sums[some], pa.binary()), pa.nulls(len(blocks[some]), pa.binary())], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        model, letters = tokenizer.model, byte_letters()
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        bases: dict[int, int] = {}
        held, cells, last, pieces = np.zeros(1 << 16, np.int64), 0, None, 0
        for batch in batches:
            tokens = batch.column("token")
            listed = pc.starts_with(tokens, NO_TOKEN).to_numpy(zero_copy_only=False)
            if listed.any():
                rows = batch.filter(pa.array(listed))
                yield pa.RecordBatch.from_arrays([rows.column("block"), pa.nulls(len(rows), pa.binary()), pa.nulls(len(rows), pa.binary()), rows.column("docs")], schema=schema)
                batch = batch.filter(pa.array(~listed))
                tokens = batch.column("token")
            if not batch.num_rows:
                continue
            # Count a token at the head of its run; rows of the run share the count.
            head = np.ones(len(tokens), bool)
            head[1:] = pc.not_equal(tokens.slice(1), tokens.slice(0, len(tokens) - 1)).to_numpy(zero_copy_only=False)
            counted = []
            for token in tokens.filter(pa.array(head)).to_pylist():
                if token != last:
                    last, pieces = token, 1 if token in special else len(model.tokenize(token.encode().decode("latin-1").translate(letters)))
                counted.append(pieces)
            blocks, of_block = np.unique(batch.column("block").to_numpy(), return_inverse=True)
            for block in blocks.tolist():
                if block not in bases:
                    bases[block], cells = cells, cells + (block & ((1 << SIZE_BITS) - 1))
            if cells > len(held):
                held = np.concatenate([held, np.zeros(max(cells, 2 * len(held)) - len(held), np.int64)])
            doc, n = _numbers(batch.column("docs"))
            given, has = _numbers(batch.column("freqs"))
            freq = np.ones(len(doc), np.int64)
            freq[np.repeat(has > 0, n)] = given
            base = np.array([bases[b] for b in blocks.tolist()], np.int64)[of_block]
            np.add.at(held, np.repeat(base, n) + doc, freq * np.repeat(np.array(counted, np.int64)[np.cumsum(head) - 1], n))
            if cells > HELD_CELLS:
                yield from flush(bases, held)
                bases, cells = {}, 0
                held[:] = 0
        yield from flush(bases, held)

    return read, "block long, docs binary, sums binary, listed binary"


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write every byte as a printable letter: printable Latin-1 stands for itself, the rest
    follow from U+0100 upwards in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one block stand together: add its partial sums and give its documents."""
    block, sums, listed = None, np.zeros(0, np.int64), None

    def done() -> pa.RecordBatch:
        ids, null, size = np.frombuffer(listed, "<i8").reshape(3, -1)
        return pa.RecordBatch.from_arrays([pa.array(ids, mask=null > 0), pa.array(size), pa.array(sums)], ["doc_id", "n_bytes", "n_tokens"])

    for batch in batches:
        for b, touched, added, documents in zip(*(batch.column(c).to_pylist() for c in ("block", "docs", "sums", "listed")), strict=True):
            if b != block:
                if listed is not None:
                    yield done()
                block, sums, listed = b, np.zeros(b & ((1 << SIZE_BITS) - 1), np.int64), None
            if documents is not None:
                listed = documents
            else:
                sums[np.frombuffer(touched, "<u2")] += np.frombuffer(added, "<u4")
    if listed is not None:
        yield done()


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row of ``docs``."""
    path = tokenizer_path(vocabulary)
    postings = docs.select("doc_id", "text").mapInArrow(_postings(path), POSTINGS_SQL)
    long = (F.octet_length("docs") >= 2 * LONG) & ~F.startswith("token", F.lit(NO_TOKEN))
    part = F.when(long, F.pmod(F.xxhash64("block"), F.lit(PARTS))).otherwise(F.lit(-1))
    dealt = postings.repartition("token", part).sortWithinPartitions("token").select(*POSTINGS.names)
    sums, schema = _partial_sums(path)
    by_block = dealt.mapInArrow(sums, schema).repartition("block").sortWithinPartitions("block")
    return by_block.mapInArrow(_whole, "doc_id long, n_bytes long, n_tokens long")
