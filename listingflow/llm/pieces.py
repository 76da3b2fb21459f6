"""SentencePiece encoding and decoding of merge-type (BPE) models, exact and without replaying the merges of a text.

A sequence of pieces is what merging yields exactly if every two neighbours are: merging the characters of both gives the
same two again. So a text is walked from the left: an Aho-Corasick automaton of all pieces finds the longest one at a
position, it or the longest of its shorter beginnings that goes with the piece before is taken, and where none goes on, the position is marked as
failed in a bitfield and the piece that led there gives way to a shorter one. The pieces that reach a position are the
merges of the text before it and so are unique: a failed position fails for good and none is entered twice. Ties between
equal scores go to the left, in two pieces as in a whole text. What two pieces merge to is kept in a bounded memo.

No piece has a space after another character, so spaces cut a text into words that never merge with each other; inside a
word so does every pair of neighbours that stands in no piece (a letter and a full stop). Words and what lies between such
cuts repeat, so each task keeps their ids and decoded bytes in bounded memos. Characters that are no piece become byte pieces.

Defined cases: a null or empty text has the begin and end ids alone and decodes to the empty text; names of control and
byte pieces inside a text are plain text; repeated rows and null ids are rows like any other; an empty table gives an
empty result. Other columns are ignored. The model must have no normalisation but the space mark and a leading space.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from listingflow.llm.common import text_slices, tokenizer_path

#: Fixed value: the mark that stands for a space in pieces, and what an unknown id decodes to.
SPACE_MARK, UNKNOWN_TEXT = "▁", " ⁇ "
#: Entries of each memo before it is emptied.
MEMO = 400_000
#: Characters that are looked through for longest matches at once.
WINDOW = 256
#: Below every score.
NEVER = float("-inf")

_WORDS = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*").findall


class Pieces:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.vocab_size())
        self.texts = [model.id_to_piece(i) for i in every]
        self.control = {i for i in every if model.is_control(i)}
        self.unknown = {i for i in every if model.is_unknown(i)}
        self.byte = {i: int(self.texts[i][3:5], 16) for i in every if model.is_byte(i)}
        self.byte_ids = [i for i, _ in sorted(self.byte.items(), key=lambda x: x[1])]
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.ids = {self.texts[i]: i for i in every if i not in self.byte and i not in self.control and i not in self.unknown}
        self.score = {text: model.get_score(i) for text, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.matches = ahocorasick.Automaton()
        for text in self.ids:
            self.matches.add_word(text, text)
        self.matches.make_automaton()
        #: The next shorter piece, or character, that a piece begins with.
        self.shorter = {text: next((text[:k] for k in range(len(text) - 1, 1, -1) if text[:k] in self.ids), text[0]) for text in self.ids if len(text) > 1}
        self.raw = [bytes([self.byte[i]]) if i in self.byte else b"" if i in self.control else (UNKNOWN_TEXT if i in self.unknown else self.texts[i].replace(SPACE_MARK, " ")).encode() for i in every]
        self.joined = {pair for text in self.ids for pair in zip(text, text[1:])}
        if any(SPACE_MARK in text.lstrip(SPACE_MARK) for text in self.ids):
            raise ValueError("a piece holds a space after another character")
        self._fits: dict[tuple[str, str], bool] = {}
        self._stretches: dict[str, tuple[bytes, bytes]] = {}
        self._words: dict[str, tuple[bytes, bytes]] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces that merging makes of a short text: the best-scored neighbours first, the leftmost among equals."""
        parts, score = list(text), self.score.get
        scores = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == NEVER:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def fits(self, before: str, piece: str) -> bool:
        """Whether ``piece`` can follow ``before`` (empty at the beginning)."""
        key = (before, piece)
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= MEMO:
                self._fits.clear()
            known = self._fits[key] = self.merged(before + piece) == ([before, piece] if before else [piece])
        return known

    def split(self, text: str) -> list[str]:
        """The pieces of a text that holds marks for spaces."""
        longest_from, shorter, known = self.matches.iter_long, self.shorter.get, self._fits.get
        failed, tried = bytearray(len(text) // 8 + 1), False
        pieces: list[str] = []
        at, before, size = 0, "", len(text)
        base, longest = -WINDOW, None
        while at < size:
            if longest is None or base + WINDOW < min(size, at + self.longest):
                base, longest = at, longest_from(text[at : at + WINDOW])
            last, piece = next(longest, (size, ""))
            ahead = base + last + 1 - len(piece) == at
            if not ahead:
                piece = text[at]
            first = piece
            while piece:
                end = at + len(piece)
                if not (tried and failed[end >> 3] >> (end & 7) & 1):
                    fit = known((before, piece))
                    if fit or (fit is None and self.fits(before, piece)):
                        pieces.append(piece)
                        at, before = end, piece
                        break
                piece = shorter(piece)
            else:
                failed[at >> 3] |= 1 << (at & 7)
                tried = True
                at -= len(pieces.pop())
                before = pieces[-1] if pieces else ""
            if not (ahead and piece is first):  # longest matches have to be looked for from another place
                longest = None
        return pieces

    def numbers(self, pieces: Sequence[str]) -> list[int]:
        try:
            return [self.ids[piece] for piece in pieces]
        except KeyError:
            return [i for piece in pieces for i in ([self.ids[piece]] if piece in self.ids else [self.byte_ids[b] for b in piece.encode()])]

    def _coded(self, text: str) -> tuple[bytes, bytes]:
        ids = self.numbers(self.split(text))
        return array("I", ids).tobytes(), self._decoded(ids)

    def _stretch(self, text: str) -> tuple[bytes, bytes]:
        known = self._stretches.get(text)
        if known is None:
            if len(self._stretches) >= MEMO:
                self._stretches.clear()
            known = self._stretches[text] = self._coded(text)
        return known

    def _word(self, word: str) -> tuple[bytes, bytes]:
        whole = word if word.startswith(SPACE_MARK) else SPACE_MARK + word
        joined = self.joined
        marks = [k for k, pair in enumerate(zip(whole, whole[1:]), 1) if pair not in joined]
        if not marks:
            return self._coded(whole)
        parts = [self._stretch(whole[a:b]) for a, b in zip([0, *marks], [*marks, len(whole)])]
        return b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """The ids of a whole text as little-endian unsigned 32-bit numbers, begin and end among them, and what those
        ids decode to in UTF-8."""
        ends = [array("I", [i]).tobytes() for i in (self.begin, self.end)]
        if not text:
            return b"".join(ends), b""
        words = text.replace(SPACE_MARK, " ").split(" ")
        if "" in words:  # runs of spaces: a word takes all the marks before it
            words = [w if w.startswith(SPACE_MARK * 2) else w[1:] for w in _WORDS(SPACE_MARK + SPACE_MARK.join(words))]
        memo = self._words
        for word in set(words).difference(memo):
            memo[word] = self._word(word)
        parts = [memo[word] for word in words]
        if len(memo) > MEMO:
            memo.clear()
        # The leading space is the model's own.
        return b"".join([ends[0], *[p[0] for p in parts], ends[1]]), b"".join([p[1] for p in parts])[1:]

    def _decoded(self, ids: Sequence[int]) -> bytes:
        """What ids without control pieces among them decode to, the leading space still there."""
        whole = b"".join([self.raw[i] for i in ids])
        try:
            whole.decode()  # pieces are whole characters, so the runs of byte pieces between them are
            return whole
        except UnicodeDecodeError:
            return self._put_together(ids)

    def _put_together(self, ids: Sequence[int]) -> bytes:
        """Runs of byte pieces are read as UTF-8, each byte that is not part of a character by itself."""
        runs = ((of_bytes, b"".join([self.raw[i] for i in run])) for of_bytes, run in groupby(ids, self.byte.__contains__))
        return b"".join([characters(part) if of_bytes else part for of_bytes, part in runs])

    def decode(self, ids: Sequence[int]) -> str:
        """The text of any ids: the space that stands before the first piece goes."""
        first = next((i for i in ids if i not in self.control), None)
        text = self._put_together(ids).decode()
        starts = first is not None and first not in self.byte and first not in self.unknown and text.startswith(" ")
        return text[1:] if starts else text


def characters(data: bytes) -> bytes:
    """UTF-8; a byte that belongs to no character becomes one replacement character."""
    out = []
    while data:
        try:
            data.decode()
            break
        except UnicodeDecodeError as wrong:
            out += [data[: wrong.start], "\ufffd".encode()]
            data = data[wrong.start + 1 :]
    return b"".join([*out, data])


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encoded(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, ids (array, begin and end among them) and decoded text of every row."""
    path, id_type = tokenizer_path(model), docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            both = [pieces(path).encode(text) for text in texts]
            ids = pa.array([np.frombuffer(data, "<u4").astype(np.int32) for data, _ in both], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array([d.decode() for _, d in both], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {id_type}, ids array<int>, decoded string")


def digests(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_tokens and SHA-256 of ids and of the decoded text, without sending either out of its task."""
    path, id_type = tokenizer_path(model), docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            counts, of_ids, of_text = [], [], []
            for text in texts:
                data, decoded = pieces(path).encode(text)
                counts.append(len(data) // 4)
                of_ids.append(hashlib.sha256(data).hexdigest())
                of_text.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
