"""BPE encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no vocabulary token can never be merged across, so every such pair is a
certain cut: the fragments between cuts are encoded on their own and their ids put together. Fragments repeat far more
often than words do; each task keeps what it has encoded in a bounded memo, by white-space run and by fragment.

Defined cases: a null or empty text has no ids and decodes to the empty text; special strings inside a text are their
special token; repeated rows and null ids are rows like any other; an empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from listingflow.llm.common import load_tokenizer, text_slices, tokenizer_path
from listingflow.llm.counts import SPACE, byte_letters, special_pattern

#: Entries a task's memos hold before they are emptied.
MEMO = 400_000


def plain_words(run: str) -> list[str] | None:
    """The normalised words of a run that is Latin letters and perhaps one mark after them; None for any other run.
    These letters are composed already and lower-case one by one, so the normaliser has nothing else to do."""
    core, mark = (run[:-1], run[-1:]) if run[-1] in ".,;:!?" else (run, "")
    if not core.isalpha() or (not core.isascii() and (max(core) >= "\u0250" or "\u0130" in core)):
        return None
    return [core.lower(), mark] if mark else [core.lower()]


class Codec:
    """Encoder and decoder for word-level BPE vocabularies whose words end in a suffix and whose normaliser drops white space."""

    def __init__(self, path: str):
        import regex
        from tokenizers.models import BPE

        self.tokenizer = load_tokenizer(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = special_pattern(self.tokenizer)
        self.special_ids = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        pattern = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", SPACE)).findall
        self.odd_space = regex.compile(r"[\x1c-\x1f]").search
        self.runs = regex.compile(f"[^{SPACE}]+").findall
        self.letters = byte_letters()
        # Words end in the suffix; fragments before the last are encoded without it.
        self.last = self.tokenizer.model
        self.inner = BPE(vocab=self.vocab, merges=[tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])
        bare = (token.removesuffix(self.suffix) for token in self.vocab)
        self.joined = {pair for token in bare for pair in zip(token, token[1:])}
        self.memo: dict[str, tuple[str, str]] = {}
        self.fragments: dict[tuple[str, bool], tuple[str, str]] = {}

    def cuts(self, word: str) -> list[str]:
        """The fragments between forced boundaries."""
        marks = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in self.joined]
        return [word[a:b] for a, b in zip([0, *marks], [*marks, len(word)])] if marks else [word]

    def _fragment(self, text: str, last: bool) -> tuple[str, str]:
        known = self.fragments.get((text, last))
        if known is None:
            pieces = (self.last if last else self.inner).tokenize(text)
            known = self.fragments[text, last] = (" ".join(str(p.id) for p in pieces), " ".join(p.value for p in pieces))
            if len(self.fragments) > MEMO:
                self.fragments.clear()
        return known

    def _encode_run(self, run: str) -> tuple[str, str]:
        """Ids and token strings, each joined by one space, of a run without white space."""
        ids, values = [], []
        for k, piece in enumerate(self.special.split(run) if self.special else [run]):
            if k % 2:
                ids.append(str(self.special_ids[piece]))
                values.append(piece)
                continue
            for word in (plain_words(piece) or self.words(self.tokenizer.normalizer.normalize_str(piece))) if piece else ():
                fragments = self.cuts(word.encode().decode("latin-1").translate(self.letters))
                for n, fragment in enumerate(fragments, 1):
                    a, b = self._fragment(fragment, n == len(fragments))
                    ids.append(a)
                    values.append(b)
        return " ".join(ids), " ".join(values)

    def encode(self, text: str) -> tuple[str, str]:
        """The ids of a whole text in decimal and its decoded text; both join their parts by one space."""
        runs = self.runs(text) if self.odd_space(text) else text.split()
        memo = self.memo
        for run in set(runs).difference(memo):
            memo[run] = self._encode_run(run)
        parts = [memo[run] for run in runs]
        if len(memo) > MEMO:
            memo.clear()
        return " ".join([p[0] for p in parts]), " ".join([p[1] for p in parts])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(docs: DataFrame, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, ids (array) and decoded text of every row."""
    path, id_type = tokenizer_path(vocabulary), docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            both = [codec(path).encode(text) for text in texts]
            ids = [list(map(int, ids.split())) for ids, _ in both]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([d for _, d in both], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {id_type}, ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, n_tokens and SHA-256 of ids and of the decoded text, without sending either out of its task."""
    path, id_type = tokenizer_path(vocabulary), docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            counts, of_ids, of_text = [], [], []
            for text in texts:
                ids, decoded = codec(path).encode(text)
                counts.append(ids.count(" ") + 1 if ids else 0)
                of_ids.append(hashlib.sha256(ids.encode()).hexdigest())
                of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
