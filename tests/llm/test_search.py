"""Piece codec, hard negatives and ranked search against the library and brute force, with nulls, ties, repeats and clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from listingflow.llm import negatives, pieces, ranking
from listingflow.llm.common import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return pieces.Pieces(MODEL)


def odd_texts() -> list[str]:
    rng = random.Random(13)
    odd = [chr(c) for c in (0, 9, 10, 13, 0x85, 0xA0, 0x200B, 0x2028, 0x3000, 0x130, 0x301, 0x1F600, 0x2581, 0x10FFFF, 0xFFFD, 0xD7FF)]
    odd += [" ", "   ", "a", "th", "日本", "<s>", "</s>", "<0x41>", "<unk>", "é", "--", "==", "...", "don't"]
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 14))) for _ in range(1500)]
    texts += ["".join(rng.choices("abcdehinorst", k=rng.randint(0, 90))) for _ in range(500)]
    texts += [a + " " * n + b for n in range(70) for a, b in (("", ""), ("x", "the"), ("日", "日"), ("\n", "\n"))]
    return texts + ["ab" * 3000, "=" * 5000, "x" * 700 + "y", "word " * 4000]


def test_pieces_agree_with_the_library(library, coder):
    for text in odd_texts():
        ids = library.encode(text, add_bos=True, add_eos=True)
        data, decoded = coder.encode(text)
        assert np.frombuffer(data, "<u4").tolist() == ids, text
        assert decoded.decode() == library.decode(ids) == coder.decode(ids), text


def test_any_ids_decode_as_the_library_does(library, coder):
    rng = random.Random(14)
    for _ in range(4000):
        ids = rng.choices(range(32000), k=rng.randint(0, 5)) + rng.choices(range(262), k=rng.randint(0, 8))
        rng.shuffle(ids)
        assert coder.decode(ids) == library.decode(ids), ids


def test_a_failed_position_is_left_for_a_shorter_piece(coder):
    # The longest piece at the beginning does not always lead on: the walk has to come back to it.
    rng = random.Random(15)
    words = ["".join(rng.choices("aeinorst", k=12)) for _ in range(800)]
    greedy = 0
    for word in words:
        text = "▁" + word
        split = coder.split(text)
        assert split == coder.merged(text)
        at, longest = 0, []
        while at < len(text):
            longest.append(next(text[at : at + k] for k in range(16, 0, -1) if text[at : at + k] in coder.ids and at + k <= len(text)))
            at += len(longest[-1])
        greedy += split == longest
    assert greedy < len(words)


def test_piece_digests(spark, library):
    texts = odd_texts()[::9] + [None, ""]
    rows = [(k, t, 1) for k, t in enumerate(texts)] + [(3, texts[3], 2), (None, "no id", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(3)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    expected = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        expected.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids).encode())))
    assert Counter(map(tuple, pieces.digests(docs).collect())) == Counter(expected)
    got = {(r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in pieces.encoded(docs).collect()}
    assert got == {(i, tuple(ids), library.decode(ids)) for i, t, _ in rows for ids in [library.encode(t or "", add_bos=True, add_eos=True)]}
    assert pieces.digests(docs.limit(0)).count() == 0


# ---- hard negatives ------------------------------------------------------------------------------


def brute_negatives(rows, every: int = 10) -> Counter:
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = Counter()
    for a, (i, v, label) in enumerate(good):
        if i % every:
            continue
        score = lambda w: max(-negatives.MOST, min(negatives.MOST, sum(x * y for x, y in zip(v, w))))
        others = sorted((-score(w), j, m) for b, (j, w, m) in enumerate(good) if b != a and len(w) == len(v))
        for positive, p, _ in [o for o in others if o[2] == label][:5]:
            fits = [(s, j) for s, j, m in others if m != label and 80 * -positive <= 100 * -s <= 100 * -positive]
            for rank, (s, j) in enumerate(fits[:5], 1):
                out[i, p, rank, j, -positive, -s] += 1
    return out


def vectors() -> list[tuple]:
    rng = random.Random(11)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(k, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)], rng.randrange(4)) for k in range(300)]
    rows += [(400 + k, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5], k % 3) for k in range(40)]  # ties
    rows += [(500, rows[3][1], 1), (500, rows[4][1], 1), (500, rows[5][1], 2), (10, rows[10][1], rows[10][2])]  # repeated ids
    rows += [(600 + k, [rng.random(), rng.random()], k % 2) for k in range(30)] + [(700, [], 1), (701, [], 1), (702, [], 2)]
    rows += [(800, None, 1), (810, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (820, [float("nan")] * 6, 1), (830, [float("inf")] * 6, 1), (None, rows[0][1], 1), (840, rows[0][1], None)]
    return rows


def test_hard_negatives_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CELL", 48)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, score int").repartition(5)
    df = df.withColumn("label", negatives.relabelled(F.col("label"), F.col("vec_id")))
    got = negatives.hard_negatives(df, settings=negatives.Settings(anchors=10))
    assert Counter(map(tuple, got.collect())) == brute_negatives(rows)
    assert negatives.hard_negatives(df.limit(0)).count() == 0


def test_scores_beyond_doubles_stay_exact(spark):
    big = float(1 << 40)
    rows = [(0, [big, 1.0], 1), (1, [big, 0.5], 1), (2, [big, 0.25], 2), (3, [big, 0.5], 2), (4, [1e300, 1.0], 3), (5, [1e308, 1e308], 1), (6, [3.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.withColumn("label", negatives.relabelled(F.col("label"), F.col("vec_id")))
    got = negatives.hard_negatives(df, settings=negatives.Settings(anchors=10))
    expected = [(i, [min(x, float(np.finfo(float).max) / 256) for x in v], m) for i, v, m in rows]
    assert Counter(map(tuple, got.collect())) == brute_negatives(expected)


# ---- ranked search -------------------------------------------------------------------------------


def brute_ranking(docs, items, k: int) -> Counter:
    find = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    found = [(i, Counter(find(lower(t)))) for i, t in docs]
    n, total = sum(1 for _, c in found if c), sum(sum(c.values()) for _, c in found)
    held = Counter(t for _, c in found for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, c in found:
            if c:
                m = 50 + (50 * sum(c.values()) * n) // total
                s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(find(lower(text))) if c[t])
                scores += [(-s, i is None, i or 0)] if s > 0 else []
        for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, None if null else i, -s] += 1
    return out


@pytest.mark.parametrize(("few", "k"), [(False, 50), (True, 3)])
def test_ranked_search_agrees_with_all_scores(spark, monkeypatch, few, k):
    monkeypatch.setattr(ranking, "STRIP", 16)
    monkeypatch.setattr(ranking, "TERMS", 60 if few else 20_000)
    if few:  # signatures so narrow that most terms seem to stand everywhere
        monkeypatch.setattr(ranking, "WIDEST", 64)
    rng = random.Random(12)
    words = [f"w{k}" for k in range(300)] + ["Straße", "日本", "x1", "ÀÉ"]
    make = lambda n: rng.choice([" ", ", ", "\n", "-"]).join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=n))
    texts = [make(rng.randint(1, 120)) for _ in range(160)] + [make(4000), "W1 " * 300, "W1 w2 w1", None, "", " ...\n", "w1 w2 w1!"]
    rows = [(7 * k % 1009, t) for k, t in enumerate(texts)] + [(3, texts[5])] * 3 + [(None, texts[6]), (2000, texts[6])]
    items = [(k, make(rng.randint(1, 25))) for k in range(12)] + [(3, "w1 W1 w2"), (None, "w5 w6"), (50, None), (51, "nowhere"), (52, ""), (53, texts[160])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, term string").repartition(4)
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, item int")
    assert Counter(map(tuple, ranking.ranked(docs, asked, k).collect())) == brute_ranking(rows, items, k)
    if few:
        assert ranking.ranked(docs.limit(0), asked).count() == 0 == ranking.ranked(docs, asked.limit(0)).count()


def test_signatures_only_overestimate():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 40, np.uint64)
    cell = np.unique(rng.integers(0, 40 * 30, 600))
    term, doc = np.divmod(cell, 30)
    counts = rng.integers(1, 70, len(cell))
    for width, chosen, bitmaps in ranking._blocks(counts, term, doc, hashes, 30):
        whole = np.unpackbits(np.frombuffer(bitmaps, np.uint8).reshape(width, -1), axis=1)
        for t, d, n in zip(term, doc, counts):
            if d in chosen:
                at = int(np.flatnonzero(chosen == d)[0])
                for level in range(min(ranking.LEVELS, int(math.log2(n)) + 1)):
                    assert all(whole[p[0], at] for p in ranking.places(hashes[[t]], level, width))
