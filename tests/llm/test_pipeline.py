"""The pipeline stage by stage: what each keeps, and that decisions take effect."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from listingflow.llm import copies, lines, packing, quality
from listingflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def firsts(rows: list[tuple]) -> list:
    """The id that stays of every group linked by a five-word Jaccard similarity of 0.8, by comparing all pairs."""
    words = [b"".join(w + b" " for w in (t or "").encode().lower().split()).split() for _, t in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both >= 0.8 * either - 1e-9:
                root = [root[j] if r == root[i] else r for r in root]
    least = {r: min((rows[k][0] is None, rows[k][0] or 0) for k in range(len(rows)) if root[k] == r) for r in set(root)}
    return [None if no_id else i for no_id, i in least.values()]


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    first, second, third, last = (f for _, f in corpus_pipeline.STAGES)
    kept = first(spark, docs, SF).cache()
    wanted = {r["doc_id"] for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == wanted
    cleaned = second(spark, kept, SF).cache()
    report = {r["doc_id"]: r["n_lines"] - r["n_dropped"] for r in lines.line_report(kept).collect()}
    assert cleaned.columns == docs.columns
    assert all(report[r["doc_id"]] == (len(r["text"].split("\n")) if r["text"] else report[r["doc_id"]]) for r in cleaned.collect())
    single = third(spark, cleaned, SF).cache()
    assert single.columns == docs.columns
    assert Counter(r["doc_id"] for r in single.collect()) == Counter(firsts([(r["doc_id"], r["text"]) for r in cleaned.collect()]))
    packed = last(spark, single, SF)
    assert Counter(map(tuple, packed.drop("sequence_id", "offset").collect())) == Counter(map(tuple, packing.pieces(single).collect()))
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_near_copies_of_five_words_are_dropped(spark, monkeypatch):
    monkeypatch.setattr(copies, "CHUNK", 8)
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = [" ".join(words(rng.randint(1, 90))) for _ in range(60)]
    for base in [words(80) for _ in range(15)] + [words(200)] * 30:
        edited = list(base)
        for _ in range(rng.randint(1, 5)):
            edited[rng.randrange(len(edited))] = "edited"
        texts += [" ".join(base), " ".join(edited).upper() + " \n"]
    texts += [None, "", " \t", "a", "A", "a b"]
    rows = [(k * 7 % 1009, t) for k, t in enumerate(texts)] + [(3, texts[9]), (None, texts[9]), (None, "only here without an id")]
    least = firsts(rows)
    got = copies.without_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got.columns == ["doc_id", "text"]
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(least)
    assert corpus_pipeline.drop_near_duplicates(spark, got, SF).count() == len(least)
    assert copies.without_copies(got.limit(0)).count() == 0


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]
    assert set(ORACLES) <= set(QUERIES)


def test_unlike_sets_share_no_key():
    """Keys of many unlike sets are all their own; the keys of near copies are shared, whatever the number of sets."""
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, 40, np.uint64) for _ in range(3000)]
    keys = np.concatenate([copies.keys_of(s) for s in sets])
    assert len(np.unique(keys)) == len(keys) == 3000 * copies.KEYS
    for s in sets[:300]:
        near = np.concatenate([s[:36], rng.integers(0, 1 << 63, 4, np.uint64)])  # similarity 36 / 44
        assert np.isin(copies.keys_of(near), copies.keys_of(s)).any()
    assert len(copies.keys_of(sets[0][:0])) == copies.KEYS
