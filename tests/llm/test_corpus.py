"""Corpus operators against brute force on small fixtures with nulls, empty and long texts, ties, repeated rows and clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from listingflow.llm import codec, components, copies, counts, exact, licenses, lines, neighbours, packing, quality, sharding, simhash
from listingflow.llm.common import load_tokenizer, tokenizer_path

EXTRA = "doc_id long, text string, lang string, size long, llm_keep_me int, block string, shard string"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def corpus() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    words = ["alpha", "Beta", "gamma,", "délta", "Straße.", "don't", "42", "x" * 40, "ЖУК", "&&&", "<|endoftext|>", "日本"]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = ["This exact passage stands in many places of the corpus.", "  AND ANOTHER LINE that is repeated, over and over.\t"]
    texts = [make(rng.randint(0, 60)) for _ in range(40)]
    texts += ["\n".join([make(5), shared[k % 2], make(4), shared[0]]) for k in range(9)]
    texts += [texts[3]] * 6 + [texts[3].upper(), texts[5].swapcase(), None, None, "", " \n\t ", "a", make(3000), make(3000) + "\nReleased under the MIT License."]
    long = make(400)
    texts += [long, long + " tail", long + " tail two", "x" * 5000, "x" * 5000 + "y", "x" * 4999 + "y"]
    rows: list[tuple[int | None, str | None]] = [(100 + 3 * k, t) for k, t in enumerate(texts)]
    return rows + [rows[4], rows[4], (None, texts[3]), (None, "no id, but a line that is long enough\nb"), (7, "MIT License. mit license APACHE license general  public\nLICENSE")]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", 1, 2, "b", "s") for i, t in ROWS], EXTRA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EXTRA)


def same(df, expected: list[tuple]) -> None:
    assert Counter(map(tuple, df.collect())) == Counter(expected)


def test_quality_learns_a_kernel_and_scores_every_row(spark):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["one", "small", "word", "follows", "another"]) for _ in range(rng.randint(20, 80))) + "."
    bad = lambda: " | ".join(rng.choice(["BUY", "NOW!!", "$$$"]) for _ in range(rng.randint(5, 30)))
    rows = [(k, good() if k % 3 else bad()) for k in range(600)] + [(None, "x"), (601, None), (602, ""), (5, good())]
    labels = [(k, int(k % 3 > 0)) for k in range(600)] + [(1, None), (2, 9), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = quality.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] != 5]
    assert held and all(r["held_out"] and r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held)
    empty = {r["score"] for r in got if r["doc_id"] in (601, 602)}
    assert len(empty) == 1
    kept = quality.accepted(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in got)


def test_quality_without_labels_and_without_rows(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality_scores(docs, labels).collect()} == {0.5}
    assert quality.quality_scores(none, labels).count() == 0


def test_normal_equations_are_sums_over_rows(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(50, quality.WIDTH)), rng.integers(0, 2, 50).astype(float)
    kernel = quality.Kernel(quality.Settings(features=8), x.mean(0), x.std(0))
    df = spark.createDataFrame([(int(k % 2), [float(v) for v in r], float(t)) for k, (r, t) in enumerate(zip(x, y))], "fold int, statistics array<double>, label double").repartition(4)
    left, right = quality.normal_equations(df, kernel, 2)
    z = kernel(x)
    assert np.allclose(left.sum(0), z.T @ z) and np.allclose(right.sum(0), z.T @ y) and np.allclose(left[0], z[::2].T @ z[::2])


def test_isotonic_pools_violators():
    knots, levels = quality.isotonic(np.arange(4.0), np.array([0.1, 0.6, 0.2, 0.9]), np.ones(4))
    assert np.allclose(levels, [0.1, 0.4, 0.9]) and np.allclose(knots, [0, 1.5, 3])


def test_token_counts_agree_with_the_library(docs, none):
    library = load_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS]
    same(counts.token_counts(docs), expected)
    assert counts.token_counts(none).count() == 0


def test_pre_tokens_of_odd_characters():
    library = load_tokenizer(tokenizer_path("byte_bpe_50k.json"))
    special = counts.special_pattern(library)
    odd = [chr(c) for c in (0, 0x1C, 0x1F, 0x85, 0xA0, 0x200B, 0x2028, 0x3000, 0x130, 0x3A3, 0x301, 0x1F600, 0xB2)] + [" ", "\n", "'s", "a", "1", ".", "<|endoftext|>"]
    rng = random.Random(3)
    for _ in range(2000):
        text = "".join(rng.choices(odd, k=rng.randint(0, 20)))
        found = sum(1 if p == "<|endoftext|>" else len(library.model.tokenize(p.encode().decode("latin-1").translate(counts.byte_letters()))) for p in counts.pre_tokens(text, special))
        assert found == len(library.encode(text, add_special_tokens=False).ids), text


def test_codec_round_trip_and_digests(docs, none):
    library = load_tokenizer(tokenizer_path("word_bpe_49k.json"))
    ids = [library.encode(t or "", add_special_tokens=False).ids for _, t in ROWS]
    decoded = [library.decode(i, skip_special_tokens=False) for i in ids]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    same(codec.digests(docs), [(d, len(i), sha(" ".join(map(str, i))), sha(t)) for (d, _), i, t in zip(ROWS, ids, decoded)])
    assert Counter((r[0], tuple(r[1]), r[2]) for r in codec.encoded(docs).collect()) == Counter((d, tuple(i), t) for (d, _), i, t in zip(ROWS, ids, decoded))
    assert codec.digests(none).count() == 0


def test_forced_boundaries_cut_only_where_no_token_reaches():
    coder = codec.codec(tokenizer_path("word_bpe_49k.json"))
    assert coder.cuts("hello") == ["hello"]
    pair = next(a + b for a in "qzxj" for b in "qzxj" if (a, b) not in coder.joined)
    assert coder.cuts("a" + pair + "b") == ["a" + pair[0], pair[1] + "b"]
    for text in ("xqzjq vjqz", "qjxz", "wqxj's JQXZ!"):
        assert coder.encode(text)[0] == " ".join(map(str, coder.tokenizer.encode(text, add_special_tokens=False).ids))


def test_shards_are_whole_groups_near_equal_and_gapless(docs, none):
    got = sharding.shard_by_bytes(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in ROWS)
    texts = defaultdict(set)
    for i, t in ROWS:
        texts[i, zlib.crc32((t or "").encode())].add(t or "")
    shards, size = defaultdict(list), Counter()
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 8
        (text,) = texts[r["doc_id"], r["text_crc32"]]
        assert r["size"] == len(text.encode()) + 1
        shards[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    homes = defaultdict(set)
    for r in got:
        homes[r["text_crc32"]].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    groups = Counter()
    for _, t in ROWS:
        groups[t or ""] += len((t or "").encode()) + 1
    assert max(size.values()) <= max(max(groups.values()), sum(size.values()) / 8 + max(groups.values()))
    assert sharding.shard_by_bytes(none).count() == 0


def test_a_group_above_an_equal_share_gets_its_own_shard(spark):
    rows = [(k, "hot") for k in range(3000)] + [(10_000 + k, f"text {k}") for k in range(700)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    by = {r["shard"]: r for r in got}
    assert by[0]["n"] == 3000 and len(by) == 8
    rest = [r["b"] for s, r in by.items() if s]
    assert max(rest) - min(rest) <= 2 * len("text 700 ")


def brute_fingerprint(text: str) -> int:
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def roots(n: int, links) -> list[int]:
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return [root(k) for k in range(n)]


def test_simhash_components_agree_with_all_pairs(docs, none):
    prints = [brute_fingerprint(t or "") for _, t in ROWS]
    of = roots(len(ROWS), [(a, b) for a in range(len(ROWS)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    least = defaultdict(list)
    for k, (i, _) in enumerate(ROWS):
        least[of[k]].append(i)
    name = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    same(simhash.near_duplicates(docs), [(i, f"{prints[k]:016x}", name[of[k]]) for k, (i, _) in enumerate(ROWS)])
    assert simhash.near_duplicates(none).count() == 0


def test_stages_keep_columns_named_like_their_own(spark, docs):
    named = docs.select("doc_id", "text", *[F.lit(k).alias(n) for k, n in enumerate(("llm_doc", "llm_hash", "llm_keep", "llm_id", "LLM_K", "id", "hash", "set", "num", "chunk", "component"))])
    cleaned = lines.deduplicated(named)
    assert cleaned.columns == named.columns
    same(cleaned.select("doc_id", "text", "llm_keep"), [(*r, 2) for r in lines.deduplicated(docs.select("doc_id", "text")).collect()])
    single = copies.without_copies(named)
    assert single.columns == named.columns
    same(single.select("doc_id", "text", "LLM_K"), [(*r, 4) for r in copies.without_copies(docs.select("doc_id", "text")).collect()])


@pytest.mark.parametrize("bucket", [4, 2048])
def test_links_survive_crowded_buckets(spark, bucket):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(4)]
    values = {b for b in base} | {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(40)}
    values = sorted(values | {rng.getrandbits(64) for _ in range(60)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), bucket=bucket).collect()
    at = {v: k for k, v in enumerate(signed)}
    assert all(((r["u"] ^ r["v"]) & ((1 << 64) - 1)).bit_count() <= 3 for r in links)
    mine = roots(len(values), [(at[r["u"]], at[r["v"]]) for r in links])
    brute = roots(len(values), [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3])
    assert len(set(zip(mine, brute))) == len(set(mine)) == len(set(brute))


@pytest.mark.parametrize("radius", range(8))
def test_bit_planes_find_exactly_the_near_pairs(radius):
    rng = np.random.default_rng(radius)
    values = rng.integers(0, 4, (300, 16)).dot(4 ** np.arange(16)).astype(np.uint64)
    values[::3] = values[0] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    bucket = np.sort(rng.integers(0, 9, 300))
    found = {(int(a), int(b)) for i, j in simhash.near_pairs(values, bucket, radius) for a, b in zip(i, j)}
    assert found == {(a, b) for b in range(300) for a in range(b) if bucket[a] == bucket[b] and int(values[a] ^ values[b]).bit_count() <= radius}


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_neighbours_reach_recall_and_score_exactly(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1500, 16))
    vectors[200:700] = vectors[200]  # a hot vector
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    rows += [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [1.0, None] + [0.0] * 14), (2200, [1.0, 2.0]), (None, [1.0] * 16), rows[50], (2250, [float("inf")] + [1.0] * 15)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<double>, score int, rank int")
    settings = neighbours.Settings(sample=600, leaf=60, trials=100, cell=128)
    got = defaultdict(list)
    for r in neighbours.nearest(df, settings=settings).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 1500, 50))
    met = 0
    for q, found in got.items():
        score = np.append(neighbours.cosine(vectors[q], vectors), neighbours.cosine(vectors[q], vectors[50:51]))
        names = np.append(np.arange(1500), 50)
        order = [int(names[k]) for k in np.lexsort((names, -score)) if k != q][:5]
        copies = 2 if q == 50 else 1  # the row of id 50 stands there twice and asks twice
        assert sorted(f[0] for f in found) == sorted([1, 2, 3, 4, 5] * copies) and all(f[2] == score[f[1]] for f in found)
        met += sum((Counter(order * copies) & Counter(f[1] for f in found)).values())
    assert met / (5 * (len(got) + 1)) >= 0.9
    assert [f[1] for f in got[250]] == [200, 201, 202, 203, 204] and 50 in [f[1] for f in got[50]]
    assert neighbours.nearest(df.limit(0)).count() == 0
    assert neighbours.nearest(df.where("vec_id in (0, 51)")).count() == 1
    assert neighbours.nearest(df.where("vec_id in (0, 50, 51)")).count() == 3 + 2 * 3


def test_rows_of_one_id_and_other_lengths_are_searched(spark):
    rows = [(50, [1.0, 0.0]), (51, [1.0, 0.1]), (51, [0.0, 1.0]), (100, [1.0, 2.0, 3.0]), (101, [3.0, 2.0, 1.0]), (102, [1.0, 2.0, 2.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 3)) for r in got} == {
        (50, 1, 51, 0.995), (50, 2, 51, 0.0), (100, 1, 102, 0.980), (100, 2, 101, 0.714)
    }


@pytest.mark.parametrize("n", [300, 2000, 6000])
def test_recall_of_production_settings_on_both_sides_of_the_leaf_size(spark, n):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(12, 24))
    vectors = centres[rng.integers(0, 12, n)] + 0.6 * rng.normal(size=(n, 24))
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in neighbours.nearest(df).collect():
        got[r["query_id"]].add(r["vec_id"])
    met = 0
    for q in range(0, n, 50):
        score = neighbours.cosine(vectors[q], vectors)
        score[q] = -2
        met += len(got[q] & set(np.lexsort((np.arange(n), -score))[:5].tolist()))
    assert met >= 0.9 * 5 * len(range(0, n, 50))


def test_only_the_sample_leaves_its_tasks(spark):
    rows = spark.range(20_000).select(F.col("id").alias("row"), "id", F.array(F.lit(1.0)).alias("v"))
    assert 700 < len(neighbours.sampled(rows, 1000, 20_000)) < 1300 and len(neighbours.sampled(rows.limit(9), 1000, 9)) == 9


@pytest.mark.parametrize("first", [2, 64])
def test_radix_groups_agree_with_equality(docs, none, monkeypatch, first):
    monkeypatch.setattr(exact, "FIRST_BYTES", first)
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[lower(t or "")].append(i)
    got = exact.exact_duplicates(docs).collect()
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in groups.items()}
    kept = Counter()
    assert len(got) == len(ROWS)
    for r in got:
        ids = by_hash[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}
    assert exact.exact_duplicates(none).count() == 0


def brute_lines(rows, least=20, shared=3):
    key = lambda line: lower(line.strip(" \t\n\r\x0b\x0c"))
    low = -(1 << 63)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(low if i is None else i)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if not (len(key(x)) >= least and len(holders[key(x)]) >= shared and max(holders[key(x)]) != (low if i is None else i))]
        out.append((i, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_lines_agree_with_brute_force(spark, docs, none):
    same(lines.line_report(docs), brute_lines(ROWS))
    assert lines.line_report(none).count() == 0
    cleaned = lines.deduplicated(docs)
    assert cleaned.schema.names == docs.schema.names and cleaned.count() == len(ROWS)


@pytest.mark.parametrize("parts,batch", [("1", "10000"), ("7", "3"), ("23", "1")])
def test_line_runs_across_batches_and_partitions(spark, parts, batch):
    rng = random.Random(int(parts))
    pool = [f"a line of the shared pool, number {k:03d}" for k in range(25)]
    rows = [(k, "\n".join(rng.choices(pool, weights=[60] + [1] * 24, k=rng.randint(0, 6)) + [f"own {k}"])) for k in range(120)]
    rows += [(5, rows[6][1]), rows[7], (None, rows[8][1])]
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true"), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    names = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"
    try:
        for name, value in zip(names, (parts, "false", batch)):
            spark.conf.set(name, value)
        same(lines.line_report(spark.createDataFrame(rows, "doc_id long, text string")), brute_lines(rows))
    finally:
        for name, value in zip(names, old):
            spark.conf.set(name, value)


def brute_templates():
    """Every template's words, the room of its blocks, and the words that tell it from the others, from the wordings alone."""
    out = []
    for label, wording in licenses.TEMPLATES + licenses.NEIGHBOURS:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(wording))
        beside = max(3, -(-len(words) // 4))
        out.append([label, set(words), len(words) + beside, beside, set(words) & licenses.NAMES])
    return [(*t, {x for o in out if t[4] and t[4] < o[4] for x in o[4] - t[4]}) for t in out]


BRUTE_TEMPLATES = brute_templates()


def brute_licenses(text: str):
    words = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s))
    w, places, base = words(text), [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        places += at
        base |= {label} if at else set()
    best, labels = 0.0, set(base)
    for label, t, room, beside, names, others in BRUTE_TEMPLATES:
        for k in range(len(w)):
            block = w[k : k + room]
            held = t & set(block)
            if w[k] not in t or len(held) < 0.85 * len(t) - 1e-9 or not names <= set(block):
                continue
            last = max(block.index(x) for x in held) + 1
            if not others & set(w[max(0, k - beside) : k + last + beside]):
                labels.add(label)
                best = max(best, len(held) / len(t))
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best or float(bool(base))


def test_license_join_agrees_with_all_templates_in_all_blocks(spark, none):
    rng = random.Random(9)
    rows = list(ROWS)
    filler = lambda n: [rng.choice(["the", "of", "work", "plain", "copy", "under", "4", "public"]) for _ in range(n)]
    for k, (_, wording) in enumerate((licenses.TEMPLATES + licenses.NEIGHBOURS) * 8):
        words = wording.split()
        words = [x for n, x in enumerate(words) if n >= rng.randrange(0, 3)] + ["and", "more"]
        if k % 3 == 0:
            rng.shuffle(words)
        if k % 4 == 1:  # wrapped
            words[len(words) // 2] += "\n#"
        if k % 4 == 2:  # scattered over a line
            words = [x for word in words for x in [word, *filler(rng.randint(0, 2))]]
        beside = rng.choice([[], ["NC"], ["Mozilla"], ["ShareAlike"], filler(4)])
        rows.append((5000 + k, " ".join(["before", "it", *filler(rng.randint(0, 30)), *beside, *words, *beside[::-1], *filler(rng.randint(0, 9)), "\nafter, mit"])))
    rows += [(7000 + k, t) for k, t in enumerate([*WRAPPED.values(), "Licensed under CC BY 4.0.", "Licensed under the Mozilla Public License, Version 2.0.", BOOST])]
    got = licenses.scan_licenses(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, w string").repartition(3))
    same(got, [(i, *brute_licenses(t or "")) for i, t in rows])
    assert licenses.scan_licenses(none).count() == 0


def test_license_sql_states_the_rule_of_the_scan(spark):
    import duckdb
    import pandas as pd

    from listingflow.llm.sql import ORACLES

    texts = [*WRAPPED.values(), *[t for _, t in licenses.TEMPLATES + licenses.NEIGHBOURS], BOOST, "Licensed under CC BY 4.0.", "Released the MIT words and many more under License", None, ""]
    rows = [(k, t) for k, t in enumerate(texts)]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])
    con = duckdb.connect()
    con.register("documents", documents)
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    by_sql = con.sql(ORACLES["op9_license_scans"])
    order = [by_sql.columns.index(c) for c in got.columns]
    same(got, [tuple(r[k] for k in order) for r in by_sql.fetchall()])


BOOST = "Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license"
WRAPPED = {
    "mit": "Copyright (c) 2020 Somebody\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction",
    "apache": "# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0",
    "gpl": " * you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation; either version 3",
    "bsd": "Redistribution and use in source and binary forms, with or without\r\nmodification, are permitted provided that the following conditions are met:",
}


def test_notices_match_across_line_breaks_and_not_across_long_lines(spark):
    filler = "some words that no notice holds and then some other words follow here "
    scattered = filler.join(["Released ", "under ", "the ", "MIT ", "License "])
    rows = [(k, text) for k, text in enumerate(WRAPPED.values())] + [(10 + k, f"{filler * 40}\n{text}\n{filler * 40}") for k, text in enumerate(WRAPPED.values())]
    rows += [(20, scattered), (21, scattered.replace(" here ", " here\n"))]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{at + k: (label, 1.0) for at in (0, 10) for k, label in enumerate(WRAPPED)}, 20: ("", 0.0), 21: ("", 0.0)}


def test_neighbouring_licenses_get_their_own_labels(spark):
    creative = "This work is licensed under a Creative Commons {} 4.0 International License."
    expected = {
        "Licensed under CC BY 4.0.": "cc-by", "Licensed under CC BY-SA 4.0.": "cc-by-sa", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa", "Licensed under the Mozilla Public License, Version 2.0.": "mpl",
        "Licensed under the Apache License, Version 2.0.": "apache", "Licensed under the Eclipse Public License, Version 2.0.": "",
        BOOST: "bsl", creative.format("Attribution"): "cc-by", creative.format("Attribution-NonCommercial"): "cc-by-nc",
        creative.format("Attribution-\nShareAlike"): "cc-by-sa",
        "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
        "Released under the MIT License. Licensed under the Apache License, Version 2.0.": "apache,mit",
    }
    rows = list(enumerate(expected))
    got = {rows[r["doc_id"]][1]: r["labels"] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected


def test_packing_holds_every_token_once(docs, none):
    library = load_tokenizer(tokenizer_path("word_bpe_49k.json"))
    got = packing.packed(docs).collect()
    expected = []
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        expected += [(i, n, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())) for n, at in enumerate(range(0, len(ids), 2048))]
    assert Counter(tuple(r)[:5] for r in got) == Counter(expected)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) == -(-sum(r["length"] for r in got) // 2048)
    assert packing.packed(none).count() == 0


def optimum(items: list[int], capacity: int) -> int:
    best = len(items)

    def place(k: int, bins: list[int]) -> None:
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for b in {x: n for n, x in enumerate(bins) if x + items[k] <= capacity}.values():
            bins[b] += items[k]
            place(k + 1, bins)
            bins[b] -= items[k]
        place(k + 1, [*bins, items[k]])

    place(0, [])
    return best


def test_dominance_never_costs_a_sequence():
    rng = random.Random(11)
    for _ in range(150):
        capacity = rng.randint(8, 30)
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        fixed, rest = packing.dominance(dict(Counter(items)), capacity)
        left = sorted(Counter(rest).elements(), reverse=True)
        assert sorted([s for p, n in fixed for s in p * n] + left) == sorted(items) and all(sum(p) <= capacity for p, _ in fixed)
        assert sum(n for _, n in fixed) + optimum(left, capacity) == optimum(items, capacity)
        whole = packing.plan(dict(Counter(items)), capacity)
        assert sorted(s for p, n in whole for s in p * n) == sorted(items) and all(sum(p) <= capacity for p, _ in whole)
