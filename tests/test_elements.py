"""Documents read in byte ranges against the same documents read whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from listingflow.sources import caches, captures, elements
from test_sources import FLAT, GROUPED, leg, listing, store


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


TRICKY = ['a "quoted" } ] , word', "back\\slash\\", "\\\\\"", "{[", "é}—", "line\nbreak", "", "x" * 300, "\\" * 41]


def big(n, seed=5):
    """Passes whose texts hold brackets, quotes and runs of backslashes, missing and null fields."""
    rng = random.Random(seed)
    item = lambda i: listing(i, price=rng.choice(TRICKY), description=rng.choice(TRICKY) + rng.choice(TRICKY), images=rng.choices(TRICKY, k=2), travel=leg(i))
    group = lambda g: {
        "origin": rng.choice(TRICKY), "results": [item(i) if i % 7 else None for i in range(n)], "mode": "walk",
        "filtered_by_travel": [{"id": f"{g}-{i}", "url": rng.choice(TRICKY), "coords": {"lat": 1.5, "lng": i}, "travel": leg(9)} for i in range(3)],
    }
    return {"source": "a\\", "captured_at": "t", "groups": [group(0), {}, group(1), {"mode": "drive", "results": []}], "results": [listing(1)]}


def cut_locally(file, size, wanted, marks=()):
    """The passes over one file, without Spark."""
    length, inside, stack, said, out = file.stat().st_size, False, [], None, []
    for start in range(0, length, size):
        window = lambda: elements._Window(str(file.as_uri()), start, min(start + size, length))  # noqa: B023, E731
        out += elements._values(window(), inside, {"stack": stack, "said": said}, wanted, marks)
        summary = elements._summary(window(), inside)
        stack = elements._after(stack, said, start > 0, summary, file.name)
        said = said if summary["idle"] else summary["said"]
        inside ^= elements._quotes(window()) % 2 == 1
    assert stack == [] and not inside
    return [(path, text) for path, _, text in out]


def test_every_size_of_range(tmp_path):
    body = {"a": TRICKY, **{t: {"k" * 9 + t: t, "n": [1.5, None, {}, [], [[]], True]} for t in TRICKY}, "z": {}}
    for indent in (None, 2):
        file = tmp_path / f"{indent}.json"
        file.write_text(json.dumps(body, indent=indent, ensure_ascii=False))
        for size in [*range(1, 20), 97, 1000, 5000]:
            found = cut_locally(file, size, [("*", "*"), ("*", "n", "*")], [("*",)])
            assert [(p, json.loads(t)) for p, t in found if len(p) == 2] == [([k, str(i)], v) for k, m in body.items() for i, v in (enumerate(m) if k == "a" else m.items())]
            assert [(p[0], json.loads(t)) for p, t in found if len(p) == 3] == [(k, v) for k in body for v in (body[k]["n"] if k in TRICKY else [])]
            assert [p for p, t in found if t is None] == [[k] for k in body]


@pytest.mark.parametrize("size", [90, 1000, 1 << 20])
def test_ranges_of_any_size_give_the_rows_of_the_whole_document(spark, tmp_path, size):
    n = 3 if size == 90 else 40
    path = store(tmp_path, a=json.dumps(big(n), ensure_ascii=False), b=json.dumps(big(2, 6), indent=1) + "\n", c=GROUPED, d=FLAT, e='{"source": "s", "results": [ ]}')
    ranges = elements.document_ranges(spark, path, size)
    whole = captures.read_captures(spark, path)
    assert ranges.count() >= 5 and rows(elements.capture_rows(ranges)) == rows(captures.capture_rows(whole))
    assert rows(elements.rejected_rows(ranges)) == rows(captures.rejected_rows(whole))


@pytest.mark.parametrize("size", [150, 4096])
def test_memo_documents(spark, tmp_path, size):
    body = {
        "routes": {f"k{i}\\\"}}": {"minutes": i, "km": 1.0} for i in range(30)},
        "geo": {t or "-": {"lat": i, "lng": 2.0, "precision": t, "at": 5} if i % 3 else None for i, t in enumerate(TRICKY)},
    }
    path = store(tmp_path, c=body)
    ranges, whole = elements.document_ranges(spark, path, size), caches.read_cache_documents(spark, path)
    assert rows(elements.cached(ranges, "geo")) == rows(caches.cached_positions(whole))
    assert rows(elements.cached(ranges, "routes")) == rows(caches.cached_routes(whole))


@pytest.mark.parametrize("body", ['{"a": [1, 2}', '{"a": [1', '{"a": "b', '{"a": 1}}', '{"a": 1} {"b": 2}', "[1, 2]]"])
@pytest.mark.parametrize("size", [4, 100])
def test_unclosed_documents_fail(spark, tmp_path, body, size):
    with pytest.raises(Exception, match="ends inside|not valid JSON|closes a bracket|goes on after"):
        elements.document_ranges(spark, store(tmp_path, a=body), size).count()


def test_values_that_do_not_fit_fail(spark, tmp_path):
    ranges = elements.document_ranges(spark, store(tmp_path, a='{"results": [{"id": "1"}, {"id" "2"}]}'), 10)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        elements.capture_rows(ranges).collect()


def test_empty_files_have_no_rows(spark, tmp_path):
    assert elements.capture_rows(elements.document_ranges(spark, store(tmp_path, a=""), 10)).count() == 0


def test_a_large_capture_is_read_by_many_tasks(spark, tmp_path):
    """One document of 32 MB; its ranges are balanced and give what the whole-file reader gives."""
    text = "words, \"quoted\" and {braced} " * 100
    with open(tmp_path / "big.json", "w") as out:
        out.write('{"source": "s", "captured_at": "t", "groups": [{"origin": "o", "mode": "walk", "results": [')
        for i in range(10_000):
            out.write((", " if i else "") + json.dumps(listing(i, description=text + str(i))))
        out.write("]}]}")
    ranges = elements.document_ranges(spark, str(tmp_path), 2 << 20)
    read, whole = elements.capture_rows(ranges), captures.capture_rows(captures.read_captures(spark, str(tmp_path)))
    tasks = elements.document_values(ranges, ["groups.*.results.*"]).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 12 and max(t["count"] for t in tasks) < 3_000
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(F.to_json(F.struct(*sorted(df.columns)))).cast("decimal(38,0)"))).first()
    assert digest(read) == digest(whole)
