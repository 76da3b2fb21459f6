"""Saved searches kept as a table, many of them: an index of predicates instead of a pair for every row and search.

Searches of a travel key are dealt into blocks of bounded size. For each bound that a search may set (longest trip, highest
and lowest price, ...) a block keeps the bounds that occur, in order, and for every interval between two of them a bitmap of
the searches that admit a value there; for property types and flags one bitmap per value. What a row's values admit is
found by binary search and ANDed: nine bitmaps per row and block, whatever the number of searches, and only hits come out.

Rows of a travel key are spread over ``SALTS`` partitions per block, each with the block's index beside it. Only the tested
columns and a row number are shuffled; :func:`match_search_index` joins the hits back to the rows.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Searches of one block (expected), partitions that share the rows of a block, rows tested side by side.
BLOCK, SALTS, TOGETHER = 4096, 16, 2048

#: Searches of one block whose rows are only counted (expected), cells of a grid, legs or cells worked on at once.
TOTALS_BLOCK, CELLS, AT_ONCE = 1 << 20, 1 << 20, 1 << 18
#: Tasks that few searches are dealt to, slabs of a travel key at most, distinct bounds and names known to all tasks at most.
TASKS, SLABS, KNOWN, NAMES = 24, 256, 1 << 18, 1 << 10
#: What a copy of a search and of its total weighs, in folded legs.
COPY = 3
_NONE = np.iinfo(np.int64).max
#: Rows of a kind that stand in one place, packed in runs of so many places.
CELL, BLOB = np.dtype([("minutes", "f8"), ("price", "f8"), ("unpriced", "i8"), ("n", "i8"), ("row_no", "i8")]), 128
_NARROW = ("beds", "baths", "car_spaces")

#: (column of the row, bound of the search, admitted while the value is at most the bound).
BOUNDS = (
    ("minutes", "max_minutes", True), ("price_pw", "max_price_pw", True), ("price_pw", "min_price_pw", False), ("beds", "max_beds", True),
    ("beds", "min_beds", False), ("baths", "min_baths", False), ("car_spaces", "min_car_spaces", False),
)
#: A search without this bound admits nothing; without any other, everything.
REQUIRED = "max_minutes"


def _bitmap(members: np.ndarray) -> np.ndarray:
    return np.packbits(members, axis=-1)


class Intervals:
    """The bounds of one kind in order and the searches that admit each interval between them."""

    def __init__(self, bounds: list[float | None], at_most: bool, required: bool):
        known = np.array([b is not None for b in bounds])
        values = np.array([np.nan if b is None else b for b in bounds])
        self.at_most, self.cuts = at_most, np.unique(values[known])
        opened = ~known & (not required)
        place = np.searchsorted(self.cuts, values)
        steps = np.arange(len(self.cuts) + 1)[:, None]
        # Interval i holds the values above cut i-1 and up to cut i (from cut i-1 and below cut i for lower bounds).
        admitted = (place >= steps) if at_most else (place < steps)
        self.bitmaps = _bitmap(np.vstack([opened | (known & admitted), opened]))

    def admit(self, values: np.ndarray, null: np.ndarray) -> np.ndarray:
        """A bitmap per value; the last one is for nulls."""
        at = np.searchsorted(self.cuts, values, "left" if self.at_most else "right")
        return self.bitmaps[np.where(null, len(self.cuts) + 1, at)]


class Members:
    """Bitmaps of the searches that name a value, and of those that name any."""

    def __init__(self, named: list[list[str | None] | None]):
        self.n = len(named)
        holders: dict[str | None, list[int]] = {}
        for k, values in enumerate(named):
            for value in set(values or []):
                holders.setdefault(value, []).append(k)
        self.of = {value: self._of(at) for value, at in holders.items()}
        self.some = self._of([k for k, values in enumerate(named) if values])
        self.silent = self._of([k for k, values in enumerate(named) if values is None])

    def _of(self, at: list[int]) -> np.ndarray:
        out = np.zeros(self.n, bool)
        out[at] = True
        return _bitmap(out)


class Block:
    """The index of one block of searches."""

    def __init__(self, searches: list[dict]):
        self.positions = np.array([s["position"] for s in searches], np.int32)
        self.ids = pa.array([s["search_id"] for s in searches], pa.string())
        self.bounds = [(column, Intervals([s[bound] for s in searches], at_most, bound == REQUIRED)) for column, bound, at_most in BOUNDS]
        self.types = Members([s["property_types"] for s in searches])
        self.flags = Members([s["exclude_flagged"] for s in searches])

    def hits(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """(row_no, position, search_id) of every search that a row answers."""
        for first in range(0, rows.num_rows, TOGETHER):
            part = rows.slice(first, TOGETHER)
            admitted = None
            for column, intervals in self.bounds:
                values = part.column(column)
                found = intervals.admit(values.fill_null(0).to_numpy(zero_copy_only=False), values.is_null().to_numpy(zero_copy_only=False))
                admitted = found if admitted is None else admitted & found
            admitted = admitted & self._types(part.column("property_type")) & ~self._refused(part.column("flags"))
            row, search = np.nonzero(np.unpackbits(admitted, axis=1, count=len(self.positions)))
            yield pa.RecordBatch.from_arrays([part.column("row_no").take(pa.array(row)), pa.array(self.positions[search]), self.ids.take(pa.array(search))], ["row_no", "position", "search_id"])

    def _types(self, column: pa.Array) -> np.ndarray:
        coded = column.dictionary_encode()
        none = self.types.silent
        admits = np.array([none | self.types.of.get(v, 0) for v in coded.dictionary.to_pylist()] + [none], np.uint8)
        return admits[coded.indices.fill_null(len(admits) - 1).to_numpy(zero_copy_only=False)]

    def _refused(self, column: pa.Array) -> np.ndarray:
        """Searches that exclude a flag of the row. A null among the flags, or among the excluded ones where there are
        flags, leaves the comparison open, which admits nothing."""
        out = np.zeros((len(column), len(self.flags.some)), np.uint8)
        lengths = np.diff(column.offsets.to_numpy())
        if not lengths.any():
            return out
        coded = column.flatten().dictionary_encode()
        refuses = np.array([self.flags.of.get(v, np.zeros_like(self.flags.some)) for v in coded.dictionary.to_pylist()] + [self.flags.some], np.uint8)
        row = np.repeat(np.arange(len(column)), lengths)
        np.bitwise_or.at(out, row, refuses[coded.indices.fill_null(len(refuses) - 1).to_numpy(zero_copy_only=False)])
        if None in self.flags.of:
            out[lengths > 0] |= self.flags.of[None]
        return out


class Totals:
    """One block of searches, for how many rows answer each and the smallest row number among them.

    Rows come by kind: equal in all that few values tell apart (beds, type, flags, ...). The searches that admit a kind are
    found once; its rows are counted in a grid of their minutes and prices, and every search reads its rectangle off sums and
    minima along the grid. Where the grid would be too large, the rectangle is read off the levels of a tree over the prices.
    """

    def __init__(self, searches: pa.Table, cells: int):
        self.n, self.cells, self.ids = searches.num_rows, cells, searches.column("search_id")
        self.matched, self.first_no = np.zeros(self.n, np.int64), np.full(self.n, _NONE)
        number = lambda c: searches.column(c).to_numpy().astype(float, copy=False)
        self.unset = {bound: searches.column(bound).is_null().to_numpy() for _, bound, _ in BOUNDS}
        #: Distinct bounds in order, and the place of each search's bound among them.
        self.cuts, self.place = {}, {}
        for _, bound, _ in BOUNDS:
            values, set_ = number(bound), ~self.unset[bound]
            self.cuts[bound] = np.unique(values[set_])
            self.place[bound] = np.searchsorted(self.cuts[bound], np.where(set_, values, 0.0)).astype(np.int32)
        self.types, self.type_codes = self._lists(searches.column("property_types"))
        self.flags, self.flag_codes = self._lists(searches.column("exclude_flagged"))
        self.known: dict[tuple, np.ndarray] = {}

    @staticmethod
    def _lists(column: pa.ChunkedArray) -> tuple[list[list[str | None] | None], np.ndarray]:
        coded = column.combine_chunks().dictionary_encode("encode")
        return [None if v is None else json.loads(v) for v in coded.dictionary.to_pylist()], coded.indices.to_numpy(zero_copy_only=False)

    def _bits(self, key: tuple, found: Callable[[], np.ndarray]) -> np.ndarray:
        if key not in self.known:
            if len(self.known) >= 64:
                self.known.clear()
            self.known[key] = _bitmap(found())
        return self.known[key]

    def _bound(self, bound: str, value: float | None, at_most: bool) -> np.ndarray:
        if value is None:
            return self.unset[bound]
        at = np.searchsorted(self.cuts[bound], value, "left" if at_most else "right")
        return self.unset[bound] | ((self.place[bound] >= at) if at_most else (self.place[bound] < at))

    def _naming(self, lists: list, codes: np.ndarray, test: Callable[[list | None], bool]) -> np.ndarray:
        return np.array([test(names) for names in lists], bool)[codes]

    def admitted(self, kind: dict) -> np.ndarray:
        """Places of the searches that admit a kind."""
        of = kind["property_type"]
        out = self._bits(("type", of), lambda: self._naming(self.types, self.type_codes, lambda names: names is None or (of is not None and of in names)))
        for column, bound, at_most in BOUNDS:
            if column in _NARROW:
                value = kind[column]
                out = out & self._bits((bound, value), lambda: self._bound(bound, value, at_most))  # noqa: B023
        # A null among the flags, or among the excluded ones where there are flags, leaves the comparison open.
        for flag in {*kind["flags"], *([""] if kind["flagged"] else [])}:
            test = (lambda names: bool(names)) if flag is None else (lambda names: bool(names) and (flag or None) in names)  # noqa: B023,E731
            out = out & ~self._bits(("flag", flag), lambda: self._naming(self.flags, self.flag_codes, test))  # noqa: B023
        return np.flatnonzero(np.unpackbits(out, count=self.n))

    def add(self, kind: dict, minutes: np.ndarray, price: np.ndarray, unpriced: np.ndarray, n: np.ndarray, row_no: np.ndarray) -> None:
        """Add rows of a kind, ``n`` of them in each place given, to the totals of the searches they answer."""
        at = self.admitted(kind)
        times, prices = np.unique(minutes), np.unique(price[~unpriced])
        of = lambda bound: self.place[bound][at]
        upto = np.searchsorted(times, self.cuts[REQUIRED], "right")[of(REQUIRED)]
        open_low, open_high = self.unset["min_price_pw"][at], self.unset["max_price_pw"][at]
        # A bound of no search, for those that set none.
        first = np.append(np.searchsorted(prices, self.cuts["min_price_pw"], "left"), 0)[np.where(open_low, -1, of("min_price_pw"))]
        last = np.append(np.searchsorted(prices, self.cuts["max_price_pw"], "right"), len(prices))[np.where(open_high, -1, of("max_price_pw"))]
        # Rows without a price stand in one column more, which only searches without a bound on it read.
        last = last + (open_low & open_high)
        some = (upto > 0) & (first < last)
        at, upto, first, last = at[some], upto[some], first[some], last[some]
        row, column = np.searchsorted(times, minutes), np.where(unpriced, len(prices), np.searchsorted(prices, price))
        read = self._grid if len(times) * (len(prices) + 1) <= self.cells else self._tree
        read(row, column, n, row_no, (len(times), len(prices) + 1), at, upto, first, last)

    def _grid(self, row, column, n, row_no, shape, at, upto, first, last) -> None:
        sums, least = np.zeros((shape[0] + 1, shape[1] + 1), np.int64), np.full(shape, _NONE)
        np.add.at(sums, (row + 1, column + 1), n)
        np.minimum.at(least, (row, column), row_no)
        np.cumsum(np.cumsum(sums, axis=0, out=sums), axis=1, out=sums)
        found = sums[upto, last] - sums[upto, first]
        some = found > 0
        at, upto, first, last, found = at[some], upto[some] - 1, first[some], last[some] - 1, found[some]
        self.matched[at] += found
        # Minima of runs of 1, 2, 4, ... columns: two of them cover any range.
        runs, size = np.minimum.accumulate(least, axis=0), 1
        while len(at):
            mine = (last - first + 1) < 2 * size
            place = at[mine]
            self.first_no[place] = np.minimum(self.first_no[place], np.minimum(runs[upto[mine], first[mine]], runs[upto[mine], last[mine] - size + 1]))
            at, upto, first, last = (x[~mine] for x in (at, upto, first, last))
            if len(at):
                runs, size = np.minimum(runs[:, :-size], runs[:, size:]), 2 * size

    def _tree(self, row, column, n, row_no, shape, at, upto, first, last) -> None:
        """Nodes of a level hold runs of 1, 2, 4, ... rows in the order of prices, each by minutes; a search reads the start of
        two nodes a level at most. One level is in memory at a time."""
        order = np.argsort(column, kind="stable")
        row, n, row_no, column = row[order], n[order], row_no[order], column[order]
        left, right = np.searchsorted(column, first), np.searchsorted(column, last)
        node, by, level = np.arange(len(row)), np.argsort(row, kind="stable"), 0
        while True:
            # By node, within it by minutes: the order by minutes, stably sorted by node.
            here = by[np.argsort(node[by] >> level, kind="stable")]
            keys = (node[here] >> level) * (shape[0] + 1) + row[here]
            counts, least = np.append(0, np.cumsum(n[here])), _least_of_runs(node[here] >> level, row_no[here])
            open_ = left < right
            if not open_.any():
                return
            for side, nodes in ((open_ & (left & 1 == 1), left), (open_ & (right & 1 == 1), right - 1)):
                which = np.flatnonzero(side)
                start = np.minimum(nodes[which] << level, len(row))
                end = np.searchsorted(keys, nodes[which] * (shape[0] + 1) + upto[which])
                some = end > start
                which, start, end = at[which[some]], start[some], end[some]
                self.matched[which] += counts[end] - counts[start]
                self.first_no[which] = np.minimum(self.first_no[which], least[end - 1])
            left, right, level = np.where(open_, (left + 1) >> 1, left), np.where(open_, right >> 1, right), level + 1

    def totals(self) -> Iterator[pa.RecordBatch]:
        found = np.flatnonzero(self.matched)
        for start in range(0, len(found), 1 << 16):
            part = found[start : start + (1 << 16)]
            ids = self.ids.take(pa.array(part)).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array(self.matched[part]), pa.array(self.first_no[part], mask=self.first_no[part] == _NONE)], ["search_id", "matched", "first_no"])


def _least_of_runs(run: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The smallest value of a run so far; ``run`` does not fall."""
    out, size, starts = values.copy(), 1, np.searchsorted(run, run)
    place = np.arange(len(run))
    longest = int((place - starts).max(initial=0))
    while size <= longest:
        reach = np.flatnonzero(place - size >= starts)
        out[reach] = np.minimum(out[reach], out[reach - size])
        size *= 2
    return out


_CONFIG = ["position", "search_id", "travel_key", *[bound for _, bound, _ in BOUNDS], "property_types", "exclude_flagged"]
_TESTED = ["row_no", *dict.fromkeys(column for column, _, _ in BOUNDS), "property_type", "flags"]
_CELL = ["travel_key", "block", "salt"]


def predicate_index(config: DataFrame, block: int = BLOCK) -> DataFrame:
    """(travel_key, block, index): one row per block of searches (see ``searches.searches_frame`` for ``config``)."""
    bounds = [F.col(bound).cast("double").alias(bound) for _, bound, _ in BOUNDS]
    plain = config.select("position", "search_id", "travel_key", *bounds, "property_types", "exclude_flagged").where("travel_key is not null")
    blocks = plain.groupBy("travel_key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = plain.join(blocks, "travel_key").withColumn("block", F.pmod(F.xxhash64("search_id", "position"), F.col("blocks")).cast("int"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, searches = None, []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([pickle.dumps(Block(searches))], pa.binary())], ["travel_key", "block", "index"])

        for batch in batches:
            for search in batch.to_pylist():
                if (search["travel_key"], search["block"]) != key:
                    if searches:
                        yield done()
                    key, searches = (search["travel_key"], search["block"]), []
                searches.append(search)
        if searches:
            yield done()

    placed = dealt.select(*_CONFIG, "block").repartition("travel_key", "block").sortWithinPartitions("travel_key", "block")
    return placed.mapInArrow(read, "travel_key string, block int, index binary")


def search_hits(rows: DataFrame, index: DataFrame) -> DataFrame:
    """(row_no, position, search_id): exactly the pairs that match. ``rows``: row_no, travel (a map of legs by travel key),
    price_pw, beds, baths, car_spaces, property_type, flags. ``index``: a written :func:`predicate_index`."""
    legs = rows.select("row_no", F.explode("travel").alias("travel_key", "leg"), "price_pw", "beds", "baths", "car_spaces", "property_type", "flags")
    numbers = [F.col(c).cast("double").alias(c) for c in ("price_pw", "beds", "baths", "car_spaces")]
    tested = legs.select(
        "travel_key", F.lit(None).cast("binary").alias("index"), "row_no", F.col("leg.minutes").cast("double").alias("minutes"), *numbers, "property_type",
        F.coalesce("flags", F.array().cast("array<string>")).alias("flags"), F.pmod(F.xxhash64("row_no"), F.lit(SALTS)).cast("int").alias("salt"),
    ).where("minutes is not null")
    asked = tested.join(index.select("travel_key", "block"), "travel_key")
    blank = [F.lit(None).cast(t).alias(c) for c, t in tested.drop("travel_key", "index", "salt").dtypes]
    kept = index.select("travel_key", "index", *blank, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "block")
    dealt = kept.unionByName(asked).repartition(*_CELL).sortWithinPartitions(*_CELL, F.col("index").isNull())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            heads = np.flatnonzero(batch.column("index").is_valid().to_numpy(zero_copy_only=False)).tolist()
            for start, end in zip([0, *heads], [*heads, batch.num_rows]):
                if start == end:
                    continue
                if start in heads:
                    block, start = pickle.loads(batch.column("index")[start].as_py()), start + 1
                yield from block.hits(batch.slice(start, end - start))

    return dealt.mapInArrow(read, "row_no long, position int, search_id string")


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= AT_ONCE:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _folded(cells: np.ndarray, kind: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Cells of equal kind, minutes and price as one, in that order, and their kinds."""
    columns = [np.broadcast_to(kind, len(cells)), *(cells[c].copy() for c in ("minutes", "unpriced", "price"))]
    order = np.lexsort(columns[::-1])
    if not len(cells):
        return cells, columns[0]
    new = np.ones(len(cells), bool)
    columns = [c[order] for c in columns]
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    starts = np.flatnonzero(new)
    out = cells[order[starts]]
    out["n"], out["row_no"] = np.add.reduceat(cells["n"][order], starts), np.minimum.reduceat(cells["row_no"][order], starts)
    return out, columns[0][starts]


def _blobs(cells: np.ndarray) -> Iterator[bytes]:
    """Column by column, small ones: Spark hands Python a number of rows at once, not of bytes."""
    for start in range(0, len(cells), BLOB):
        part = cells[start : start + BLOB]
        yield b"".join(part[c].tobytes() for c in CELL.names)


def _cells(blob: bytes) -> np.ndarray:
    n = len(blob) // (8 * len(CELL.names))
    out = np.empty(n, CELL)
    for k, c in enumerate(CELL.names):
        out[c] = np.frombuffer(blob, CELL[c], n, 8 * n * k)
    return out


def _runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, list[bytes]]]:
    """Blobs that follow each other with the same key, of ``AT_ONCE`` cells and no more than a few beyond."""
    held, blobs, size = None, [], 0
    for batch in batches:
        for *at, blob in zip(*(batch.column(c).to_pylist() for c in [*key, "blob"])):
            if blobs and (at != held or size >= 8 * len(CELL.names) * AT_ONCE):
                yield tuple(held), blobs
                blobs, size = [], 0
            held, size = at, size + len(blob)
            blobs.append(blob)
    if blobs:
        yield tuple(held), blobs


class Cuts:
    """The distinct bounds on minutes and on prices of a travel key: rows between the same ones are alike to its searches."""

    def __init__(self, times: list[float], prices: list[float]):
        self.times, self.prices = np.unique(np.array(times, float)), np.unique(np.array(prices, float))
        # For each bound the bound, and for what lies above it a number that does; NaN is above all.
        between = np.append(np.nextafter(self.prices, np.inf)[:-1], np.nan) if len(self.prices) else self.prices
        self.stand_in = np.append(-np.inf, np.stack([self.prices, between], axis=1).ravel())

    def alike(self, cells: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cells in these numbers, without those that last longer than any search allows, and their kinds."""
        at = np.searchsorted(self.times, cells["minutes"].copy())
        short = at < len(self.times)
        cells, kind = cells[short], kind[short]
        price = cells["price"].copy()
        cells["minutes"] = self.times[at[short]]
        cells["price"] = np.where(cells["unpriced"] > 0, 0, self.stand_in[np.searchsorted(self.prices, price, "left") + np.searchsorted(self.prices, price, "right")])
        return cells, kind


class Slabs:
    """Cells of a travel key of very many searches, each with a part of the rows and of the searches. The rows a search admits
    lie in the slab of prices of its lowest price, in that of its highest, and in whole slabs between them. Cells of the first
    kind hold a slab of prices; cells of the second a slab of minutes, where a row's price is the number of its slab and the
    rows of all shorter slabs are folded by it. So rows come twice and searches three times, however many there are."""

    def __init__(self, times: list[float], prices: list[float]):
        self.times, self.prices = np.unique(np.array(times, float)), np.unique(np.array(prices, float))

    def rows(self, cells: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        slab = np.searchsorted(self.prices, cells["price"], "right")
        priced = cells["unpriced"] == 0
        yield from _split(cells[priced], slab[priced])
        coarse, at = cells.copy(), np.searchsorted(self.times, cells["minutes"])
        coarse["price"] = np.where(priced, slab, 0)
        yield from _split(coarse, at + len(self.prices) + 1)
        shorter = coarse[:0]
        for q in range(1, len(self.times) + 1):
            new = coarse[at == q - 1]
            new["minutes"] = -np.inf
            shorter, _ = _folded(np.concatenate([shorter, new]))
            if len(shorter):
                yield len(self.prices) + 1 + q, shorter

    def searches(self, searches: pa.Table) -> Iterator[tuple[int, pa.Table]]:
        number = lambda c: searches.column(c).to_numpy().astype(float, copy=False)
        low, high = (~searches.column(c).is_null().to_numpy() for c in ("min_price_pw", "max_price_pw"))
        first, last = (np.searchsorted(self.prices, number(c), "right") for c in ("min_price_pw", "max_price_pw"))
        at = np.searchsorted(self.times, number(REQUIRED)) + len(self.prices) + 1
        one, two = low & high & (first == last), ~(low & high) | (first < last)
        between = two & ~(low & high & (first + 1 > last - 1)) & ~(high & (last < 1)) & ~(low & (first >= len(self.prices)))
        none = np.full(searches.num_rows, np.nan)
        for some, cell, least, most in (
            (one, first, number("min_price_pw"), number("max_price_pw")), (two & low, first, number("min_price_pw"), none), (two & high, last, none, number("max_price_pw")),
            (between, at, np.where(low, first + 1.0, np.nan), np.where(high, last - 1.0, np.nan)),
        ):
            unset = {"min_price_pw": ~low | (least is none), "max_price_pw": ~high | (most is none)}
            part = searches
            for c, values in (("min_price_pw", least), ("max_price_pw", most)):
                part = part.set_column(part.schema.get_field_index(c), c, pa.array(values, pa.float64(), mask=unset[c]))
            yield from _split(part, cell, np.flatnonzero(some))


def _split(rows: np.ndarray | pa.Table, cell: np.ndarray, some: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray | pa.Table]]:
    some = np.arange(len(cell)) if some is None else some
    some = some[np.argsort(cell[some], kind="stable")]
    starts = np.flatnonzero(np.diff(cell[some], prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(some)]):
        at = some[start:end]
        yield int(cell[at[0]]), rows.take(pa.array(at)) if isinstance(rows, pa.Table) else rows[at]


def _strings(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in types.items()], list(types))


def _names(config: DataFrame, column: str) -> list[str | None] | None:
    """What the lists of a column name, unless it is very much."""
    found = [r["n"] for r in config.select(F.explode(column).alias("n")).distinct().limit(NAMES + 1).collect()]
    return found if len(found) <= NAMES else None


def search_totals(rows: DataFrame, config: DataFrame, block: int = TOTALS_BLOCK, cells: int = CELLS, spread: int = 6) -> DataFrame:
    """(search_id, matched, first_no): how many legs of ``rows`` answer the searches of that id, and the smallest row number
    among them; searches without an answer are left out. The totals of :func:`search_hits`, without a row for every hit: the
    work grows with rows, searches and kinds of rows, not with the hits. ``rows`` and ``config`` as there.

    Legs that no bound tells apart are folded before they are shuffled, while the distinct bounds are few enough for every
    task to know. Folded legs meet the searches of their travel key in blocks, or in :class:`Slabs` once copies of the legs
    for every block would outweigh ``spread`` times the searches; both are packed before a shuffle."""
    number = lambda c: F.col(c).cast("double").alias(c)
    asked = config.select(
        F.col("search_id").cast("string").alias("search_id"), "travel_key", *[number(bound) for _, bound, _ in BOUNDS],
        F.to_json("property_types").alias("property_types"), F.to_json("exclude_flagged").alias("exclude_flagged"),
    ).where(f"travel_key is not null and {REQUIRED} is not null")
    measured = [REQUIRED, "min_price_pw", "max_price_pw"]
    per_key = asked.groupBy("travel_key").agg(F.count("*").alias("n"), sum(F.approx_count_distinct(b) for b in measured).alias("bounds"))
    stats = per_key.agg(F.sum("bounds").alias("bounds"), F.collect_list(F.when(F.col("n") > block, F.struct("travel_key", "n"))).alias("large")).first()
    cuts: dict[str, Cuts] | None = None
    if (stats["bounds"] or 0) <= KNOWN:
        values: dict[str, tuple[list, list]] = {}
        entries = F.explode(F.array(*[F.struct(F.lit(b == REQUIRED).alias("time"), F.col(b).alias("value")) for b in measured])).alias("e")
        for r in asked.select("travel_key", entries).select("travel_key", "e.*").where("value is not null").distinct().collect():
            values.setdefault(r["travel_key"], ([], []))[0 if r["time"] else 1].append(r["value"])
        cuts = {key: Cuts(*found) for key, found in values.items()}

    # Of types and flags only those that a search names tell kinds apart.
    types, flags = _names(config, "property_types"), _names(config, "exclude_flagged")
    named = lambda known, c: F.lit(True) if known is None else c.isin([v for v in known if v is not None])
    carried = F.coalesce("flags", F.array().cast("array<string>"))
    nulls = F.lit(flags is None or None in flags)
    kind = F.struct(
        *[number(c) for c in _NARROW], F.when(named(types, F.col("property_type")), F.col("property_type")).alias("property_type"),
        F.array_sort(F.array_distinct(F.filter(carried, lambda f: f.isNull() | named(flags, f)))).alias("flags"), (nulls & (F.size(carried) > 0)).alias("flagged"),
    )
    told = rows.select(F.col("row_no").cast("long").alias("row_no"), "travel", number("price_pw"), F.to_json(kind, {"ignoreNullFields": "false"}).alias("kind"))
    legs = told.select("row_no", F.explode("travel").alias("travel_key", "leg"), "price_pw", "kind")
    tested = legs.select("travel_key", "kind", F.col("leg.minutes").cast("double").alias("minutes"), "price_pw", "row_no").where("minutes is not null")
    of_cells = {"travel_key": pa.string(), "kind": pa.string(), "blob": pa.binary(), "n": pa.int64()}
    ddl = "travel_key string, kind string, blob binary, n long"

    def packed(key: str, kind: str, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        blobs = list(_blobs(found))
        if blobs:
            sizes = [len(b) // (8 * len(CELL.names)) for b in blobs]
            yield _strings({"travel_key": [key] * len(blobs), "kind": [kind] * len(blobs), "blob": blobs, "n": sizes}, of_cells)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(batches):
            keys, kinds = (table.column(c).combine_chunks().dictionary_encode() for c in ("travel_key", "kind"))
            found = np.empty(table.num_rows, CELL)
            found["minutes"], found["price"] = table.column("minutes").to_numpy(), table.column("price_pw").fill_null(0).to_numpy()
            found["unpriced"], found["n"], found["row_no"] = table.column("price_pw").is_null().to_numpy(), 1, table.column("row_no").fill_null(_NONE).to_numpy()
            of, names = kinds.indices.to_numpy(), kinds.dictionary.to_pylist()
            for code, at in _split(np.arange(len(found)), keys.indices.to_numpy()):
                key, own = keys.dictionary[code].as_py(), (found[at], of[at])
                if cuts is not None:
                    if key not in cuts:
                        continue
                    own = cuts[key].alike(*own)
                own, told = _folded(*own)
                for code, part in _split(own, told):
                    yield from packed(key, names[code], part)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, of), blobs in _runs(batches, ["travel_key", "kind"]):
            yield from packed(key, of, _folded(np.concatenate([_cells(b) for b in blobs]))[0])

    one = ["travel_key", "kind"]
    folded = cut_lineage(tested.mapInArrow(pack, ddl).repartition(*one).sortWithinPartitions(*one).mapInArrow(fold, ddl))
    answered = F.broadcast(folded.select("travel_key").distinct())

    # Which travel keys go in slabs.
    slabs: dict[str, Slabs] = {}
    large = {r["travel_key"]: r["n"] for r in stats["large"]}
    if large:
        sizes = {r["travel_key"]: r["n"] for r in folded.where(F.col("travel_key").isin(list(large))).groupBy("travel_key").agg(F.sum("n").alias("n")).collect()}
        blocks = {key: -(-n // block) for key, n in large.items()}
        wide = [key for key, n in sizes.items() if n * (blocks[key] - 2) > spread * large[key]]  # copies for blocks, or two of legs and two more of searches
        if wide:
            parts = F.array(*[F.lit(k / SLABS) for k in range(1, SLABS)])
            cut_at = asked.where(F.col("travel_key").isin(wide)).groupBy("travel_key").agg(*[F.percentile_approx(b, parts, 10_000).alias(b) for b in measured])
            for r in cut_at.collect():
                thin = lambda values, n: (values or [])[:: max(1, SLABS // n)]
                n = min(SLABS, max(4, blocks[r["travel_key"]]))
                slabs[r["travel_key"]] = Slabs(thin(r[REQUIRED], n), [*thin(r["min_price_pw"], n // 2), *thin(r["max_price_pw"], n // 2)])

    chunk = max(1, min(4096, block // 16))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tables(batches):
            keys = table.column("travel_key").combine_chunks().dictionary_encode()
            for code, own in _split(table.drop_columns(["travel_key"]), keys.indices.to_numpy()):
                key = keys.dictionary[code].as_py()
                for cell, part in slabs[key].searches(own) if key in slabs else [(0, own)]:
                    for start in range(0, part.num_rows, chunk):
                        searches, sink = part.slice(start, chunk).combine_chunks(), pa.BufferOutputStream()
                        with pa.ipc.new_stream(sink, searches.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                            writer.write_table(searches)
                        yield _strings({"travel_key": [key], "cell": [cell], "blob": [sink.getvalue().to_pybytes()], "n": [searches.num_rows]}, {"travel_key": pa.string(), "cell": pa.int32(), "blob": pa.binary(), "n": pa.int64()})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, of), blobs in _runs(batches, one):
            for cell, found in slabs[key].rows(np.concatenate([_cells(b) for b in blobs])):
                for batch in packed(key, of, found):
                    yield batch.append_column("cell", pa.array([cell] * batch.num_rows, pa.int32()))

    searches = cut_lineage(asked.join(answered, "travel_key", "left_semi").select(asked.columns).mapInArrow(deal, "travel_key string, cell int, blob binary, n long"))
    blocks = searches.groupBy("travel_key", "cell").agg(F.sum("n").alias("n"), F.count("*").alias("chunks"), F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    tasks, places, asking = blocks.agg(F.sum("blocks"), F.count("*"), F.sum("n")).first()
    tasks, places, groups = tasks or 1, places or 1, 1
    if tasks < TASKS:
        # Few searches: more blocks copy legs, groups of kinds copy searches and their totals; the lighter of both.
        standing = folded.agg(F.sum("n")).first()[0] or 0
        least = min((1, 2, 4, 8, 16, 32), key=lambda k: standing * max(k, tasks // places) + COPY * (asking or 0) * max(1, TASKS // (places * k)))
        blocks = blocks.withColumn("blocks", F.greatest("blocks", F.least(F.lit(least), (F.col("chunks") / 16).cast("int"))))
        tasks = blocks.agg(F.sum("blocks")).first()[0] or 1
        groups = max(1, TASKS // tasks)
    blocks = F.broadcast(blocks.drop("n", "chunks"))
    kept = searches.join(blocks, ["travel_key", "cell"]).select(
        "travel_key", "cell", F.pmod(F.xxhash64("blob"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("salt"), F.lit(None).cast("string").alias("kind"), "blob",
    )
    legs = folded.withColumn("cell", F.lit(0))
    if slabs:
        wide = F.col("travel_key").isin(list(slabs))
        legs = legs.where(~wide).unionByName(folded.where(wide).mapInArrow(place, f"{ddl}, cell int"))
    met = legs.join(blocks, ["travel_key", "cell"]).select(
        "travel_key", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("kind"), F.lit(groups)).cast("int").alias("salt"), "kind", "blob",
    )
    at = ["travel_key", "cell", "block", "salt"]
    dealt = kept.unionByName(met).repartition(min(4096, max(8, 2 * tasks * groups)), *at).sortWithinPartitions(*at, F.col("kind").asc_nulls_first())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chunks, totals = None, [], None
        for (*here, of), blobs in _runs(batches, [*at, "kind"]):
            if here != key:
                if totals is not None:
                    yield from totals.totals()
                key, chunks, totals = here, [], None
            if of is None:
                chunks += blobs
                continue
            if totals is None and not chunks:
                continue  # no chunk was dealt to this block
            if totals is None:
                totals, chunks = Totals(pa.concat_tables(pa.ipc.open_stream(b).read_all() for b in chunks), cells), []
            found, of = np.concatenate([_cells(b) for b in blobs]), json.loads(of)
            of |= {c: None if of[c] is None else float(of[c]) for c in _NARROW}
            totals.add(of, found["minutes"], found["price"], found["unpriced"] > 0, found["n"], found["row_no"])
        if totals is not None:
            yield from totals.totals()

    parts = dealt.mapInArrow(read, "search_id string, matched long, first_no long")
    return parts.groupBy("search_id").agg(F.sum("matched").alias("matched"), F.min("first_no").alias("first_no"))


def match_search_index(candidates: DataFrame, config: DataFrame, travel: str = "travel", block: int = BLOCK) -> DataFrame:
    """``candidates`` with ``matched_searches``, as ``searches.match_searches`` gives it, for searches that are rows."""
    number = "row_no"
    while number in candidates.columns:
        number += "_"
    # Written, so that a row keeps its number wherever it is read again.
    rows = cut_lineage(candidates.withColumn(number, F.monotonically_increasing_id()))
    tested = rows.select(F.col(number).alias("row_no"), F.col(travel).alias("travel"), "price_pw", "beds", "baths", "car_spaces", "property_type", "flags")
    hits = search_hits(tested, cut_lineage(predicate_index(config, block)))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("position", "search_id"))), lambda x: x["search_id"])
    matched = hits.groupBy(F.col("row_no").alias(number)).agg(listed.alias("matched_searches"))
    return rows.join(matched, number, "left").withColumn("matched_searches", F.coalesce("matched_searches", F.array().cast("array<string>"))).drop(number)
