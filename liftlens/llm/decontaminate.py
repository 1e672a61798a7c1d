"""Benchmark items inside documents, by greedy string tiling.

Words are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. A document is searched for
the seeds (word n-grams of the least tile length) of the benchmark; documents and items that
share seeds are tiled: the longest common run of words not yet marked, in either text, is found
by running Karp-Rabin hashing and marked, again and again, until none of the least length is
left. The order of the tiles does not matter, so reordered passages are caught. An item is
present if the tiles cover at least `COVERAGE` of its words.

The benchmark goes to the tasks in blocks of bounded size, one pass over the documents each; the
documents are not shuffled, and a task holds one batch of them.

Defined results: null and empty texts match nothing; an item with fewer words than the least
tile must occur whole; items without words never match; repeated items and documents give
repeated pairs, one for each row; very long texts are tiled whole, in time that grows with their length
for each different length of tiles; an empty table on either side gives no rows (and the filter keeps
every document if the benchmark is empty); columns other than item_id, doc_id and text are not read.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from liftlens.llm.common import by_batch, slices
from liftlens.llm.shingles import grams, word_hasher

MIN_TILE = 5
COVERAGE = 0.5
BLOCK_CHARS = 8_000_000  # of benchmark text that goes to the tasks at once
PLAIN = bytes(ord(chr(i).lower()) if chr(i).isalnum() or i > 127 else 32 for i in range(128)) \
    + bytes(range(128, 256))

SCHEMA = "doc_id long, item_id long, tiles int, covered int, item_words int, coverage double"


def tokens(text: str | None) -> list[bytes]:
    return text.encode().translate(PLAIN).split() if text else []


class Rolling:
    """Karp-Rabin hashes, modulo 2^64, of the runs of any number of words of a text: differences of
    its prefix sums, which are worked out once."""

    BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words, self.free = words, np.ones(n, bool)
        power = lambda base: np.cumprod(np.concatenate(
            [np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
        self.powers = power(self.BASE)
        down = power(pow(self.BASE, -1, 1 << 64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * down[:n])])

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the runs of n free words, and their hashes."""
        taken = np.concatenate([[0], np.cumsum(~self.free)])
        at = np.flatnonzero(taken[n:] == taken[:-n])
        return at, (self.sums[at + n] - self.sums[at]) * self.powers[at]


def common_runs(a: Rolling, b: Rolling, n: int) -> tuple[list[int], dict[int, list[int]]]:
    """The runs of n words that are free in both texts: starts in `a`, and for each of them the
    starts in `b` by order, one list for equal runs. Hashes are confirmed word by word, by the first
    run of each."""
    (ia, ha), (ib, hb) = a.runs(n), b.runs(n)
    ib, hb = (x[np.isin(hb, ha)] for x in (ib, hb))
    where: dict[int, list[int]] = {}
    for j, h in zip(ib.tolist(), hb.tolist()):
        where.setdefault(h, []).append(j)
    starts, of = [], {}
    ok: dict[int, bool] = {}
    for i, h in zip(ia.tolist(), ha.tolist()):
        if h in where:
            if h not in ok:
                j = where[h][0]
                ok[h] = np.array_equal(a.words[i:i + n], b.words[j:j + n])
            if ok[h]:
                starts.append(i)
                of[i] = where[h]
    return starts, of


def tile(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in a, start in b, length), longest first, then first in a and b.

    Of one length, all tiles are taken in one pass: a run of `b` found marked stays so, and as
    all marks of the pass have this length, a run is free if its first and last words are. Then
    no common run of the length is left. So time grows with the lengths of both texts for each
    different length of tiles, also where one word repeats throughout."""
    x, y, tiles = Rolling(a), Rolling(b), []
    n = min(len(a), len(b))
    while n >= least:
        low, high = least - 1, n  # the longest common run, by bisection on its length
        while low < high:
            mid = (low + high + 1) // 2
            if common_runs(x, y, mid)[0]:
                low = mid
            else:
                high = mid - 1
        n = low
        if n < least:
            break
        starts, of = common_runs(x, y, n)
        passed: dict[int, int] = {}  # by list of equal runs, how many of it are marked
        for i in starts:
            if not (x.free[i] and x.free[i + n - 1]):
                continue
            places = of[i]
            at = passed.get(id(places), 0)
            while at < len(places) and not (y.free[places[at]] and y.free[places[at] + n - 1]):
                at += 1
            passed[id(places)] = at
            if at < len(places):
                j = places[at]
                tiles.append((i, j, n))
                x.free[i:i + n] = False
                y.free[j:j + n] = False
        n -= 1
    return tiles


class Benchmark:
    """Items of one block: their words and the seeds that lead to them."""

    def __init__(self, items: list[tuple[int, str | None]], least: int):
        self.least = least
        hasher = word_hasher()
        self.items = []
        seeds = defaultdict(set)
        self.words: dict[bytes, int] = {}  # all other words count as 0
        for item_id, text in items:
            own = tokens(text)
            hashes = hasher.array(own)
            if len(hashes):
                self.words.update(zip(own, hashes.tolist()))
                n = min(least, len(hashes))
                for g in grams(hashes, n).tolist():
                    seeds[n, g].add(len(self.items))
                self.items.append((item_id, hashes))
        self.seeds = dict(seeds)
        self.lengths = sorted({n for n, _ in self.seeds})

    def find(self, text: str | None, coverage: float):
        """(item_id, tiles, covered words, words) of the items present in the text."""
        own = tokens(text)
        doc = np.fromiter(map(self.words.get, own, repeat(0)), np.uint64, len(own))
        hits = defaultdict(list)
        known = np.concatenate([[0], np.cumsum(doc != 0)])
        for n in self.lengths:
            if len(doc) < n:
                continue
            some = np.flatnonzero(known[n:] - known[:-n] == n)  # n words of the benchmark
            if not len(some):
                continue
            keys = grams(doc, n)[some]
            for at, key in zip(some.tolist(), keys.tolist()):
                for item in self.seeds.get((n, key), ()):
                    hits[item].append((at, n))
        out = []
        for item in sorted(hits):
            item_id, words = self.items[item]
            inside = np.zeros(len(doc), bool)
            for at, n in hits[item]:
                inside[at:at + n] = True
            # only words in shared seeds can lie in a tile; a zero keeps separate runs apart
            keep = np.flatnonzero(inside)
            gaps = np.flatnonzero(np.diff(keep) > 1) + 1
            parts = np.insert(doc[keep], gaps, np.uint64(0))
            tiles = tile(words, parts, min(self.least, len(words)))
            covered = sum(n for _, _, n in tiles)
            if covered >= coverage * len(words):
                out.append((item_id, len(tiles), covered, len(words)))
        return out


def blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS):
    """The items in lists of bounded total length, one at a time on the driver. An item of more
    than `chars` characters is a block of its own."""
    rows, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        length = len(row["text"] or "")
        if rows and size + length > chars:
            yield rows
            rows, size = [], 0
        rows.append((row["item_id"], row["text"]))
        size += length
    if rows:
        yield rows


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
          min_tile: int = MIN_TILE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, tiles, covered, item_words, coverage of every item in every document."""
    spark = docs.sparkSession
    pairs = docs.select("doc_id", "text")
    found = spark.createDataFrame([], SCHEMA)
    for items in blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(items)
        index: list[Benchmark] = []

        def run(batch: pa.RecordBatch, shared=shared, index=index) -> pa.RecordBatch | None:
            if not index:
                index.append(Benchmark(shared.value, min_tile))
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [(i, *hit) for i, t in zip(ids, texts) for hit in index[0].find(t, coverage)]
            if not rows:
                return None
            doc, item, tiles, covered, n = zip(*rows)
            return pa.RecordBatch.from_arrays([
                pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(tiles, pa.int32()),
                pa.array(covered, pa.int32()), pa.array(n, pa.int32()),
                pa.array([c / m for c, m in zip(covered, n)], pa.float64()),
            ], names=["doc_id", "item_id", "tiles", "covered", "item_words", "coverage"])

        found = found.union(by_batch(pairs, run, SCHEMA))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
                  min_tile: int = MIN_TILE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no item, with all their columns; each block is a filter."""
    at, schema = docs.columns.index("text"), docs.schema
    for items in blocks(benchmark, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            index = Benchmark(shared.value, min_tile)
            for batch in slices(batches, at):
                keep = [not index.find(t, coverage) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
