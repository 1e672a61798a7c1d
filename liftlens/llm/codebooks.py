"""Vector codes by dual-tree Lloyd: each part of a vector becomes the number of its nearest
codebook entry.

Components become integers of `SCALE` steps, vectors are cut into equal consecutive parts, and
each part position has a codebook that Lloyd's rounds improve. A block of vectors gets one tree
per part position, halved along the widest component, whose nodes know their box, their size and
the sum of their members. A round walks these trees and a small tree over the codebook entries at
the same time: of a node's pairs with entry nodes those go whose least distance exceeds the
smallest largest distance of another pair. A node with a single entry left is assigned as a whole,
by its cached sum; the members of leaves that stay uncertain are compared in integers. Pruned
entries are strictly farther, so ties are still decided by the lower index.

The blocks with their trees are written once and read in every round. A round brings one sum per
part, entry and component to the driver; codebooks have a fixed size. No vector is shuffled.

Defined results: vectors that are null, empty or hold null or non-finite components are dropped,
and so are vectors of another length than the first entry's; a length that the parts do not divide
is filled up with zeros; steps beyond +-2^26 count as 2^26, so that distances stay exact; null
vec_ids come after all others and equal ones go by their components; with fewer vectors than
entries the codebooks are smaller; an empty table gives no rows; equal rows get equal codes; null
labels are one label; columns other than vec_id, embedding and label are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.operators.scale import cut_lineage, lookup_join

SCALE = 4096
MOST = 1 << 26
PARTS, ENTRIES, ROUNDS = 8, 16, 6
BLOCK = 4096  # vectors of a block
LEAF = 32  # members of a leaf
PAIRS = 1 << 16  # pairs of a member and an entry that are compared together, at most


@dataclass
class Tree:
    """One halved tree per part position, all of one shape: node j of a level of 2^level nodes
    has members floor(n j / 2^level) to floor(n (j + 1) / 2^level) of `order`."""

    points: np.ndarray  # parts x members x components, in the order of the tree
    order: np.ndarray  # parts x members: which row each member is
    low: np.ndarray  # parts x nodes x components; level by level
    high: np.ndarray
    sums: np.ndarray

    @property
    def depth(self) -> int:
        return self.low.shape[1].bit_length() - 1

    def bounds(self, level: int) -> np.ndarray:
        return borders(self.points.shape[1], level)


def borders(n: int, level: int) -> np.ndarray:
    return n * np.arange((1 << level) + 1) // (1 << level)


def build(parts: np.ndarray, depth: int) -> Tree:
    """`parts`: parts x members x components. Levels are split at the middle member along each
    node's widest component."""
    k, n, d = parts.shape
    order, points = np.tile(np.arange(n), (k, 1)), parts.copy()
    low, high, sums = [], [], []
    for level in range(depth + 1):
        at = borders(n, level)
        begin, size = at[:-1], np.diff(at)
        # an empty node has an empty box, and reduceat needs a member to begin with
        safe, void = np.minimum(begin, n - 1), (size == 0)[None, :, None]
        low.append(np.where(void, MOST + 1, np.minimum.reduceat(points, safe, axis=1)))
        high.append(np.where(void, -MOST - 1, np.maximum.reduceat(points, safe, axis=1)))
        sums.append(np.where(void, 0, np.add.reduceat(points, safe, axis=1)))
        if level == depth:
            break
        node = np.repeat(np.arange(len(size)), size)
        widest = (high[-1] - low[-1]).argmax(axis=2)
        for p in range(k):
            values = points[p, np.arange(n), widest[p, node]]
            turn = np.lexsort((values, node))
            points[p], order[p] = points[p, turn], order[p, turn]
    return Tree(points, order, *[np.concatenate(x, axis=1) for x in (low, high, sums)])


@dataclass
class Entries:
    """The codebooks: parts x entries x components, and the tree over distinct entries."""

    values: np.ndarray
    tree: Tree
    void: np.ndarray  # parts x nodes: nodes without an entry
    index: np.ndarray  # parts x leaves: the entry in it


def codebook_tree(values: np.ndarray) -> Entries:
    k, m, _ = values.shape
    depth = (m - 1).bit_length()
    tree = build(values, depth)
    at = borders(m, depth)
    index = tree.order[:, np.minimum(at[:-1], m - 1)]
    leaf_void = np.tile(np.diff(at) == 0, (k, 1))
    # of equal entries only the first can win
    for p in range(k):
        first = {}
        for i, v in enumerate(map(bytes, values[p])):
            first.setdefault(v, i)
        leaf_void[p] |= ~np.isin(index[p], list(first.values()))
    void = [leaf_void]
    while void[0].shape[1] > 1:
        void.insert(0, void[0][:, ::2] & void[0][:, 1::2])
    return Entries(values, tree, np.concatenate(void, axis=1), index)


def assign(tree: Tree, codebooks: Entries, sums: np.ndarray | None = None,
           counts: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """The entry of each member (parts x members, in the tree's order) and the share of members
    that were assigned with their whole node. Adds to `sums` and `counts` if given."""
    k, n, _ = tree.points.shape
    codes = np.full((k, n), -1)
    part, node, entry = np.arange(k), np.zeros(k, int), np.zeros(k, int)
    level = entry_level = whole = 0
    last = codebooks.tree.depth
    while len(part):
        a, b = (1 << level) - 1 + node, (1 << entry_level) - 1 + entry
        real = ~codebooks.void[part, b]
        part, node, entry, a, b = part[real], node[real], entry[real], a[real], b[real]
        low, high = tree.low[part, a], tree.high[part, a]
        e_low, e_high = codebooks.tree.low[part, b], codebooks.tree.high[part, b]
        gap = np.maximum(np.maximum(e_low - high, low - e_high), 0)
        reach = np.maximum(e_high - low, high - e_low)
        near, far = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        group = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (node[1:] != node[:-1])])
        size = np.diff(np.r_[group, len(part)])
        keep = near <= np.repeat(np.minimum.reduceat(far, group), size)
        alone = np.repeat(np.add.reduceat(keep, group) == 1, size) & keep
        at = tree.bounds(level)
        if entry_level == last:
            p, j, e = part[alone], node[alone], codebooks.index[part[alone], entry[alone]]
            lengths = at[j + 1] - at[j]
            whole += lengths.sum()
            where = np.repeat(at[j], lengths) + run_places(lengths)
            codes[np.repeat(p, lengths), where] = np.repeat(e, lengths)
            if sums is not None:
                np.add.at(sums, (p, e), tree.sums[p, (1 << level) - 1 + j])
                np.add.at(counts, (p, e), lengths)
            keep &= ~alone
        part, node, entry = part[keep], node[keep], entry[keep]
        if level == tree.depth and entry_level == last:
            if len(part):
                uncertain(tree, codebooks, at, part, node, entry, codes, sums, counts)
            break
        if entry_level < last:
            part, node, entry = (np.repeat(x, 2) for x in (part, node, entry))
            entry = entry * 2 + np.arange(len(entry)) % 2
            entry_level += 1
        if level < tree.depth:
            # members halve: a group of pairs becomes two groups
            part, node, entry = np.tile(part, 2), np.r_[node * 2, node * 2 + 1], np.tile(entry, 2)
            turn = np.argsort(part * (2 << level) + node, kind="stable")
            part, node, entry = part[turn], node[turn], entry[turn]
            level += 1
            alive = tree.bounds(level)[node] < tree.bounds(level)[node + 1]
            part, node, entry = part[alive], node[alive], entry[alive]
    return codes, whole / max(1, k * n)


def run_places(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... anew for each length."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def uncertain(tree: Tree, codebooks: Entries, at, part, node, entry, codes, sums, counts) -> None:
    """Compare the members of leaves with the entries left, in integers."""
    entry = codebooks.index[part, entry]
    group = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (node[1:] != node[:-1])])
    # leaves differ by one member at most; a shorter one repeats its last
    most = int((at[1:] - at[:-1]).max())
    step = max(1, PAIRS // (most * codebooks.values.shape[1]))  # leaves that are compared together
    for first in range(0, len(group), step):
        lead = group[first:first + step]
        end = group[first + step] if first + step < len(group) else len(part)
        p, j = part[lead], node[lead]
        members = np.minimum(at[j][:, None] + np.arange(most), at[j + 1][:, None] - 1)
        inner = lead - lead[0]
        size = np.diff(np.r_[lead, end])
        e = entry[lead[0]:end]
        gap = np.repeat(tree.points[p[:, None], members], size, axis=0)
        gap -= codebooks.values[np.repeat(p, size), e][:, None]
        gap *= gap
        distance = gap.sum(axis=2)
        least = np.repeat(np.minimum.reduceat(distance, inner, axis=0), size, axis=0)
        best = np.minimum.reduceat(
            np.where(distance == least, e[:, None], codebooks.values.shape[1]), inner, axis=0)
        real = np.arange(most) < (at[j + 1] - at[j])[:, None]
        p, members, best = np.repeat(p, real.sum(axis=1)), members[real], best[real]
        codes[p, members] = best
        if sums is not None:
            np.add.at(sums, (p, best), tree.points[p, members])
            np.add.at(counts, (p, best), 1)


def integers(vectors: np.ndarray, parts: int) -> np.ndarray:
    """parts x vectors x components of the vectors (as rows of doubles)."""
    steps = np.clip(np.floor(vectors * SCALE), -MOST, MOST).astype(np.int64)
    n, d = steps.shape
    width = -(-d // parts)
    filled = np.zeros((n, width * parts), np.int64)
    filled[:, :d] = steps
    return np.ascontiguousarray(filled.reshape(n, parts, width).transpose(1, 0, 2))


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding as doubles, and label of the vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
                          "label").where(F.coalesce(finite, F.lit(False)) & (F.size("embedding") > 0))


ARRAYS = ("points", "order", "low", "high", "sums")


def blocks(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """The vectors of `width` components in blocks with their trees, one row per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(begin, BLOCK)
                n = rows.num_rows
                tree = build(integers(rows.column(1).flatten().to_numpy().reshape(n, width), parts),
                             max(0, math.ceil(math.log2(n / LEAF))))
                packed = [pa.array([getattr(tree, a).astype(np.int64 if a == "sums" else np.int32)
                                    .tobytes()], pa.binary()) for a in ARRAYS]
                lists = [pa.ListArray.from_arrays([0, n], rows.column(i)) for i in (0, 2)]
                yield pa.RecordBatch.from_arrays([*lists, *packed], names=["ids", "labels", *ARRAYS])

    types = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = f"ids array<{types['vec_id']}>, labels array<{types['label']}>, " + \
        ", ".join(f"{a} binary" for a in ARRAYS)
    return vectors.where(F.size("embedding") == width).mapInArrow(run, schema)


def tree_of(row: dict, parts: int, width: int) -> Tree:
    read = {a: np.frombuffer(row[a], np.int64 if a == "sums" else np.int32).astype(np.int64)
            for a in ARRAYS}
    return Tree(**{a: x.reshape(parts, -1, width) if a != "order" else x.reshape(parts, -1)
                   for a, x in read.items()})


def improved(table: DataFrame, values: np.ndarray) -> np.ndarray:
    """The codebooks after one more round; entries without members stay."""
    k, m, d = values.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = codebook_tree(values)
        sums, counts = np.zeros((k, m, d), np.int64), np.zeros((k, m), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                assign(tree_of(row, k, d), codebooks, sums, counts)
        whole = np.concatenate([sums, counts[..., None]], axis=2).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(whole))), pa.array(whole)],
                                         names=["cell", "n"])

    cells = table.select(*ARRAYS).mapInArrow(run, "cell long, n long")
    found = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # one per part, entry, component
    total = np.zeros(k * m * (d + 1), np.int64)
    total[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    total = total.reshape(k, m, d + 1)
    sums, counts = total[..., :d], total[..., d:]
    return np.where(counts > 0, sums // np.maximum(counts, 1), values)


def coded(table: DataFrame, values: np.ndarray, id_type: str, label_type: str) -> DataFrame:
    """vec_id, label, codes (one entry per part) and error."""
    k, _, d = values.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = codebook_tree(values)
        for batch in batches:
            for i in range(batch.num_rows):
                tree = tree_of({a: batch.column(a)[i].as_py() for a in ARRAYS}, k, d)
                found, _ = assign(tree, codebooks)
                step = tree.points - values[np.arange(k)[:, None], found]
                n = found.shape[1]
                codes, errors = np.empty((n, k), np.int32), np.zeros(n, np.int64)
                for p in range(k):
                    codes[tree.order[p], p] = found[p]
                    errors[tree.order[p]] += (step[p] * step[p]).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values,
                     pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * k, codes.ravel()),
                     pa.array(errors)], names=["vec_id", "label", "codes", "error"])

    return table.mapInArrow(
        run, f"vec_id {id_type}, label {label_type}, codes array<int>, error long")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, codes and error of the vectors, and the codebooks (parts x entries x
    components)."""
    rows = kept(vectors)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    head = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
    first = head.limit(1).collect()
    width = len(first[0]["embedding"]) if first else 0
    if not width:
        empty = rows.where("false").select("vec_id", "label", F.array().cast("array<int>").alias("codes"),
                                           F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    seeds = head.where(F.size("embedding") == width).limit(entries).collect()
    values = integers(np.array([r["embedding"] for r in seeds]), parts)
    table = cut_lineage(blocks(rows, width, parts))
    for _ in range(rounds):
        values = improved(table, values)
    return coded(table, values, types["vec_id"], types["label"]), values


def digest(values: np.ndarray) -> str:
    """sha256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, values.ravel().tolist())).encode()).hexdigest()


def codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error (summed over the label's
    vectors) and codebooks_sha256."""
    rows, values = compress(vectors)
    rows = cut_lineage(rows.select(
        "vec_id", F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))).alias("code"),
        "error", F.coalesce(F.col("label").cast("string"), F.lit("")).alias("__label"),
        F.col("label").isNull().alias("__no_label")))
    keys = ["__label", "__no_label"]
    sums = rows.groupBy(*keys).agg(F.sum("error").alias("label_error"))
    return lookup_join(rows, sums, keys).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(values)).alias("codebooks_sha256"))
