"""Removal of repeated byte strings, by merging sorted shards of suffixes.

Every byte covered by a string of `LENGTH` bytes that also starts elsewhere goes. Sorting all
suffixes is avoided in three steps:

1. Anchors. The hashes of all `GRAM`-byte strings of a text are taken, and each position that holds
   the least hash of some stretch as long as a string of `LENGTH` has positions is an anchor. Equal
   strings of `LENGTH` bytes have the same anchor at the same place, so only anchors that occur
   twice matter, and only the `LENGTH` bytes around them. Equal texts are one text throughout.
2. Suffixes at anchors, and reversed prefixes before them, are brought to tasks by the anchor's
   hash. Each shard (an Arrow batch) has its suffixes sorted; the shards' orders are then merged
   by iterative interleave refinement: the interleave starts as one interval per hash, and each
   round splits the intervals by the next eight bytes, to which every shard contributes in its own
   order, until intervals are single or the length is reached. A split gives the common prefix of
   neighbours; no suffixes are sorted anew.
3. Repeated intervals. A string that begins o bytes before an anchor repeats if two anchors are
   in one interval of prefixes of length o and in one of suffixes of length LENGTH - o. All such
   strings of an anchor contain it, so what they cover is one span.

The anchors of a hash with more than `HOT_ROWS` are not brought to one task. They are grouped by
the bytes that matter for a range of o: those that are equal settle each other, and one stands for
all; those that share no string with another are done; the others go on with each half of the range.
In one text only the first two anchors with equal surroundings are kept, as the others are covered
by what these two prove; so a long periodic text has few anchors.

Instead of a Burrows-Wheeler transform of all bytes, with one refinement round per byte of common
prefix, this merges the transform's order at the anchors alone, with the bytes before each suffix
in place of the transform's column (README.md says why).

Defined results: a null text counts as empty; texts shorter than LENGTH lose nothing; equal rows
are repeats of each other; an empty table gives no rows; columns other than doc_id and text are
not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.llm.common import by_batch
from liftlens.llm.near_dedup import one_text_each
from liftlens.llm.shingles import mixed
from liftlens.operators.scale import cut_lineage, task_count

LENGTH = 200
GRAM = 64  # a power of two
STRETCH = LENGTH - GRAM + 1  # positions of a gram in a string of LENGTH
TASK_ROWS = 1 << 16
HOT_ROWS = TASK_ROWS // 4  # anchors of one hash that are still worked on in one task
SLICE = 1 << 12  # anchors handed on at once
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64))
EMPTY = hashlib.sha256(b"").hexdigest()


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all strings of GRAM bytes, doubling their length."""
    h, n = _TABLE[data], 1
    while n < GRAM:
        h = h[:-n] * (_TABLE[n] | np.uint64(1)) + h[n:]
        n *= 2
    return mixed(h)


def sliding(values: np.ndarray, width: int, function) -> np.ndarray:
    """The function (np.minimum or np.maximum) over all stretches of `width` values."""
    out, n = values, 1
    while 2 * n <= width:
        out, n = function(out[:-n], out[n:]), 2 * n
    rest = width - n
    return function(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, list]:
    """Positions and hashes of the anchors, and the (start, stop) that anchors left out cover; none
    in texts shorter than LENGTH."""
    if len(text) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64), []
    data = np.frombuffer(text, np.uint8)
    h = gram_hashes(data)
    least = sliding(h, STRETCH, np.minimum)
    pad = np.zeros(STRETCH - 1, np.uint64)
    # the largest of the minima of all stretches that hold a position
    reached = sliding(np.concatenate([pad, least, pad]), STRETCH, np.maximum)
    at = np.flatnonzero(h == reached)
    out = third(data, h, at)
    left_out = at[out]
    at = at[~out]
    if not len(left_out):
        return at, h[at], []
    start, stop = left_out - STRETCH + 1, left_out + LENGTH
    new = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]]))
    last = np.concatenate([new[1:] - 1, [len(stop) - 1]])
    return at, h[at], [{"start": a, "stop": b}
                       for a, b in zip(start[new].tolist(), stop[last].tolist())]


def third(data: np.ndarray, h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether two earlier anchors of the text have the same bytes around them, all of them."""
    out = np.zeros(len(at), bool)
    inner = np.flatnonzero((at >= STRETCH - 1) & (at + LENGTH <= len(data)))
    own = np.sort(h[at[inner]])
    if not (own[2:] == own[:-2]).any():
        return out
    width = STRETCH - 1 + LENGTH
    begin = at[inner] - STRETCH + 1
    key = np.zeros(len(inner), np.uint64)
    for offset in [*range(0, width - GRAM, GRAM), width - GRAM]:
        key = key * _TABLE[1] + h[begin + offset]
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order][1:] == key[order][:-1])
    around = np.lib.stride_tricks.sliding_window_view(data, width)
    equal = np.zeros(len(order), bool)  # to the one before
    for i in range(0, len(same), SLICE):
        part = same[i:i + SLICE]
        equal[part + 1] = (around[begin[order[part]]]
                           == around[begin[order[part + 1]]]).all(axis=1)
    out[inner[order[np.flatnonzero(equal[2:] & equal[1:-1]) + 2]]] = True
    return out


def words_of(parts: list[bytes], width: int) -> np.ndarray:
    """Each part, cut and padded to `width` bytes, as numbers of eight bytes that sort alike."""
    padded = b"".join([p[:width].ljust(width, b"\0") for p in parts])
    return np.frombuffer(padded, ">u8").reshape(len(parts), width // 8).astype(np.uint64)


def leading_equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bytes of eight are equal."""
    x = a ^ b
    return sum(((x >> np.uint64(64 - 8 * i)) == 0).astype(np.int64) for i in range(1, 9))


def refined(order: np.ndarray, first: np.ndarray, columns: np.ndarray):
    """Refine an interleave: rows in `order`, in intervals of equal `first`, are split column by
    column. Gives the final order and the common prefix (in bytes) of each row with the row before
    it, -1 where `first` differs. Stable: what is in order already is not moved."""
    order = order[np.argsort(first[order], kind="stable")]
    n = len(order)
    common = np.full(n, 8 * columns.shape[1], np.int64)
    new = np.ones(n, bool)
    new[1:] = first[order][1:] != first[order][:-1]
    common[new] = -1
    for j in range(columns.shape[1]):
        interval = np.cumsum(new) - 1
        size = np.bincount(interval)
        open_ = np.flatnonzero(size[interval] > 1)
        if not len(open_):
            break
        rows, own = order[open_], interval[open_]
        moved = np.lexsort((columns[rows, j], own))
        rows = rows[moved]
        order[open_] = rows
        value = columns[rows, j]
        split = np.zeros(len(rows), bool)
        split[1:] = (own[1:] == own[:-1]) & (value[1:] != value[:-1])
        at = np.flatnonzero(split)
        common[open_[at]] = 8 * j + leading_equal(value[at], value[at - 1])
        new[open_[at]] = True
    return order, common


def merged(first: np.ndarray, columns: np.ndarray, shards: np.ndarray):
    """The order of all rows from the orders of the shards (each a stretch of rows)."""
    orders = [a + refined(np.arange(b - a), first[a:b], columns[a:b])[0]
              for a, b in zip(shards[:-1], shards[1:])]
    return refined(np.concatenate(orders), first, columns)


def repeats(first, left, right, left_length, right_length, shards):
    """Least and largest o for which the string that begins o bytes before each anchor repeats
    (largest -1 if none does)."""
    n = len(first)
    classes = []
    for columns in (right, left):
        order, common = merged(first, columns, shards)
        classes.append((order, common))

    def at_depth(kind: int, depth: int) -> np.ndarray:
        order, common = classes[kind]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(common < depth)
        return out

    low, high = np.full(n, LENGTH), np.full(n, -1)
    for o in range(STRETCH):
        rows = np.flatnonzero((left_length >= o) & (right_length >= LENGTH - o))
        if len(rows) < 2:
            continue
        key = at_depth(0, LENGTH - o)[rows] * (n + 1) + at_depth(1, o)[rows]
        by_key = np.argsort(key, kind="stable")
        same = key[by_key][1:] == key[by_key][:-1]
        twice = np.zeros(len(rows), bool)
        twice[by_key[1:][same]] = True
        twice[by_key[:-1][same]] = True
        marked = rows[twice]
        low[marked] = np.minimum(low[marked], o)
        high[marked] = o
    return low, high


def anchored(docs: DataFrame) -> DataFrame:
    """doc_id, node (digest), n_bytes, sha256, the anchors' positions and hashes, and what those
    left out cover."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids, column = batch.slice(at, 1024).columns
                texts = [(t or "").encode() for t in column.to_pylist()]
                with np.errstate(over="ignore"):
                    found = [anchors(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    pa.array([p for p, _, _ in found], pa.list_(pa.int64())),
                    pa.array([h.view(np.int64) for _, h, _ in found], pa.list_(pa.int64())),
                    pa.array([c for _, _, c in found], pa.list_(pa.struct(
                        [("start", pa.int64()), ("stop", pa.int64())]))),
                ], names=["doc_id", "node", "n_bytes", "sha256", "places", "hashes", "covered"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, node binary, n_bytes long, sha256 string, places array<long>, "
             "hashes array<long>, covered array<struct<start: long, stop: long>>")


def surroundings(texts: DataFrame) -> DataFrame:
    """hash, node, place, left (reversed) and right bytes of every anchor in `places`."""

    def run(batches):
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
        names = ["hash", "node", "place", "left", "right"]
        rows = []

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for node, text, places, hashes in zip(*(c.to_pylist() for c in part.columns)):
                    data = text.encode()
                    for i in range(0, len(places), SLICE):
                        rows += [(h, node, p, data[max(0, p - STRETCH + 1):p][::-1],
                                  data[p:p + LENGTH])
                                 for p, h in zip(places[i:i + SLICE], hashes[i:i + SLICE])]
                        if len(rows) >= SLICE:
                            yield out()
                            rows.clear()
        if rows:
            yield out()

    return texts.select("node", "text", "places", "hashes").mapInArrow(
        run, "hash long, node binary, place long, left binary, right binary")


def repeated_spans(around: DataFrame) -> DataFrame:
    """node, start, stop: the bytes around an anchor that repeated strings cover."""
    around = cut_lineage(around)
    hot = cut_lineage(around.groupBy("hash").agg(F.count("*").alias("n")).where(
        F.col("n") > HOT_ROWS).select("hash"))  # at most one for HOT_ROWS anchors
    some_hot = not hot.isEmpty()
    rows = around.join(F.broadcast(hot), "hash", "left_anti") if some_hot else around
    parts = max(task_count(rows.sparkSession), -(-around.count() // TASK_ROWS))

    def run(batches):
        first, node, place, left, right, shards = [], [], [], [], [], [0]
        sizes = [[], []]
        for batch in batches:
            columns = [c.to_pylist() for c in (batch.column(1), batch.column(3), batch.column(4))]
            first.append(batch.column(0).to_numpy())
            place.append(batch.column(2).to_numpy())
            node += columns[0]
            left.append(words_of(columns[1], 136))
            right.append(words_of(columns[2], LENGTH))
            sizes[0] += map(len, columns[1])
            sizes[1] += map(len, columns[2])
            shards.append(len(node))
        if not node:
            return
        place = np.concatenate(place)
        low, high = repeats(np.concatenate(first), np.concatenate(left), np.concatenate(right),
                            np.array(sizes[0]), np.array(sizes[1]), np.array(shards))
        some = np.flatnonzero(high >= 0)
        yield pa.RecordBatch.from_arrays([
            pa.array([node[i] for i in some], pa.binary()),
            pa.array(place[some] - high[some], pa.int64()),
            pa.array(place[some] - low[some] + LENGTH, pa.int64()),
        ], names=["node", "start", "stop"])

    spans = rows.repartition(parts, "hash").mapInArrow(run, "node binary, start long, stop long")
    return spans.union(hot_spans(around.join(F.broadcast(hot), "hash", "left_semi"))) \
        if some_hot else spans


def hot_spans(around: DataFrame) -> DataFrame:
    """What `repeated_spans` gives, by grouping alone, so that a hash may have any number of
    anchors. Each row has a range of o, from `low` to `high`, and only the bytes that matter for it;
    it has strings from LENGTH - length(right) to length(left) bytes before the anchor. `asked`
    is false if the row is settled and only serves to find repeats in others."""
    whole = "length(left) + length(right) >= %d" % LENGTH
    digest = "md5(concat(encode(concat_ws(',', hash, low, length({0})), 'UTF-8'), {0}, {1}))"
    level = around.selectExpr("hash", "node", "place", "left", "right", "0 AS low",
                              f"{STRETCH - 1} AS high", "true AS asked").where(whole)
    found = []
    while True:
        level = cut_lineage(level.withColumn("own", F.expr(digest.format("left", "right"))))
        if level.isEmpty():
            break
        alike = cut_lineage(level.groupBy("own").agg(
            F.count("*").alias("n"), F.first(F.struct(*level.columns)).alias("row")))
        settled = level.where("asked").join(
            alike.where("n > 1").select("own"), "own", "left_semi")
        found.append(settled.selectExpr(
            "node", "place - length(left) AS start", "place + length(right) AS stop"))
        stand = alike.where("row.low < row.high").selectExpr("n", "row.*").withColumn(
            "asked", F.expr("asked AND n = 1")).withColumn("shared", F.expr(digest.format(
                "substring(left, 1, low)", f"substring(right, 1, {LENGTH} - high)")))
        stand = cut_lineage(stand.drop("n", "own"))
        open_ = stand.groupBy("shared").agg(
            F.count("*").alias("n"), F.max("asked").alias("any")).where("n > 1 AND any")
        halves = stand.join(open_.select("shared"), "shared", "left_semi").selectExpr(
            "hash", "node", "place", "left", "right", "asked",
            "inline(array(struct(low AS low, (low + high) div 2 AS high), "
            "struct((low + high) div 2 + 1 AS low, high AS high)))")
        level = halves.selectExpr(
            "hash", "node", "place", "substring(left, 1, CAST(high AS INT)) AS left",
            f"substring(right, 1, CAST({LENGTH} - low AS INT)) AS right",
            "CAST(low AS INT) AS low", "CAST(high AS INT) AS high", "asked").where(whole)
    return reduce(DataFrame.union, found)


def cut(texts: DataFrame) -> DataFrame:
    """node, n_removed, n_spans, kept (the remaining bytes) of texts with spans to remove."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for node, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
            data, kept, at, number = text.encode(), [], 0, 0
            for start, stop in sorted((s["start"], s["stop"]) for s in spans):
                if start > at or number == 0:
                    number += 1
                if start > at:
                    kept.append(data[at:start])
                at = max(at, stop)
            kept = b"".join([*kept, data[at:]])
            out.append((node, len(data) - len(kept), number, kept))
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                          names=["node", "n_removed", "n_spans", "kept"])

    return by_batch(texts.select("node", "text", "spans"), run,
                    "node binary, n_removed long, n_spans long, kept binary")


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = cut_lineage(anchored(docs))
    nodes = rows.groupBy("node").agg(
        F.first("places").alias("places"), F.first("hashes").alias("hashes"),
        F.first("covered").alias("covered"), F.min("doc_id").alias("doc_id"),
        F.count("*").alias("copies"))
    each = nodes.select("node", F.explode(F.arrays_zip("places", "hashes")).alias("x")).select(
        "node", F.col("x.places").alias("place"), F.col("x.hashes").alias("hash"))
    twice = each.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    wanted = each.join(twice, "hash").groupBy("node").agg(
        F.collect_list("place").alias("places"), F.collect_list("hash").alias("hashes"))
    stands = nodes.select("node", "doc_id", "copies")
    wanted = cut_lineage(wanted.join(stands, "node"))
    texts = one_text_each(wanted, docs).join(wanted.select("node", "places", "hashes"), "node")
    # texts with copies go whole, and only serve to find repeats in others
    covered = nodes.select("node", F.inline("covered"))
    spans = repeated_spans(surroundings(texts)).union(covered).join(
        stands.where("copies = 1").select("node", "doc_id"), "node")
    spans = cut_lineage(spans.groupBy("node", "doc_id").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")))
    found = cut(one_text_each(spans, docs).join(spans.select("node", "spans"), "node"))
    found = found.select("node", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept"))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    facts = stands.select("node", "copies").join(found, "node", "left")
    out = rows.select("doc_id", "node", "n_bytes", "sha256").join(facts, "node")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(whole, EMPTY).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256"))
