"""Near-duplicate texts: DartMinHash signatures, banded joining, exact check.

A text is the set of its shingles of five words, each with a weight (1 here; the signature takes
any weights). DartMinHash throws hashed darts at the plane of weight and rank over each element.
A dart is kept if it falls below the element's weight and below a rank limit inversely
proportional to the total weight, so a set keeps about k ln k darts whatever its size; each dart
belongs to one of k coordinates, and the earliest per coordinate is the signature. Equal
coordinates of two sets have the probability of their weighted Jaccard similarity.

Bands of four coordinates are joined. In each bucket all members are compared with the most
central one (a star instead of all pairs); members that this leaves in different components are
compared with each other where they share a shingle that the centre lacks, or where a bound on
what they share inside the centre's set allows a similarity of 0.8; no other pair reaches it. The
comparison is exact, on the shingle sets. Exact copies are one node throughout.

Defined results: null texts and texts without words are in a class of their own and have no
links; texts with one to four words are a single shingle; equal texts are one class whatever
their doc_ids; every input row gives a row; a class is named by its least doc_id (nulls last);
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlens.llm.common import WORD, by_batch
from liftlens.llm.components import components
from liftlens.llm.shingles import MULTIPLIER, mixed, shingle_set, word_hasher
from liftlens.operators.scale import cut_lineage

WORDS = 5
SIMILARITY = (4, 5)  # at least 4/5
BANDS, ROWS = 25, 4  # a pair of similarity 0.8 shares a bucket with probability 0.999998
CHUNK = 256  # texts whose signatures are made together
LOWEST = -3  # ranks below 2^LOWEST are one region
WORDS_OF_BITS = 16  # longs of a set's bitmap


@functools.cache
def poisson_table(rate: float) -> np.ndarray:
    """The cumulative distribution of a Poisson count, up to where it is 1 in 64 bits."""
    p, total, out, i = math.exp(-rate), 0.0, [], 0
    while total < 1 - 1e-15 and i < 40 + 8 * rate:
        total += p
        out.append(total)
        i += 1
        p *= rate / i
    return np.array(out)


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def darts(elements: np.ndarray, weights: np.ndarray, limits: np.ndarray):
    """(rank, dart, place of its element) of all darts below the weight and the rank limit of
    their element.

    The plane over an element is cut into regions, weights and ranks both doubling. Number and
    places of the darts in a region depend on element and region alone."""
    top = max(LOWEST, math.ceil(math.log2(limits.max())))
    heights = max(0, math.ceil(math.log2(max(weights.max(), 1.0))))
    ranks, names, places = [], [], []
    for v in range(heights + 1):
        low_w, high_w = (0.0, 1.0) if v == 0 else (2.0**(v - 1), 2.0**v)
        for r in range(LOWEST, top + 1):
            low_r, high_r = (0.0, 2.0**r) if r == LOWEST else (2.0**(r - 1), 2.0**r)
            at = np.flatnonzero((weights > low_w) & (limits > low_r))
            region = np.uint64((v << 8) + (r - LOWEST) + 1)
            seed = mixed(elements[at] + region * MULTIPLIER)
            cdf = poisson_table((high_w - low_w) * (high_r - low_r))
            number = np.searchsorted(cdf, unit(seed), side="right")
            some = number > 0
            number, at = number[some], at[some]
            base = np.repeat(seed[some], number)
            at = np.repeat(at, number)
            # the j-th dart of each region
            j = np.arange(len(base)) - np.repeat(np.cumsum(number) - number, number)
            dart = mixed(base + (j + 1).astype(np.uint64) * MULTIPLIER)
            rank = low_r + (high_r - low_r) * unit(mixed(dart ^ np.uint64(1)))
            high = low_w + (high_w - low_w) * unit(mixed(dart ^ np.uint64(2)))
            keep = (rank < limits[at]) & (high < weights[at])
            ranks.append(rank[keep])
            names.append(dart[keep])
            places.append(at[keep])
    return np.concatenate(ranks), np.concatenate(names), np.concatenate(places)


def signatures_of(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """For each weighted set (elements, weights; of positive total) k coordinates: the earliest
    dart that falls to each. The sets that leave one empty get twice the darts."""
    out = np.zeros((len(sets), k), np.uint64)
    todo, expected = np.arange(len(sets)), k * (math.log(k) + 2.0)
    with np.errstate(over="ignore"):
        while len(todo):
            own = [sets[i] for i in todo]
            of = np.repeat(np.arange(len(own)), [len(e) for e, _ in own])
            limits = np.array([expected / w.sum() for _, w in own])
            rank, dart, at = darts(np.concatenate([e for e, _ in own]),
                                   np.concatenate([w for _, w in own]), limits[of])
            cell = of[at] * k + (mixed(dart ^ np.uint64(3)) % np.uint64(k)).astype(np.int64)
            order = np.argsort(rank, kind="stable")[::-1]  # the earliest is written last
            earliest = np.zeros(len(own) * k, np.uint64)
            filled = np.zeros(len(own) * k, bool)
            earliest[cell[order]] = dart[order]
            filled[cell] = True
            out[todo] = earliest.reshape(-1, k)
            todo = todo[~filled.reshape(-1, k).all(axis=1)]
            expected *= 2
    return out


def band_keys(signs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key of 64 bits for each set and band, the band's number included."""
    with np.errstate(over="ignore"):
        key = np.tile(np.arange(bands, dtype=np.uint64), (len(signs), 1))
        for i in range(rows):
            key = mixed(key * MULTIPLIER + signs.reshape(len(signs), bands, rows)[:, :, i])
    return key


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, node (128 bits of the text; null without words) and the keys of its bands."""

    def run(batches):
        hasher = word_hasher()
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                ids, texts = batch.slice(at, CHUNK).columns
                texts = texts.to_pylist()
                sets = [shingle_set(hasher, t, WORDS) for t in texts]
                some = [i for i, s in enumerate(sets) if len(s)]
                signs = signatures_of([(sets[i], np.ones(len(sets[i]))) for i in some],
                                      bands * rows)
                nodes, keys = [None] * len(texts), [None] * len(texts)
                for i, key in zip(some, band_keys(signs, bands, rows).view(np.int64)):
                    nodes[i], keys[i] = hashlib.md5(texts[i].encode()).digest(), key
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "node", "keys"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, node binary, keys array<long>")


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the bits that its elements' hashes name, as longs."""
    out = np.zeros((len(sets), WORDS_OF_BITS * 64), np.uint8)
    for i, s in enumerate(sets):
        with np.errstate(over="ignore"):
            out[i, mixed(s.view(np.uint64)) % np.uint64(out.shape[1])] = 1
    return np.packbits(out, axis=1).view(np.int64)


def most_shared(x: str, y: str):
    """No fewer than two sets share: an element whose bit the other set lacks is not shared."""
    lacks = lambda a, b: " + ".join(
        f"bit_count({a}.bits[{i}] & ~{b}.bits[{i}])" for i in range(WORDS_OF_BITS))
    return F.expr(f"least({x}.n - ({lacks(x, y)}), {y}.n - ({lacks(y, x)}))")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """node, its distinct shingles and their bitmap."""
    hashers: list = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not hashers:
            hashers.append(word_hasher())
        sets = [shingle_set(hashers[0], t, WORDS).view(np.int64)
                for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, pa.list_(pa.int64())),
             pa.array(list(bitmaps(sets)), pa.list_(pa.int64()))], names=["node", "shingles", "bits"])

    return by_batch(docs.select("node", "text"), run,
                    "node binary, shingles array<long>, bits array<long>")


def compared(pairs: DataFrame, sets: DataFrame, *more) -> DataFrame:
    """The pairs (a, b) with the sizes of their shingle sets (na, nb), what they share (both)
    and whether they are similar; `more` columns may be made of the sets sa and sb and of bits, the
    bitmap of b. A node in very
    many pairs is spread by the skew handling of the joins, which need nothing of a key together."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), "bits")
    both = F.size(F.array_intersect("sa", "sb")).alias("both")
    out = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), both, *more)
    return out.withColumn("similar", reaches(F.col("both"), F.col("na") + F.col("nb")))


def reaches(both, sizes):
    return both * SIMILARITY[1] >= (sizes - both) * SIMILARITY[0]


def one_text_each(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """node and text for the nodes in `wanted`, read from the document that stands for each. The
    digest is compared, as doc_ids may repeat; without a doc_id the digest is the key. Of repeated
    rows one is taken."""
    by_id, digest = F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))
    texts = docs.select(F.coalesce(by_id, digest).alias("at"), digest.alias("digest"), "text")
    keyed = wanted.select("node", F.lower(F.hex("node")).alias("digest"),
                          F.coalesce(by_id, F.lower(F.hex("node"))).alias("at"))
    found = texts.join(keyed, ["at", "digest"])
    return found.groupBy("at", "digest").agg(
        F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text")


def links(signed: DataFrame, docs: DataFrame) -> DataFrame:
    """Similar pairs (a, b) of nodes that connect everything similar within the buckets.

    In each bucket the most central member (whose keys are the most common) is compared with
    all others. What that connects is one component; members of different components may still
    be similar. What two sets share is at most the smaller of their parts inside the centre's set
    plus the smaller of their parts outside it, so such a pair either shares a shingle that the
    centre lacks, or its parts inside the centre's set suffice alone. Only these pairs are
    compared."""
    nodes = signed.where("node is not null").groupBy("node").agg(
        F.first("keys").alias("keys"), F.min("doc_id").alias("doc_id"))
    members = nodes.select("node", F.explode("keys").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = cut_lineage(members.join(shared, "key"))
    common = members.groupBy("node").agg(F.sum("n").alias("common"))
    sets = cut_lineage(shingle_sets(one_text_each(
        common.select("node").join(nodes.select("node", "doc_id"), "node"), docs)))
    centres = members.join(common, "node").groupBy("key").agg(
        F.max(F.struct("common", "node")).alias("top")).select(
        "key", F.col("top.node").alias("centre"))
    members = members.select("key", "node").join(centres, "key")
    first = cut_lineage(compared(members.where("node != centre").select(
        F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), sets,
        F.array_except("sb", "sa").alias("outside"), "bits"))
    found = first.where("similar").select("a", "b")
    roots = components(found)
    # each centre and its members, with the size of a member's set and of its part inside
    own = F.coalesce("root", "node").alias("root")
    placed = first.select(F.col("a").alias("centre"), F.col("b").alias("node"),
                          F.col("nb").alias("n"), F.col("both").alias("inside"), "outside", "bits")
    placed = placed.join(roots, "node", "left").select(
        "centre", "node", "n", "inside", "outside", "bits", own)
    main = first.select(F.col("a").alias("node")).distinct().join(roots, "node", "left").select(
        F.col("node").alias("centre"), F.coalesce("root", "node").alias("main"))
    placed = placed.join(main, "centre").withColumn("in_main", F.col("root") == F.col("main"))
    some_open = placed.where("not in_main").select("centre").distinct()
    placed = cut_lineage(placed.join(some_open, "centre"))
    return found.union(left_over(placed, sets))


def left_over(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Similar pairs of different components around the same centre, neither of which is it. The
    joins make only pairs that the bounds by sizes and by bitmaps leave.

    `placed`: centre, node, n, inside, outside, bits, root, in_main."""
    facts = placed.select("centre", "node", "n", "inside", "bits", "root", "in_main")
    within = F.expr("x.root != y.root and not x.in_main and (y.in_main or x.node < y.node)")
    sizes = F.expr("x.n + y.n")
    inside = F.least("x.inside", "y.inside")
    outside = F.least(F.expr("x.n - x.inside"), F.expr("y.n - y.inside"))
    # With the rarest shingles around the centre first, the first fifth and one more of two
    # sets have one in common if the sets are similar by shingles outside. Those of one node or of
    # the main component alone come before all others, and make no pairs.
    shingles = placed.select(*facts.columns, F.explode("outside").alias("shingle"))
    some = shingles.groupBy("centre", "shingle").agg(
        F.count("*").alias("k"), F.every("in_main").alias("all_main")).where(
        "k > 1 and not all_main").select("centre", "shingle", "k")
    of_node = Window.partitionBy("centre", "node")
    place = (F.col("n") - F.col("inside") - F.count("*").over(of_node)
             + F.row_number().over(of_node.orderBy("k", "shingle")))
    shingles = shingles.join(some, ["centre", "shingle"]).withColumn("place", place)
    shingles = cut_lineage(shingles.where("place <= floor(n / 5) + 1").drop("k", "place"))
    x, y = shingles.alias("x"), shingles.alias("y")
    by_shingle = x.join(y, F.expr("x.centre = y.centre and x.shingle = y.shingle") & within
                        & reaches(F.least(inside + outside, most_shared("x", "y")), sizes))
    # a node whose part inside suffices for no size around the centre has no partner there
    enough = facts.join(facts.groupBy("centre").agg(F.min("n").alias("least_n")), "centre")
    enough = cut_lineage(enough.where(reaches(F.col("inside"), F.col("n") + F.col("least_n"))))
    x, y = enough.alias("x"), enough.alias("y")
    by_inside = x.join(y, F.expr("x.centre = y.centre") & within
                       & reaches(F.least(inside, most_shared("x", "y")), sizes))
    ends = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
    pairs = by_shingle.select(*ends).union(by_inside.select(*ends)).distinct()
    return cut_lineage(compared(pairs, sets).where("similar").select("a", "b"))


def grouped(docs: DataFrame, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, node), and for every node its class: class_id, class_size, and whether
    the node's text stands for the class (its least doc_id, then its least digest)."""
    signed = cut_lineage(signatures(docs, bands, rows))
    roots = components(links(signed, docs))
    named = signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n"))
    named = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("first")
    totals = named.groupBy("root").agg(first, F.sum("n").alias("class_size"))
    of_node = named.select("node", "root").join(totals, "root").select(
        "node", F.col("first.least").alias("class_id"), "class_size",
        (F.col("first.node") == F.col("node")).alias("stands"))
    return signed.select("doc_id", "node"), of_node


def classes(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id and class_size for every document."""
    members, of_node = grouped(docs, bands, rows)
    own = F.col("node").isNull()
    return members.join(of_node, "node", "left").select(
        "doc_id", F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, 1).otherwise(F.col("class_size")).cast("long").alias("class_size"))


def deduplicated(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One document of each class, the one that gives the class its name; texts without words
    all stay. Other columns stay. Rows meet on doc_id and digest, which spreads copies."""
    _, of_node = grouped(docs, bands, rows)
    text_key = F.md5(F.col("text").cast("binary"))
    kept = of_node.where("stands").select(
        F.lower(F.hex("node")).alias("__node"),
        F.coalesce(F.col("class_id").cast("string"), F.lower(F.hex("node"))).alias("__at"))
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows_ = docs.where(has_words).withColumn("__node", text_key).withColumn(
        "__at", F.coalesce(F.col("doc_id").cast("string"), F.col("__node")))
    once = Window.partitionBy("__node", "__at").orderBy("doc_id")
    rows_ = rows_.join(kept, ["__node", "__at"], "left_semi")
    rows_ = rows_.withColumn("__row", F.row_number().over(once)).where("__row = 1")
    return rows_.select(*docs.columns).union(docs.where(~has_words))
