"""Nearest vectors by inner product, through collision-counting hashing.

Each hash function is a single random projection, kept as a sorted array. A query's windows on
all projections are centred at its own values and grow by virtual rehashing: every round widens them
by a factor, no table is built anew. A vector that collides with the query in enough windows is a
candidate; candidates are verified with their exact inner product. A query stops growing once its
candidates are several times the wanted number and a share of the block.

Inner products become distances by one more dimension that brings every vector to the largest
norm. Rows are dealt to blocks of bounded size by a hash; each task indexes every row of its
block and answers all queries of a query block, which are broadcast, some thousand at a time.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows without a vec_id; a missing tail of a shorter vector counts as zeros; a query id on
several rows is asked once, with its least vector; equal vectors are ordered by vec_id; empty
tables give no rows; columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlens.operators.scale import cut_lineage

EVERY = 20  # queries: ids divisible by this
NEAREST = 20
PROJECTIONS = 64
THRESHOLD = 0.7  # share of the windows in which a candidate collides
SHARE = 0.35  # of a block, to be verified beyond AHEAD times the wanted number
AHEAD = 24
FIRST_WINDOW = 0.8  # in standard deviations of a projection
GROWTH = 1.3  # of the windows in each round
BLOCK = 8192  # rows
QUERY_BLOCK = 8192  # queries broadcast at once

SCHEMA = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding")
    whole = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return vectors.select("vec_id", v.cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & whole
        & F.exists(v, lambda x: x != 0))


def matrix(column, width: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


class Index:
    """Sorted projections of one block of vectors, and each vector's place in them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, seed: int = 7):
        self.ids, self.vectors, self.norm = ids, vectors, norm
        rng = np.random.default_rng(seed)
        self.lines = rng.standard_normal((vectors.shape[1] + 1, PROJECTIONS))
        rest = np.sqrt(np.maximum(norm**2 - (vectors**2).sum(axis=1), 0.0))
        values = (np.column_stack([vectors, rest]) @ self.lines).T
        order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, order, axis=1)
        self.places = np.empty(values.shape, np.uint16)  # a block has fewer rows than 2^16
        np.put_along_axis(self.places, order, np.arange(len(ids), dtype=np.uint16)[None, :], axis=1)
        self.width = FIRST_WINDOW * max(float(values.std(axis=1).mean()), 1e-12)

    def candidates(self, queries: np.ndarray, wanted: int):
        """(number of the query, places of its candidates), round by round. A vector collides on
        a projection if its place lies between the ends of the query's window there."""
        scale = self.norm / np.sqrt((queries**2).sum(axis=1))
        centres = (queries * scale[:, None]) @ self.lines[:-1]
        need = int(np.ceil(THRESHOLD * PROJECTIONS))
        active, width = np.arange(len(queries)), self.width
        while len(active):
            ends = np.empty((2, len(active), PROJECTIONS), np.int64)
            for p in range(PROJECTIONS):
                ends[0, :, p] = np.searchsorted(self.sorted[p], centres[active, p] - width)
                ends[1, :, p] = np.searchsorted(self.sorted[p], centres[active, p] + width, "right")
            still = []
            for q, low, high in zip(active, *ends):
                # below the window the difference wraps round to a large number
                inside = (self.places - low.astype(np.uint16)[:, None]) \
                    < (high - low).astype(np.uint16)[:, None]
                found = np.flatnonzero(inside.sum(axis=0, dtype=np.uint8) >= need)
                if len(found) >= wanted:
                    yield q, found
                else:
                    still.append(q)
            active, width = np.array(still, int), width * GROWTH

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """(query number, ids, scores) of the verified candidates, the best k of each query."""
        n = len(self.ids)
        for q, found in self.candidates(queries, min(n, AHEAD * k + 1 + int(SHARE * n))):
            score = (self.vectors[found] * queries[q]).sum(axis=1)
            ids = self.ids[found]
            other = ids != query_ids[q]
            score, ids = score[other], ids[other]
            best = np.lexsort((ids, -score))[:k]
            yield query_ids[q], ids[best], score[best]


def search(vectors: DataFrame, every: int = EVERY, k: int = NEAREST,
           block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of every query."""
    spark = vectors.sparkSession
    rows = cut_lineage(usable(vectors))
    facts = rows.agg(F.count("*"), F.max(F.size("embedding")), F.max(F.sqrt(F.aggregate(
        "embedding", F.lit(0.0), lambda a, x: a + x * x)))).first()
    n, width, norm = facts
    found = spark.createDataFrame([], SCHEMA)
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(
        F.min("embedding").alias("embedding"))
    dealt = cut_lineage(rows.repartition(max(1, -(-(n or 0) // block)), F.xxhash64("vec_id")))
    for queries in query_blocks(asked, query_block):
        shared = spark.sparkContext.broadcast(queries)

        def run(batches, shared=shared):
            ids, parts = [np.empty(0, np.int64)], [np.empty((0, width))]
            for batch in batches:  # at most a block of rows, by the number of partitions
                ids.append(batch.column(0).to_numpy())
                parts.append(matrix(batch.column(1), width))
            ids, own = np.concatenate(ids), np.concatenate(parts)
            for at in range(0, len(ids), 2 * block):
                index = Index(ids[at:at + 2 * block], own[at:at + 2 * block], norm)
                out = ([], [], [])
                query_ids = np.array([i for i, _ in shared.value])
                asked = np.zeros((len(query_ids), width))
                for row, (_, query) in zip(asked, shared.value):
                    row[:len(query)] = query
                for query_id, near, score in index.nearest(query_ids, asked, k):
                    for target, x in zip(out, (np.full(len(near), query_id), near, score)):
                        target.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in out],
                    names=["query_id", "vec_id", "score"])

        found = found.union(dealt.mapInArrow(run, SCHEMA))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query_blocks(asked: DataFrame, size: int):
    block = []
    for row in asked.toLocalIterator():
        block.append((row["vec_id"], row["embedding"]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block
