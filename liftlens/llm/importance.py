"""Importance resampling towards a target distribution, on hashed word n-grams.

Every run of 1 to 3 words of a text is a feature, and its CRC-32 names one of `BUCKETS` buckets.
The gain of a bucket is the log ratio of its smoothed shares in the target (the benchmark) and in
all documents; a document's weight is the sum of the gains of its features. Gumbel noise, derived
from the doc_id, turns the largest scores into a draw without replacement.

The features come from Arrow kernels over slices of a batch: `ascii_lower`, `split_pattern_regex`,
`list_flatten` and `dictionary_encode` number the words; shifted numbers form pairs, and numbers of
pairs with the next word form triples. Only distinct pairs and triples are hashed, each CRC going
on from that of its prefix; `take` spreads gains to features and a segmented sum adds them up.

The buckets of all features are written once as packed numbers; counts and weights read them. The
rank is a global one: rows are dealt to ranges of the order, numbered within, and moved by the
sizes of the ranges before.

Defined results: null and empty texts and texts without words have no features and weight 0, and
so have all texts where documents and target are empty; a null doc_id hashes as the empty text and
comes after all others; equal scores go to the smaller doc_id, then to fewer features, and equal
rows get neighbouring ranks; very long texts are read whole, alone in their slice; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlens.llm.common import slices
from liftlens.operators.scale import cut_lineage

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LENGTHS = 3  # words of the longest feature
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
RANGE_ROWS = 20_000  # rows of a range of the global order
PACKED = np.dtype("<u2")


def word_indices(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of all words in order: the text they are in and their number among the distinct words;
    and the distinct words."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    words, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(words, "")  # a text may begin or end with a separator
    encoded = words.filter(real).dictionary_encode()
    return (rows.filter(real).to_numpy(), encoded.indices.to_numpy(),
            encoded.dictionary.cast(pa.binary()).to_pylist())


def feature_buckets(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of words of each text, and for each length of features their texts and buckets
    (as pairs of arrays in the order of the texts)."""
    rows, index, words = word_indices(texts)
    spaced = [b" " + w for w in words]
    crcs = np.fromiter(map(crc32, words), np.uint32, len(words))
    grams, out = index.astype(np.int64), [(rows, (crcs % buckets)[index])]
    for length in range(2, LENGTHS + 1):
        if len(rows) < length:
            break
        last = index[length - 1:]
        inside = rows[:len(last)] == rows[length - 1:]
        # a gram is the number of its prefix among the distinct ones and its last word
        keys = pa.array(np.where(inside, grams[:len(last)] * len(words) + last, -1))
        encoded = keys.dictionary_encode()
        distinct = encoded.dictionary.to_numpy()
        before, word = np.divmod(distinct, len(words))
        # the key of runs over a border hashes as anything; it is dropped below
        starts = crcs[np.maximum(before, 0)].tolist()
        crcs = np.fromiter((crc32(spaced[w], c) for w, c in zip(word.tolist(), starts)),
                           np.uint32, len(distinct))
        grams = encoded.indices.to_numpy().astype(np.int64)
        out.append((rows[:len(last)][inside], (crcs % buckets)[grams[inside]]))
    return np.bincount(rows, minlength=len(texts)), out


def packed_features(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and the buckets of all features of each text, packed in one binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            n_words, parts = feature_buckets(batch.column(1))
            row = np.concatenate([r for r, _ in parts])
            bucket = np.concatenate([b for _, b in parts]).astype(PACKED)
            order = np.argsort(row, kind="stable")
            ends = np.cumsum(np.bincount(row, minlength=batch.num_rows)) * PACKED.itemsize
            offsets = np.concatenate([[0], ends]).astype(np.int64)
            column = pa.Array.from_buffers(
                pa.large_binary(), batch.num_rows,
                [None, pa.py_buffer(offsets), pa.py_buffer(bucket[order].tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), column.cast(pa.binary())],
                names=["doc_id", "n_words", "features"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, features binary")


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all rows and where each row's begin and end."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    every = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.empty(0, np.uint8)
    return every.view(PACKED), (offsets - offsets[0]) // PACKED.itemsize


def bucket_counts(packed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket: one number per bucket and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(unpacked(batch.column(0))[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    rows = packed.select("features").mapInArrow(run, "bucket long, n long")
    table = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most one per bucket
    counts = np.zeros(buckets, np.int64)
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of smoothed shares in target and source, rounded down."""
    k, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (all_s + k)) / ((s + 1.0) * (all_t + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighted(packed: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight. The gains are one number per bucket."""
    table = pa.array(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, ends = unpacked(batch.column(2))
            sums = np.concatenate([[0], np.cumsum(table.take(pa.array(buckets)).to_numpy())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(ends), pa.int64()),
                 pa.array(np.diff(sums[ends]), pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"])

    return packed.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def weights(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document towards the texts of `target`."""
    packed = cut_lineage(packed_features(docs))
    wanted = packed_features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    return weighted(packed, bucket_gains(bucket_counts(packed), bucket_counts(wanted)))


def with_score(rows: DataFrame, seed: int = 42) -> DataFrame:
    """Add score: the weight and Gumbel noise in thousandths, from a hash of seed and doc_id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + noise)


def ranked(rows: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add rank: 1 for the highest score. Rows of one order are never all in one task."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"),
             F.col("weight"), F.col("__at")]
    rows = rows.withColumn("__at", F.monotonically_increasing_id())  # parts equal rows too
    ranges = math.ceil(rows.count() / range_rows) or 1
    # written, so that the borders stay as they are
    dealt = cut_lineage(rows.repartitionByRange(ranges, *order)
                        .withColumn("__range", F.spark_partition_id()))
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)
    # one row per range
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return (dealt.withColumn("__place", place).join(offsets, "__range")
            .withColumn("rank", F.col("__place") + F.col("__before"))
            .drop("__at", "__range", "__place", "__before"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null where the
    document was not drawn. `percent` of the documents with `min_words` words are drawn."""
    rows = cut_lineage(with_score(weights(docs, target), seed))
    able = F.col("n_words") >= min_words
    drawn = rows.where(able).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank")
    return ranked(rows.where(able)).select(*columns, rank).union(
        rows.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


def sampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The drawn documents with all their columns; rows that share a doc_id go together."""
    ids = resample(docs, target, percent).where("rank is not null").select(
        F.col("doc_id").alias("__id")).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
