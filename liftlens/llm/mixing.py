"""Mix sources to target weights along a van der Corput schedule.

Each source's documents are shuffled by a hash and cut into blocks of equal word count. A
source that needs more words than it has runs through its blocks a second time. The schedule
has 2^m points, the van der Corput sequence of base 2 (slot i stands at the bit reversal of i);
the cumulative weights of the sources, in blocks, divide these points among them, the slots of
a source are ranked, and its k-th slot takes its k-th block. The grid makes the number of
slots of a source exact, so a source misses its target only by the rounding to whole words.

Running sums and ranks are worked out in two steps (totals of sqrt(n) ranges, then inside each
range), so no source, however large, is held by one task. DataFrame functions only.

Defined results: a null text has size 0; a null source is a source of its own, ordered last;
documents of size 0 take 0 words; equal rows are kept apart; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlens.llm.common import WORD
from liftlens.operators.scale import cut_lineage

BLOCK_WORDS = 1024
WEIGHTS = (5, 2, 1)


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the shuffling key of every document."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"),
    )


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sid, source, source_size, target per source (one row each, as many as a mixture has).

    The sources share 3/2 of all sizes by weight; a target stops at twice its source's size and
    the excess goes to the others by weight. With sources in order of size/weight the capped
    ones come first, so two running sums give the common share; all sums are whole numbers."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("sid") - 1) % len(weights) + 1).cast("int")).cast("long")
    order = Window.orderBy(F.col("source").isNull(), "source")
    fill = Window.orderBy((F.col("source_size") / F.col("w")), "sid")
    whole = Window.partitionBy()
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("sid", F.row_number().over(order)).withColumn("w", weight)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "*", F.sum("source_size").over(whole).alias("all"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("capped"),
        (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("open_w"))
    # twice the words left for the open sources; this one is capped if its share reaches 2 * size
    left = 3 * F.col("all") - 4 * F.col("capped")
    is_capped = F.col("w") * left >= 4 * F.col("source_size") * F.col("open_w")
    per = per.withColumn("left", left).withColumn("is_capped", is_capped)
    # the share of the open sources is the one at the first that is not capped
    share = F.min(F.when(~F.col("is_capped"), F.struct(
        F.col("source_size") / F.col("w"), F.col("sid"), F.col("left"), F.col("open_w")))).over(whole)
    per = per.withColumn("at", share)
    return per.select(
        "sid", "source", "source_size",
        F.when(F.col("is_capped"), F.col("source_size") * 2.0)
        .otherwise(F.col("w") * F.col("at.left") / (F.col("at.open_w") * 2.0)).alias("target"))


def reversed_bits(cell, bits: int):
    return F.conv(F.reverse(F.lpad(F.bin(cell), bits, "0")), 2, 10).cast("long")


def schedule(quotas: DataFrame, bits: int) -> DataFrame:
    """slot, sid, rank: a slot of the schedule and the rank of it among those of its source.

    `quotas`: sid, first (start of its interval on the grid of 2^bits points), slots. A point c
    of the grid is the value of slot reversed_bits(c)."""
    step = 1 << 12
    runs = quotas.where("slots > 0").select(
        "sid", "first", "slots",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(step).cast("long")))
        .alias("at"))
    runs = runs.repartition(F.col("sid"), F.col("at"))
    cell = F.col("first") + F.col("k")
    slots = runs.select(
        "sid", "first",
        F.explode(F.sequence("at", F.least(F.col("at") + step, F.col("slots")) - 1)).alias("k"),
    ).select("sid", reversed_bits(cell, bits).alias("slot"))
    return slots if bits == 0 else ranked(slots, bits)


def ranked(slots: DataFrame, bits: int) -> DataFrame:
    """Ranks from 0 per sid by slot: counts of ranges of slots first, then inside each range."""
    slots = slots.withColumn("part", F.shiftright("slot", bits // 2))
    before = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = slots.groupBy("sid", "part").agg(F.count("*").alias("n")).select(
        "sid", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("sid", "part").orderBy("slot")
    return slots.withColumn("row", F.row_number().over(inside) - 1).join(
        starts.hint("merge"), ["sid", "part"]).select(
        "slot", "sid", (F.col("start") + F.col("row")).alias("rank"))


def placed(sized: DataFrame, per: DataFrame, n: int) -> DataFrame:
    """The documents with the facts of their source and `start`, the words before them in its
    shuffled stream; (part, row, sid) tells equal rows apart."""
    parts = max(1, math.isqrt(n))
    u = F.conv(F.substring("h", 1, 13), 16, 10).cast("double") / float(1 << 52)
    docs = sized.withColumn("part", F.floor(u * parts).cast("long"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = docs.groupBy("source", "part").agg(F.sum("size").alias("n")).select(
        "source", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    facts = per.withColumnRenamed("source", "per_source")
    starts = starts.join(facts, F.col("source").eqNullSafe(F.col("per_source"))).drop("per_source")
    starts = starts.withColumnRenamed("source", "s").withColumnRenamed("part", "p")
    inside = Window.partitionBy("source", "part").orderBy("h", "doc_id", "size")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.select("*", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("inner"),
                       F.row_number().over(inside).alias("row"))
    starts = starts.hint("merge")  # as many rows as ranges: too many to broadcast at scale
    return docs.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))) \
        .withColumn("start", F.col("part_start") + F.col("inner")).drop("s", "p", "inner", "part_start")


def pieces(docs: DataFrame, block: int) -> DataFrame:
    """One row for each document and block of the doubled stream that it overlaps: sid, rank,
    words, and `from`, the word of the document at which the piece begins. The last block ends
    at the quota. A document of which nothing is taken gives rows with a rank below 0."""
    quota = F.floor("target").cast("long")
    docs = docs.withColumn("quota", quota).withColumn(
        "begin", F.explode(F.array("start", F.col("start") + F.col("source_size"))))
    docs = docs.withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("quota")))
    used = F.col("end") > F.col("begin")
    ranks = F.when(used, F.sequence(
        F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block)))
    # no block holds a piece without words; ranks below 0 spread such rows over the join
    nowhere = F.array(-1 - F.pmod(F.xxhash64("h", "row"), F.lit(1 << 40)))
    docs = docs.withColumn("rank", F.explode(F.coalesce(ranks, nowhere)))
    low = F.greatest(F.col("begin"), F.col("rank") * block)
    high = F.least(F.col("end"), (F.col("rank") + 1) * block)
    return docs.withColumn("from", low - F.col("begin")).withColumn(
        "words", F.when(F.col("rank") < 0, 0).otherwise(high - low).cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mixture: slot (its place), and what the slot's block holds of which document (doc_id,
    source, from, words). Documents that no block holds have one row with a null slot."""
    sized = cut_lineage(sizes(docs))
    n = sized.count()
    per = cut_lineage(targets(sized, weights))
    slots = F.ceil(F.floor("target") / block_words).cast("long")
    quotas = per.select("sid", slots.alias("slots"))
    running = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    quotas = quotas.withColumn("first", F.coalesce(F.sum("slots").over(running), F.lit(0)))
    points = quotas.agg(F.sum("slots")).first()[0] or 0
    bits = max(1, math.ceil(math.log2(points))) if points > 1 else 1
    cut = pieces(placed(sized, per, n), block_words)
    plan = schedule(quotas, bits)
    return cut.join(plan.hint("merge"), ["sid", "rank"], "left")


def words_taken(mixed: DataFrame) -> DataFrame:
    """Per document the words that the mixture takes of it, in how many pieces, and the first slot of
    the schedule that holds one of them (null: none does)."""
    held = F.col("slot").isNotNull()
    return mixed.groupBy("sid", "part", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("source").alias("source"),
        F.first("size").alias("size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        F.sum(F.when(held, F.col("words")).otherwise(0)).alias("taken"),
        F.count("slot").alias("n_pieces"), F.min("slot").alias("first_slot"),
    ).drop("sid", "part", "row")
