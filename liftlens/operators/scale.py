"""Shared means to keep work spread: lineage cuts, checked broadcasts, joins on hot keys,
running sums in global order and exact quantiles without a single-task group."""

from __future__ import annotations

import atexit
import math
import re
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from liftlens.functions.columns import q

BROADCAST_ROWS = 100_000  # most rows of a narrow lookup table that may be broadcast
COLLECT_ROWS = 100_000  # most distinct values that may sort in one task or on the driver


_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. Only where it is
    unset and driver and executors are one process, a local folder does; a cluster without a
    shared folder is an error, as its tasks would write to disks of their own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="liftlens-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once as a table in the shared folder and read it back. It survives the loss
    of executors, is computed a single time (an RDD checkpoint computes its last stage
    twice), and later passes prune columns and know its size."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/liftlens/{app}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, least: int) -> DataFrame:
    """`df`, a written table or columns of one, in one task per core, but with `least` rows or more in each. Tables are read in
    parts by their bytes, which leaves most cores idle where the work per row is long."""
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // least))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables that this application has written to the shared folder."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/liftlens/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def task_count(spark: SparkSession) -> int:
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions", "200")),
        spark.sparkContext.defaultParallelism,
    )


def most_hot_keys(tasks: int) -> int:
    """How many keys can each fill more than two average tasks, and some more."""
    return max(64, tasks // 2)


class HotKeys:
    """Key sets and, for each, the hashes of its hot keys and the salts the hottest needs."""

    def __init__(self):
        self._found: dict[tuple, tuple[list[int], int]] = {}

    def add(self, keys: Sequence[str], counts: Sequence[tuple[int, int]], total: int,
            tasks: int, min_rows: int) -> None:
        floor = max(min_rows, 2 * total / tasks)
        hot = [(h, n) for h, n in counts if n > floor]
        salts = math.ceil(2 * tasks * max(n for _, n in hot) / total) if hot else 1
        self._found[tuple(sorted(keys))] = ([h for h, _ in hot], salts)

    def get(self, keys: Sequence[str]):
        return self._found.get(tuple(sorted(keys)))


def key_hash64(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[q(k) for k in sorted(keys)])


def find_hot_keys(
    df: DataFrame, *key_sets: Sequence[str], min_rows: int = 100_000
) -> HotKeys:
    """Keys which alone would fill more than two average tasks. One pass over the key columns
    with a bounded sketch per key set. The counts only steer salting;
    results never depend on them. Rows that descend one to one from `df` by filters and
    lookups may use the same answer."""
    names = [f"h{i}" for i in range(len(key_sets))]
    most = most_hot_keys(task_count(df.sparkSession))
    tracked = max(10_000, 8 * most)
    row = (
        df.select(*[key_hash64(k).alias(n) for k, n in zip(key_sets, names)])
        .agg(F.count("*").alias("n"),
             *[F.expr(f"approx_top_k({n}, {most}, {tracked})").alias(n) for n in names])
        .first()
    )
    found = HotKeys()
    for keys, n in zip(key_sets, names):
        counts = [(t["item"], t["count"]) for t in (row[n] or [])]
        found.add(keys, counts, row["n"], task_count(df.sparkSession), min_rows)
    return found


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Equi-join (inner or left) whose left side may hold very many rows of one key.

    Hot keys only are salted: their left rows spread over salts derived from content and
    input split, their few right rows are repeated once per salt. All other keys join as
    usual, in the same shuffle. Without `hot` the keys of `big` are examined first.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    known = hot.get(keys) if hot is not None else None
    hashes, salts = known if known is not None else find_hot_keys(big, keys).get(keys)
    if not hashes:
        return big.join(small, list(keys), how)
    is_hot = key_hash64(keys).isin(hashes)
    spread = F.pmod(F.xxhash64(*[q(c) for c in big.columns], F.spark_partition_id()), F.lit(salts))
    left = big.withColumn("__salt", F.when(is_hot, spread.cast("int")).otherwise(F.lit(0)))
    right = small.withColumn(
        "__salt",
        F.explode(
            F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        ),
    )
    return left.join(right, [*keys, "__salt"], how).drop("__salt")


def lookup_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join to a lookup table that is unique on `keys`: broadcast if it is small by count,
    else the skew-safe shuffle join."""
    if fits_broadcast(small):
        return big.join(F.broadcast(small), list(keys), how)
    return skew_join(big, small, keys, how)


def running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    values: Sequence[str],
    limit: int = COLLECT_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """Add `before_<v>`: the sum of v over the rows of the group that sort before this row.

    `df` holds each (by, order) once; it is read twice. Rows are dealt to `buckets` ranges
    of (by, order), by default one for every `limit` rows, so large groups take many. Totals per
    range give offsets, and each range is ordered on its own. One range needs no offsets.
    """
    by = list(by)

    def before(parts: list[Column], order_col: str, names, source):
        w = Window.partitionBy(*parts).orderBy(q(order_col).asc())
        w = w.rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(q(s)).over(w), F.lit(0)).alias(n) for n, s in zip(names, source)]

    groups = [q(b) for b in by] or [F.lit(0)]
    names = [f"before_{v}" for v in values]
    size = df.count()
    ranges = (buckets if buckets and size > limit else None) or math.ceil(size / limit)
    if ranges <= 1:
        return df.select("*", *before(groups, order, names, values))
    # written, so that the borders and with them the ranges stay as they are
    rows = cut_lineage(df.repartitionByRange(ranges, *[q(c) for c in [*by, order]])
                       .withColumn("__range", F.spark_partition_id()))
    totals = rows.groupBy(*by, "__range").agg(*[F.sum(q(v)).alias(f"__t_{v}") for v in values])
    offsets = totals.select(
        *[q(b).alias(f"__b{i}") for i, b in enumerate(by)], F.col("__range").alias("__r"),
        *before(groups, "__range", [f"__o_{v}" for v in values], [f"__t_{v}" for v in values]),
    )
    within = rows.select(
        "*", *before([*groups, q("__range")], order, [f"__w_{v}" for v in values], values)
    )
    same = F.col("__range") == F.col("__r")
    for i, b in enumerate(by):
        same = same & q(b).eqNullSafe(F.col(f"__b{i}"))
    return within.join(offsets, same).select(
        *[q(c) for c in df.columns],
        *[(q(f"__w_{v}") + q(f"__o_{v}")).alias(f"before_{v}") for v in values],
    )


def quantile_sizes(columns: Sequence[str]) -> list[Column]:
    """The aggregates that `exact_quantiles` needs to choose its way, for use in a pass the
    caller makes anyway."""
    return [F.count(q(c)).alias(f"n:{c}") for c in columns] + [
        F.approx_count_distinct(q(c)).alias(f"d:{c}") for c in columns]


def exact_quantiles(
    df: DataFrame,
    probs: dict[str, Sequence[float]],
    limit: int = COLLECT_ROWS,
    sizes: Row | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of many columns, exact at any size.

    Small columns need one `percentile` aggregate. Larger ones are found by bracketing:
    a bounded sketch gives an interval around each target rank, counts prove that it holds
    the rank, and the interval shrinks until its distinct values are few enough to sort. All
    columns and ranks share the passes.
    """
    probs = {c: list(ps) for c, ps in probs.items() if len(ps)}
    if not probs:
        return {}
    sizes = sizes or df.agg(*quantile_sizes(list(probs))).first()
    small = [c for c in probs if sizes[f"d:{c}"] <= limit]
    out: dict[str, list[float | None]] = {}
    if small:
        row = df.agg(
            *[
                F.percentile(q(c), F.array(*[F.lit(float(p)) for p in probs[c]])).alias(f"p{i}")
                for i, c in enumerate(small)
            ]
        ).first()
        for i, c in enumerate(small):
            out[c] = list(row[f"p{i}"]) if row[f"p{i}"] is not None else [None] * len(probs[c])
    large = [c for c in probs if c not in out]
    if large:
        out |= _bracketed(df, {c: sizes[f"n:{c}"] for c in large}, {c: probs[c] for c in large}, limit)
    return out


@dataclass
class _Rank:
    """A wanted rank of a column and the bracket that is proven to hold it."""

    column: str
    position: float
    low: float = -math.inf
    high: float = math.inf
    below: int = 0  # rows under the bracket
    inside: int = 0
    pad: float = 0.004  # three times the sketch's error

    def ranks(self) -> tuple[float, float]:
        first, last = math.floor(self.position) - self.below, math.ceil(self.position) - self.below
        return first / self.inside - self.pad, (last + 1) / self.inside + self.pad


SKETCH = 4096  # items of a sketch's level; its ranks err by about 0.13 %


def _bracketed(df: DataFrame, n: dict[str, int], probs: dict[str, Sequence[float]],
               limit: int) -> dict[str, list[float]]:
    """Quantiles of many columns by brackets around each rank. A round is two passes for all open
    ranks of all columns: sketches that propose brackets and counts that prove them. The values
    left in the proven brackets are counted in one last pass, so the number of passes does not
    depend on the number of columns."""
    value = {c: F.when(F.isnan(q(c).cast("double")), F.lit(math.inf)).otherwise(q(c).cast("double"))
             for c in probs}
    wanted = [_Rank(c, p * (n[c] - 1), inside=n[c]) for c, ps in probs.items() for p in ps]
    todo = list(wanted)
    while todo:
        spans = {(r.column, r.low, r.high): f"s{i}" for i, r in enumerate(todo)}  # one sketch each
        within = lambda c, lo, hi: value[c].between(lo, hi)
        sketches = df.agg(*[F.kll_sketch_agg_double(F.when(within(*k), value[k[0]]), SKETCH).alias(s)
                            for k, s in spans.items()])
        ends = []
        for i, r in enumerate(todo):
            sketch = F.col(spans[r.column, r.low, r.high])
            for name, rank in zip("lh", r.ranks()):
                ends.append((F.kll_sketch_get_quantile_double(sketch, F.lit(rank)) if 0 < rank < 1
                             else F.lit(r.low if rank <= 0 else r.high)).alias(f"{name}{i}"))
        proposed = sketches.select(*ends).first()
        counts = []
        for i, r in enumerate(todo):
            inner = within(r.column, proposed[f"l{i}"], proposed[f"h{i}"])
            counts += [F.count_if(value[r.column] < proposed[f"l{i}"]).alias(f"b{i}"),
                       F.count_if(inner).alias(f"m{i}"),
                       F.approx_count_distinct(F.when(inner, value[r.column])).alias(f"d{i}")]
        seen = df.agg(*counts).first()
        still = []
        for i, r in enumerate(todo):
            below, inside = seen[f"b{i}"], seen[f"m{i}"]
            if below <= math.floor(r.position) and math.ceil(r.position) < below + inside:
                shrunk = inside < r.inside
                r.low, r.high, r.below, r.inside = proposed[f"l{i}"], proposed[f"h{i}"], below, inside
                if seen[f"d{i}"] > limit and shrunk:
                    still.append(r)
            else:
                r.pad *= 4  # the sketch missed the rank; ask for more
                still.append(r)
        todo = still
    columns = list(probs)
    spot = {c: reduce(or_, [value[c].between(r.low, r.high) for r in wanted if r.column == c])
            for c in columns}
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("c"), F.when(spot[c], value[c]).alias("x")) for i, c in enumerate(columns)])))
    found: dict[str, list[tuple[float, int]]] = {c: [] for c in columns}
    for r in long.where("x is not null").groupBy("c", "x").count().collect():
        found[columns[r["c"]]].append((r["x"], r["count"]))
    result: dict[str, list[float]] = {c: [] for c in columns}
    for r in wanted:
        low, high, values, reached = math.floor(r.position), math.ceil(r.position), {}, r.below
        for x, count in sorted(found[r.column]):
            if r.low <= x <= r.high:
                values |= {k: x for k in (low, high) if reached <= k < reached + count}
                reached += count
        a, b = values[low], values[high]
        result[r.column].append(a if a == b else (high - r.position) * a + (r.position - low) * b)
    return result


def grouped_quantile(
    df: DataFrame, keys: Sequence[str], value: str, p: float, alias: str, **kw
) -> DataFrame:
    """Exact quantile per group, for groups of any size."""
    renamed = df.select(*[q(k) for k in keys], q(value).alias(alias))
    return grouped_quantiles(renamed, keys, {alias: p}, **kw).where(q(alias).isNotNull())


def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], probs: dict[str, float], **kw
) -> DataFrame:
    """Exact quantiles of several columns per group, for groups of any size, from one pass: the
    values of all columns are counted together, ranked by one `running_sum`, and only the two
    neighbours of each target rank are kept. A group without a value gets null."""
    columns, by = list(probs), [*keys, "__column"]
    long = df.select(*[q(k) for k in keys], F.inline(F.array(*[
        F.struct(F.lit(i).alias("__column"), q(c).cast("double").alias("__x"))
        for i, c in enumerate(columns)])))
    counts = cut_lineage(long.groupBy(*[q(k) for k in by], "__x").agg(F.count("__x").alias("c")))
    ranked = running_sum(counts.where("__x is not null"), by, "__x", ["c"], **kw)
    totals = counts.groupBy(*[q(k) for k in by]).agg(F.sum("c").alias("__n")).select(
        *[q(k).alias(f"__t{i}") for i, k in enumerate(by)], "__n")
    same = reduce(and_, [q(k).eqNullSafe(F.col(f"__t{i}")) for i, k in enumerate(by)])
    p = reduce(lambda rest, i: F.when(F.col(f"__t{len(keys)}") == i, float(probs[columns[i]])).otherwise(rest),
               range(len(columns)), F.lit(0.0))
    r = totals.join(ranked, same, "left").withColumn("__pos", p * (F.col("__n") - 1))
    holds = lambda rank: (F.col("before_c") <= rank) & (rank < F.col("before_c") + F.col("c"))
    lo, hi = F.floor("__pos"), F.ceil("__pos")
    values = []
    for i, c in enumerate(columns):
        own = F.col(f"__t{len(keys)}") == i
        a, b = (F.max(F.when(own & holds(rank), F.col("__x"))) for rank in (lo, hi))
        part = F.max(F.when(own, F.col("__pos") - F.floor("__pos")))
        values.append((a + (b - a) * part).alias(c))
    return r.groupBy(*[F.col(f"__t{i}").alias(k) for i, k in enumerate(keys)]).agg(*values)
