"""Time: data grain, periods before and after a treatment, daily aggregation, sufficiency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.columns import (
    day_diff,
    period_status,
    q,
    quoted,
    snap_days,
    snap_limit,
)
from liftlens.operators.scale import HotKeys, cut_lineage, grouped_quantiles, skew_join

KEYS = ["emp_id", "treatment_id"]
AGGREGATES = {
    "sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count,
}


def grain_counts(population: DataFrame, limit: int = 20) -> DataFrame:
    """Largest number of rows of one (employee, treatment), and the grain it implies."""
    counts = population.groupBy(*KEYS).agg(F.count("emp_id").alias("n"))
    return counts.agg(F.max("n").alias("max_rows")).select(
        "max_rows", F.when(F.col("max_rows") > limit, "daily").otherwise("agg").alias("grain")
    )


def detect_grain(population: DataFrame, limit: int = 20) -> str:
    return grain_counts(population, limit).first()["grain"]


def _allocations(treatment: DataFrame) -> DataFrame:
    return treatment.select(
        *KEYS, "treatment_allocated_date", "treatment_allocated_end_date"
    ).distinct()


def _dated(population: DataFrame, treatment: DataFrame, date: str, hot: HotKeys | None):
    """Rows with their allocation window and `__days` before its start. Snapping keeps the
    sign, so `__days > 0` is the plain form of the status `pre`."""
    joined = skew_join(population, _allocations(treatment), KEYS, hot=hot)
    return joined.withColumn("__days", day_diff(F.col("treatment_allocated_date"), q(date)))


def pre_post(
    population: DataFrame, treatment: DataFrame, hot: HotKeys | None = None
) -> tuple[DataFrame, DataFrame]:
    """Aggregated form: rows before the treatment, and rows after it with the (snapped) days
    from the end of the allocation to the end of the row's period."""
    rows = _dated(population, treatment, "start_date", hot)
    helpers = ["__days", "treatment_allocated_date", "treatment_allocated_end_date"]
    pre = rows.where(F.col("__days") > 0).withColumn("date_diff", snap_days(F.col("__days")))
    after = day_diff(F.col("end_date"), F.col("treatment_allocated_end_date"))
    post = rows.where(F.col("__days") <= 0).withColumn("__after", after)
    post = post.where(F.col("__after") >= 0).withColumn("date_diff", snap_days(F.col("__after")))
    return pre.drop(*helpers), post.drop(*helpers, "__after")


def aggregate_kpis(
    df: DataFrame, keys: Sequence[str], kpis: Mapping[str, str], date: str | None = None
) -> DataFrame:
    """One row per key with each KPI under its own aggregate, and the first and last date.
    All medians are ranked together in distributed form, as one group may be of any size; the rows
    are then written once and read by both passes."""
    medians = [k for k, fn in kpis.items() if fn == "median"]
    if medians:
        df = cut_lineage(df.select(*[q(c) for c in dict.fromkeys([*keys, *kpis, *([date] if date else [])])]))
    plain = {k: fn for k, fn in kpis.items() if fn != "median"}
    unknown = sorted(set(plain.values()) - set(AGGREGATES))
    if unknown:
        raise ValueError(f"unknown aggregates: {unknown}")
    columns = [AGGREGATES[fn](q(k)).alias(k) for k, fn in plain.items()]
    if date:
        columns += [F.min(q(date)).alias("start_date"), F.max(q(date)).alias("end_date")]
    out = df.groupBy(*[q(k) for k in keys]).agg(*(columns or [F.count("*").alias("__n")]))
    if medians:
        middle = grouped_quantiles(df, keys, {k: 0.5 for k in medians}).select(
            *[q(k).alias(f"__t{i}") for i, k in enumerate(keys)], *[q(k) for k in medians])
        same = reduce(and_, [q(k).eqNullSafe(F.col(f"__t{i}")) for i, k in enumerate(keys)])
        out = out.join(middle, same, "left")
    order = [*keys, *kpis, *(["start_date", "end_date"] if date else [])]
    return out.select(*[q(c) for c in order])


def daily_windows(
    population: DataFrame,
    treatment: DataFrame,
    kpis: Mapping[str, str],
    pre_days: Sequence[int],
    post_days: Sequence[int],
    hot: HotKeys | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Daily form as (before, after): `daily_periods` by status, aggregated and written once."""
    both = cut_lineage(daily_periods(population, treatment, kpis, pre_days, post_days, hot))
    return tuple(both.where(F.col("status") == s).drop("status") for s in ("pre", "post"))


def daily_periods(
    population: DataFrame,
    treatment: DataFrame,
    kpis: Mapping[str, str],
    pre_days: Sequence[int],
    post_days: Sequence[int],
    hot: HotKeys | None = None,
) -> DataFrame:
    """KPIs per employee and treatment over the last `d` days before the allocation starts
    (`pre`), and over the first `d` days from its end (`post`). Every window length is a
    condition inside one aggregate, so rows are read and shuffled once."""
    rows = _dated(population, treatment, "date", hot)
    rows = rows.withColumn(
        "__late", day_diff(F.col("date"), F.col("treatment_allocated_end_date")))
    windows = {("pre", d): f"__days BETWEEN 1 AND {snap_limit(d)}" for d in pre_days}
    windows |= {("post", d): f"__days <= 0 AND __late BETWEEN 0 AND {d}" for d in post_days}
    return _windowed(rows, kpis, windows)


def _windowed(rows: DataFrame, kpis: Mapping[str, str], windows: Mapping[tuple, str]):
    columns = [*KEYS, *kpis, "start_date", "end_date", "date_diff", "status"]
    if any(fn == "median" for fn in kpis.values()):
        tags = F.array(*[F.when(F.expr(cond), F.struct(F.lit(s).alias("status"),
                                               F.lit(d).alias("date_diff")))
                         for (s, d), cond in windows.items()])
        tagged = rows.select("*", F.inline(F.array_compact(tags)))
        return aggregate_kpis(tagged, [*KEYS, "status", "date_diff"], kpis, "date").select(
            *[q(c) for c in columns])
    aggregates, structs = [], []
    for i, ((status, d), cond) in enumerate(windows.items()):
        inside = lambda c: F.expr(f"CASE WHEN {cond} THEN {quoted(c)} END")
        aggregates += [AGGREGATES[fn](inside(k)).alias(f"{i}:{k}") for k, fn in kpis.items()]
        aggregates += [F.min(inside("date")).alias(f"{i}:start"),
                       F.max(inside("date")).alias(f"{i}:end")]
        values = [f"`{i}:{k.replace('`', '``')}` AS {quoted(k)}" for k in kpis]
        structs.append(f"struct({', '.join(values)}, `{i}:start` AS start_date, "
                       f"`{i}:end` AS end_date, {d} AS date_diff, '{status}' AS status)")
    wide = rows.groupBy(*KEYS).agg(*aggregates)
    long = wide.selectExpr(*KEYS, f"inline(array({', '.join(structs)}))")
    return long.where(F.col("start_date").isNotNull())


def at_horizon(outcome: DataFrame, days: int) -> DataFrame:
    """Outcome rows of one horizon, however few."""
    return outcome.where(F.col("date_diff") == days)


def treated_only(df: DataFrame, flag: str = "Control/Test_group") -> DataFrame:
    return df.where(q(flag) == 1)


def sufficiency(
    pre: DataFrame,
    post: DataFrame,
    windows: DataFrame,
    pre_days: Sequence[int],
    post_days: Sequence[int],
) -> DataFrame:
    """Per treatment and configured length: rows available and whether they suffice (10 rows
    of at most that age before, one row of exactly that age after)."""
    before = day_diff(F.col("treatment_allocated_date"), F.col("start_date"))
    after = day_diff(F.col("end_date"), F.col("treatment_allocated_end_date"))
    windows = F.broadcast(windows)  # one row per configured treatment

    def counted(rows: DataFrame, days: Column, lengths, period: str, hit, minimum: int):
        rows = rows.join(windows, "treatment_id").withColumn("__days", days)
        counts = rows.groupBy("treatment_id").agg(
            *[F.count_if(hit(F.col("__days"), d)).alias(f"n{d}") for d in lengths])
        complete = windows.select("treatment_id").join(counts, "treatment_id", "left")
        return complete.select("treatment_id", F.inline(F.array(*[
            F.struct(F.lit(period).alias("period"), F.lit(d).alias("days"),
                     F.coalesce(F.col(f"n{d}"), F.lit(0)).alias("available"),
                     (F.coalesce(F.col(f"n{d}"), F.lit(0)) >= minimum).cast("int").alias("ok"))
            for d in lengths])))

    return counted(pre, before, pre_days, "pre", lambda c, d: c <= d, 10).unionByName(
        counted(post, after, post_days, "post", lambda c, d: c == d, 1)
    )
