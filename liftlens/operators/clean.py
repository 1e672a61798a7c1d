"""Cleaning: treatment filter, null rows, first row per key, outlier clipping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftlens.functions.columns import q, quoted
from liftlens.operators.scale import exact_quantiles


def keep_treatments(treatment: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Distinct rows of the configured treatments."""
    return treatment.where(F.col("treatment_id").isin(list(ids))).distinct()


def treatments_without_rows(treatment: DataFrame, ids: Sequence[str]) -> DataFrame:
    wanted = treatment.sparkSession.createDataFrame([(i,) for i in ids], "treatment_id string")
    found = treatment.select("treatment_id").distinct()
    return F.broadcast(wanted).join(found, "treatment_id", "left_anti")


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def null_row_report(df: DataFrame, steps: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows lost when the steps' null filters are applied one after the other, in one pass."""
    alive: Column = F.lit(True)
    aggregates = []
    for i, columns in enumerate(steps.values()):
        has_null = F.lit(False)
        for c in columns:
            has_null = has_null | q(c).isNull()
        aggregates.append(F.count_if(alive & has_null).alias(f"s{i}"))
        alive = alive & ~has_null
    counts = df.agg(*aggregates)
    rows = [F.struct(F.lit(name).alias("step"), F.col(f"s{i}").alias("rows_lost"))
            for i, name in enumerate(steps)]
    return counts.select(F.inline(F.array(*rows)))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in a stated order (nulls first). An aggregate, not a window: copies
    of a hot key shrink to one row per task before the shuffle."""
    rest = [c for c in df.columns if c not in set(keys)]
    ranked = [*order, *[c for c in rest if c not in set(order)]]
    if not ranked:
        return df.distinct()
    first = f"min(struct({', '.join(quoted(c) for c in ranked)})) AS __first"
    return (
        df.groupBy(*keys)
        .agg(F.expr(first))
        .selectExpr(*[quoted(c) if c in set(keys) else f"__first.{quoted(c)} AS {quoted(c)}"
                      for c in df.columns])
    )


def clip_bounds(
    df: DataFrame, columns: Sequence[str], lo: float = 0.01, hi: float = 0.99, exact: bool = True
) -> dict[str, tuple[float, float]]:
    """Quantile bounds of all columns together; `exact=False` takes bounded sketches."""
    if exact:
        return {c: tuple(v) for c, v in exact_quantiles(df, {c: [lo, hi] for c in columns}).items()}
    row = df.agg(
        *[F.percentile_approx(q(c), F.array(F.lit(lo), F.lit(hi)), 10_000).alias(f"b{i}")
          for i, c in enumerate(columns)]
    ).first()
    return {c: tuple(row[f"b{i}"]) for i, c in enumerate(columns)}


def winsorize(
    df: DataFrame, columns: Sequence[str], lo: float = 0.01, hi: float = 0.99, exact: bool = True
) -> DataFrame:
    """Clip each column to its own [lo, hi] quantiles."""
    bounds = clip_bounds(df, columns, lo, hi, exact)
    clipped = {}
    for c, (a, b) in bounds.items():
        if a is None:
            continue
        x = q(c).cast("double")
        clipped[c] = F.when(x < F.lit(a), F.lit(a)).when(x > F.lit(b), F.lit(b)).otherwise(x)
    return df.withColumns(clipped)
