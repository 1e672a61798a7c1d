"""Model frames: label codes, one-hot columns, column pruning, feature and outcome frames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.functions.columns import q
from liftlens.operators.clean import first_by
from liftlens.operators.periods import at_horizon
from liftlens.operators.scale import HotKeys, cut_lineage, lookup_join, skew_join
from liftlens.operators.shape import GROUP, label_codes

KEYS = ["emp_id", "treatment_id"]


def label_encode(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Replace the columns by their codes; also gives the code table."""
    codes = cut_lineage(label_codes(df, columns))
    for c in columns:
        one = codes.where(F.col("Segment_Name") == c).select(
            F.col("Segments").alias(c), F.col("Segment").alias("__code")
        )
        df = lookup_join(df, one, [c]).withColumn(c, F.col("__code")).drop("__code")
    return df, codes


def encode_ids(df: DataFrame, codes: DataFrame, column: str = "treatment_id") -> DataFrame:
    """Swap an id for its code from a (id, mapped_value) table."""
    return (
        lookup_join(df, codes.select(q(column), "mapped_value"), [column])
        .drop(column)
        .withColumnRenamed("mapped_value", column)
    )


def one_hot(df: DataFrame, columns: Sequence[str], max_levels: int | None = None) -> DataFrame:
    """0/1 columns `<column>_<level>` for every level that occurs. Levels become columns, so a
    caller may state how many are too many; `one_hot_vector` suits any number."""
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), q(c).cast("string").alias("v"))
                      for c in columns])
    found = (
        df.select(F.inline(pairs)).where(F.col("v").isNotNull()).distinct()
    )
    found = (found if max_levels is None else found.limit(max_levels + 1)).collect()
    if max_levels is not None and len(found) > max_levels:
        raise ValueError(f"more than {max_levels} levels; use one_hot_vector")
    levels = sorted((columns.index(r["c"]), r["v"]) for r in found)
    dummies = [
        F.coalesce((q(columns[i]).cast("string") == F.lit(v)).cast("int"), F.lit(0))
        .alias(f"{columns[i]}_{v}")
        for i, v in levels
    ]
    return df.select(*[q(c) for c in df.columns if c not in set(columns)], *dummies)


def one_hot_vector(df: DataFrame, columns: Sequence[str], output: str) -> DataFrame:
    """Sparse one-hot vectors `<output>_<column>`, for factors with any number of levels.

    Levels are numbered in sorted order by a distributed ranking and meet the rows in a join; the
    driver sees their number only. A missing value has a vector without entries."""
    codes = cut_lineage(label_codes(df, columns))
    sizes = {r["Segment_Name"]: r["count"] for r in codes.groupBy("Segment_Name").count().collect()}
    kept = df.columns
    for i, c in enumerate(columns):
        one = codes.where(F.col("Segment_Name") == c).select(
            F.col("Segments").alias(f"__level{i}"), F.col("Segment").alias(f"__code{i}"))
        df = lookup_join(df.withColumn(f"__level{i}", q(c).cast("string")), one, [f"__level{i}"])
    df = df.select(*[q(c) for c in kept], *[F.col(f"__code{i}") for i in range(len(columns))])

    def vectors(codes: pa.Array, size: int) -> pa.Array:
        known = codes.is_valid().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(known)]).astype(np.int32)
        index = codes.drop_null().cast(pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(len(codes), np.int8)), pa.array(np.full(len(codes), size, np.int32)),
             pa.ListArray.from_arrays(ends, index),
             pa.ListArray.from_arrays(ends, pa.array(np.ones(len(index))))],
            names=["type", "size", "indices", "values"])  # the stored form of a sparse vector

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*kept, *[f"{output}_{c}" for c in columns]]
        for batch in batches:
            made = [vectors(batch.column(len(kept) + i), sizes.get(c, 0)) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *made], names=names)

    schema = T.StructType([*df.schema.fields[:len(kept)],
                           *[T.StructField(f"{output}_{c}", VectorUDT()) for c in columns]])
    return df.mapInArrow(run, schema)


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with at most one distinct non-null value: least equals greatest."""
    columns = list(columns or df.columns)
    row = df.agg(
        *[F.coalesce(F.min(q(c)) == F.max(q(c)), F.lit(True)).alias(f"c{i}")
          for i, c in enumerate(columns)]
    ).first()
    return [c for i, c in enumerate(columns) if row[f"c{i}"]]


def drop_constant(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    gone = set(constant_columns(df, columns))
    return df.select(*[q(c) for c in df.columns if c not in gone])


def drop_all_null(df: DataFrame, suffix: str = " predictions") -> DataFrame:
    """Drop columns without any value; an empty `X predictions` takes `X` and `X_pre` along."""
    row = df.agg(*[F.count(q(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    gone = {c for i, c in enumerate(df.columns) if row[f"c{i}"] == 0}
    for c in list(gone):
        if c.endswith(suffix):
            base = c[: -len(suffix)]
            gone |= {base, f"{base}_pre"}
    return df.select(*[q(c) for c in df.columns if c not in gone])


def feature_frame(
    population: DataFrame,
    eligibility: DataFrame,
    segment: DataFrame,
    kpis: Sequence[str],
    covariates: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Rows before the treatment with the treated flag and the employee's segments."""
    wanted = population.select(*KEYS, *[q(c) for c in [*kpis, *covariates]])
    flags = first_by(eligibility, [*KEYS, GROUP], ["treatment_allocated_date"])
    flagged = skew_join(wanted, flags.select(*KEYS, q(GROUP)), KEYS, hot=hot)
    others = [c for c in segment.columns if c != "emp_id"]
    unique = first_by(segment, ["emp_id"], others)
    return skew_join(flagged, unique, ["emp_id"], "left", hot)


def outcome_frame(
    features: DataFrame,
    outcome: DataFrame,
    days: int,
    kpis: Sequence[str],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Features with the KPIs at one horizon; earlier KPI values get the suffix `_pre`."""
    rows = at_horizon(outcome, days)
    unique = first_by(rows, [*KEYS, "date_diff"], ["start_date", "end_date", *kpis])
    before = features.withColumnsRenamed({k: f"{k}_pre" for k in kpis})
    return skew_join(before, unique.select(*KEYS, *[q(k) for k in kpis]), KEYS, hot=hot)


def attach_weights(
    df: DataFrame, scores: DataFrame, name: str = "weights", hot: HotKeys | None = None
) -> DataFrame:
    """Give each row the probability of its (employee, treatment) as weight."""
    return skew_join(df, scores.select(*KEYS, F.col("probability").alias(name)), KEYS, hot=hot)
