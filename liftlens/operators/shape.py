"""Ingest and shaping: names, columns, types, treated and control universe, eligibility."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.config import Treatment
from liftlens.functions.columns import parse_timestamp, q, treated_flag
from liftlens.operators.scale import cut_lineage, running_sum

TREATMENT_COLUMNS = [
    "emp_id",
    "treatment_allocated_date",
    "treatment_allocated_end_date",
    "treatment_id",
    "treatment_label_taken",
    "start_date_of_treatment_taken",
    "end_date_of_treatment_taken",
]
GROUP = "Control/Test_group"


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names that do not occur are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def project(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Keep the required columns, blank names skipped."""
    return df.select(*[q(c) for c in required if c.strip()])


def population_columns(kpis: Sequence[str], covariates: Sequence[str], grain: str) -> list[str]:
    period = ["date"] if grain == "daily" else ["start_date", "end_date"]
    return ["emp_id", *period, "treatment_id", *kpis, *covariates]


def covariates(df: DataFrame, reserved: Sequence[str]) -> list[str]:
    """Matching covariates: all columns but the reserved ones and every outcome that has a
    `_pre` twin."""
    names = set(df.columns)
    outcomes = {c for c in names if f"{c}_pre" in names}
    return [c for c in df.columns if c not in outcomes and c not in set(reserved)]


STORED = {
    "timestamp": ("timestamp_ntz",), "int": ("bigint",), "float": ("double",),
    "string": ("string",),
}


def _typed(name: str, kind: str, formats, stored: str) -> Column:
    c = q(name)
    if stored in STORED.get(kind, ()):
        return c  # already of the type: nothing to parse
    if kind == "timestamp":
        return parse_timestamp(c, formats)
    if kind == "int":  # truncates towards zero, also from text such as "12.7"
        return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
    if kind == "float":
        return c.try_cast("double")
    if kind == "string":
        return c.cast("string")
    raise ValueError(f"unknown type {kind!r}")


def enforce_types(
    df: DataFrame, schema: Mapping[str, str], formats=("yyyy-MM-dd", "MM-dd-yyyy")
) -> DataFrame:
    """Cast every named column (`string`, `int`, `float`, `timestamp`); misfits become null."""
    stored = dict(df.dtypes)
    return df.withColumns({c: _typed(c, kind, formats, stored[c]) for c, kind in schema.items()})


def type_mismatches(
    df: DataFrame, schema: Mapping[str, str], formats=("yyyy-MM-dd", "MM-dd-yyyy")
) -> DataFrame:
    """Per column: how many values are present but do not fit the type. All rows are checked."""
    stored = dict(df.dtypes)
    counts = df.agg(
        *[
            F.count_if(q(c).isNotNull() & _typed(c, kind, formats, stored[c]).isNull())
            .alias(f"m{i}")
            for i, (c, kind) in enumerate(schema.items())
        ]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("expected"),
                     F.col(f"m{i}").alias("mismatches"))
            for i, (c, kind) in enumerate(schema.items())
        ]
    )
    return counts.select(F.inline(pairs))


def distinct_pairs(df: DataFrame, keys: Sequence[str] = ("emp_id", "treatment_id")) -> DataFrame:
    return df.select(*[q(k) for k in keys]).distinct()


def treatment_windows(spark: SparkSession, treatments: Sequence[Treatment]) -> DataFrame:
    """Configured allocation windows, one row per treatment of the configuration."""
    rows = [(t.treatment_id, t.start, t.end) for t in treatments]
    day = lambda c: F.col(c).cast("timestamp_ntz")
    return spark.createDataFrame(rows, "treatment_id string, s string, e string").select(
        "treatment_id",
        day("s").alias("treatment_allocated_date"),
        day("e").alias("treatment_allocated_end_date"),
    )


def treatment_universe(
    treatment: DataFrame, population: DataFrame, windows: DataFrame
) -> DataFrame:
    """Treated rows plus, as controls, all (employee, treatment) pairs of the population that
    took nothing; allocation dates come from the configured windows.

    This is the full outer join of both tables on the pair. Written as a union, treated rows
    need no shuffle, and the anti join meets each pair once on both sides.
    """
    keys = ["emp_id", "treatment_id"]
    taken = treatment.drop("treatment_allocated_date", "treatment_allocated_end_date")
    controls = distinct_pairs(population, keys).join(
        distinct_pairs(treatment, keys), keys, "left_anti"
    )
    everyone = taken.unionByName(controls, allowMissingColumns=True)
    return everyone.join(F.broadcast(windows), "treatment_id", "left").select(
        *[q(c) for c in TREATMENT_COLUMNS]
    )


def with_treated_flag(treatment: DataFrame) -> DataFrame:
    return treatment.withColumn(GROUP, treated_flag(F.col("end_date_of_treatment_taken")))


def eligibility(treatment: DataFrame) -> DataFrame:
    return with_treated_flag(treatment).select(
        "emp_id", "treatment_id", "treatment_allocated_date", "treatment_allocated_end_date",
        q(GROUP),
    )


def treatment_names(treatment: DataFrame) -> DataFrame:
    """Distinct treatment ids with the label under which they were taken."""
    return treatment.select("treatment_id", "treatment_label_taken").distinct().dropna()


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes of all distinct values, counted from 0 in sorted order, for several columns:
    (Segments, Segment, Segment_Name) = (value, code, column)."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("Segment_Name"), q(c).cast("string").alias("Segments"))
          for c in columns]
    )
    values = (
        df.select(F.inline(pairs))
        .where(F.col("Segments").isNotNull())
        .distinct()
        .withColumn("one", F.lit(1))
    )
    # written, as the ranking reads it twice
    ranked = running_sum(cut_lineage(values), ["Segment_Name"], "Segments", ["one"])
    return ranked.select("Segments", F.col("before_one").cast("int").alias("Segment"),
                         "Segment_Name")
