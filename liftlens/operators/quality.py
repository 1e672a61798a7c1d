"""Data-quality profile and the validation report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.config import StudyConfig
from liftlens.functions.columns import q
from liftlens.operators.clean import null_row_report, treatments_without_rows
from liftlens.operators.periods import sufficiency
from liftlens.operators.scale import exact_quantiles
from liftlens.operators.shape import GROUP, type_mismatches

NULL_FLAG = 10.0  # flagged above this share, in %
OUTLIER_FLAG = 5.0  # flagged from this share, in %


def profiled(df: DataFrame) -> DataFrame:
    """Without index columns (`Unnamed:` or `#` in the name)."""
    return df.select(*[q(c) for c in df.columns if "Unnamed:" not in c and "#" not in c])


def null_pct(df: DataFrame) -> DataFrame:
    """Share of nulls per column in %, all columns in one pass."""
    cols = df.columns
    counts = df.agg(F.count("*").alias("n"),
                    *[F.count(q(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"),
                     (F.try_divide(F.col("n") - F.col(f"c{i}"), F.col("n")) * 100).alias("null_pct"))
            for i, c in enumerate(cols)]
    return counts.select(F.inline(F.array(*rows)))


def duplicate_pct(df: DataFrame) -> DataFrame:
    """Rows and the share that repeats an earlier row, in %. Copies merge before the shuffle."""
    copies = df.groupBy(*[q(c) for c in df.columns]).agg(F.count("*").alias("__n"))
    return copies.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
                      F.count("*").alias("distinct_rows")).select(
        "n_rows", "distinct_rows",
        (F.try_divide(F.col("n_rows") - F.col("distinct_rows"), F.col("n_rows")) * 100)
        .alias("duplicate_pct"))


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """Share of values beyond k interquartile ranges, in % of all rows (two decimals)."""
    columns = list(columns or [c for c, t in df.dtypes if t in ("float", "double")])
    quartiles = exact_quantiles(df, {c: [0.25, 0.75] for c in columns})
    limits = {}
    for c, (a, b) in quartiles.items():
        if a is not None:
            limits[c] = (a - k * (b - a), b + k * (b - a))
    counts = df.agg(F.count("*").alias("n"), *[
        F.count_if((q(c) < F.lit(limits[c][0])) | (q(c) > F.lit(limits[c][1]))).alias(f"c{i}")
        if c in limits else F.lit(0).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").cast("bigint").alias("outliers"),
                     F.bround(F.try_divide(F.col(f"c{i}"), F.col("n")) * 100, 2)
                     .alias("outlier_pct"))
            for i, c in enumerate(columns)]
    return counts.select(F.inline(F.array(*rows)))


def quality_profile(df: DataFrame, table: str) -> DataFrame:
    """Long profile (table, column, metric, value, flagged)."""
    df = profiled(df)
    whole = F.lit("*").alias("column_name")
    flag = lambda hit: hit.cast("int").alias("flagged")
    parts = [
        null_pct(df).select("column_name", F.lit("null_pct").alias("metric"),
                            F.col("null_pct").alias("value"),
                            flag(F.col("null_pct") > NULL_FLAG)),
        duplicate_pct(df).select(whole, F.lit("duplicate_pct").alias("metric"),
                                 F.col("duplicate_pct").alias("value"),
                                 flag(F.col("duplicate_pct") > 0)),
    ]
    if any(t in ("float", "double") for _, t in df.dtypes):
        parts.append(iqr_outliers(df).select(
            "column_name", F.lit("outlier_pct").alias("metric"),
            F.col("outlier_pct").alias("value"), flag(F.col("outlier_pct") >= OUTLIER_FLAG)))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(table).alias("table_name"), "*")


def validation_report(
    cfg: StudyConfig,
    raw_treatment: DataFrame,
    treatment: DataFrame,
    population: DataFrame,
    pre: DataFrame,
    post: DataFrame,
    windows: DataFrame,
    eligible: DataFrame,
) -> DataFrame:
    """All checks as rows (check_id, entity, status, metric, message). `raw_treatment` still
    has its text types; `treatment` and `population` are renamed and typed."""
    spark = population.sparkSession

    def fact(check: str, entity: str, ok: bool, metric: int, message: str):
        return (check, entity, "ok" if ok else "failed", metric, message)

    missing = [k for k in cfg.kpis if k not in population.columns]
    known = set(raw_treatment.columns)
    unmapped = [k for k in cfg.treatment_columns if k not in known
                and cfg.treatment_columns[k] not in known]
    facts = spark.createDataFrame(
        [fact("kpis_configured", "config", bool(cfg.kpis), len(cfg.kpis), "KPIs configured"),
         fact("kpi_columns", "population", not missing, len(missing), "KPI columns missing"),
         fact("renamed_columns", "treatment", not unmapped, len(unmapped),
              "mapped columns missing")],
        "check_id string, entity string, status string, metric bigint, message string")

    def rows(df: DataFrame, check, entity, bad, metric, message):
        return df.select(
            F.lit(check).alias("check_id"), entity.alias("entity"),
            F.when(bad, "failed").otherwise("ok").alias("status"),
            metric.cast("bigint").alias("metric"), F.lit(message).alias("message"))

    absent = treatments_without_rows(treatment, cfg.treatment_ids).select(
        F.lit("treatment_rows").alias("check_id"), F.col("treatment_id").alias("entity"),
        F.lit("failed").alias("status"), F.lit(0).cast("bigint").alias("metric"),
        F.lit("configured treatment has no rows").alias("message"))
    types = {c: "timestamp" for c in cfg.treatment_columns.values() if "date" in c}
    typed = type_mismatches(raw_treatment, {c: t for c, t in types.items()
                                            if c in raw_treatment.columns})
    dates = ["start_date", "end_date"] if "start_date" in population.columns else ["date"]
    lost = null_row_report(population, {"KPI values": list(cfg.kpis),
                                        "keys and dates": ["emp_id", *dates]})
    enough = sufficiency(pre, post, windows, cfg.pre_days, cfg.post_days)
    arms = eligible.agg(F.min(q(GROUP)).alias("lo"), F.max(q(GROUP)).alias("hi"))
    two = (F.col("lo") == 0) & (F.col("hi") == 1)
    parts = [
        facts, absent,
        rows(typed, "types", F.col("column_name"), F.col("mismatches") > 0, F.col("mismatches"),
             "values that do not fit the column type"),
        rows(lost, "null_rows", F.col("step"), F.col("rows_lost") > 0, F.col("rows_lost"),
             "rows lost to nulls"),
        rows(enough, "sufficiency",
             F.concat_ws(" ", "treatment_id", "period", F.col("days").cast("string")),
             F.col("ok") == 0, F.col("available"), "rows available"),
        rows(arms, "two_groups", F.lit("eligibility"), ~F.coalesce(two, F.lit(False)),
             F.when(F.coalesce(two, F.lit(False)), 2).otherwise(1), "treated and control present"),
    ]
    return reduce(DataFrame.unionByName, parts)
