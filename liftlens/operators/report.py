"""Published effect tables, model report and ranked insights in words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlens.functions.columns import plain_number, q
from liftlens.operators.effects import OVERALL
from liftlens.operators.scale import lookup_join
from liftlens.operators.stats import class_scores, confusion_pct

ATE = "Average_treatment_effect"
NOISE = 1e-9  # smaller effects are rounding of sums that cancel


def finalize_effects(effects: DataFrame, names: DataFrame, project: str) -> DataFrame:
    """Effects for publication: treatment label for id, project name, negative effects shown
    as 0 (with error 0 and interval [0,0]), two decimals half-even. The unclamped effect
    stays in `raw_effect`. `names` is (treatment_id, treatment_label); of several labels of an id
    the first in order is shown."""
    # an effect that is not known stays unknown
    shown = F.when(F.col(ATE) > NOISE, F.col(ATE)).when(F.col(ATE).isNotNull(), 0.0)
    none = shown == 0
    one_each = names.groupBy("treatment_id").agg(F.min("treatment_label").alias("treatment_label"))
    labelled = lookup_join(effects, one_each, ["treatment_id"])
    return labelled.select(
        "treatment_label", "KPI", "Segment_Name", "Segment",
        F.bround(shown, 2).alias(ATE),
        F.bround(F.when(none, 0.0).otherwise(F.col("Standard_Error")), 2).alias("Standard_Error"),
        F.when(none, "[0,0]").otherwise(F.col("CI")).alias("CI"),
        "Significance", F.lit(project).alias("project_name"), F.col(ATE).alias("raw_effect"))


def overall_effects(final: DataFrame) -> DataFrame:
    rows = final.where(F.col("Segment") == OVERALL).drop("Segment_Name", "Segment")
    return rows.orderBy("treatment_label", "KPI")


def segment_effects(final: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Segment rows; codes become names if `labels` (Segments, Segment, Segment_Name) is
    given. Segment is the segment column and Segment_Name its value, as published."""
    rows = final.where(F.col("Segment") != OVERALL)
    value = F.col("Segment")
    if labels is not None:
        names = labels.withColumn("Segment", F.col("Segment").cast("string"))
        rows = lookup_join(rows, names, ["Segment", "Segment_Name"])
        value = F.coalesce(F.col("Segments"), F.lit(OVERALL))
    others = [c for c in final.columns if c not in ("Segment", "Segment_Name")]
    return rows.select(*others, F.col("Segment_Name").alias("Segment"),
                       value.alias("Segment_Name")).orderBy("treatment_label", "KPI")


def rank_avg(df: DataFrame, by: Sequence[str], column: str, name: str = "Rank") -> DataFrame:
    """Descending rank within groups; ties share the mean of their places. Runs on effect
    tables, whose groups hold one row per KPI and segment value."""
    group = [q(c) for c in by]
    order = Window.partitionBy(*group).orderBy(q(column).desc())
    ties = F.count("*").over(Window.partitionBy(*group, q(column)))
    return df.withColumn(name, F.rank().over(order) + (ties - 1) / 2.0)


def top_insights(segments: DataFrame, k: int = 10) -> DataFrame:
    """The k largest significant effects among the best of each treatment and segment."""
    best = rank_avg(segments, ["treatment_label", "Segment_Name"], ATE).where(
        (F.col("Rank") == 1) & (F.col("Significance") == "Significant"))
    return best.orderBy(F.desc(ATE), "treatment_label", "KPI", "Segment", "Segment_Name").limit(k)


def top_per_group(
    df: DataFrame, by: Sequence[str], column: str, above: float | None = None,
    significant: bool = True
) -> DataFrame:
    """Row with the largest value per group (ties: first by the other columns)."""
    rows = df.where(F.col("Significance") == "Significant") if significant else df
    if above is not None:
        rows = rows.where(q(column) > above)
    rest = [c for c in df.columns if c not in set(by)]
    ties = [c for c in rest if c != column]
    first = F.min(F.struct((-q(column)).alias("__order"), *[q(c) for c in ties]))
    best = rows.groupBy(*[q(c) for c in by]).agg(first.alias("__b"))
    return best.select(*[
        q(c) if c in set(by)
        else (-F.col("__b.__order")).alias(c) if c == column
        else F.col("__b").getField(c).alias(c)
        for c in df.columns])


def best_treatment(overall: DataFrame) -> DataFrame:
    """Treatment with the largest effect per KPI."""
    columns = ["KPI", "treatment_label", ATE, "Significance"]
    return top_per_group(overall.select(*columns), ["KPI"], ATE, significant=False)


def impact_counts(overall: DataFrame) -> DataFrame:
    """Per KPI: treatments without impact and with significant results, counted and listed."""
    none, sig = F.col(ATE) <= 0, F.col("Significance") == "Significant"

    def named(hit):
        return F.concat_ws(", ", F.array_sort(F.collect_set(F.when(hit, F.col("treatment_label")))))

    return overall.groupBy("KPI").agg(
        F.count_if(none).alias("no_impact"), named(none).alias("no_impact_treatments"),
        F.count_if(sig).alias("significant"), named(sig).alias("significant_treatments"))


def insights(overall: DataFrame, segments: DataFrame, k: int = 10, above: float = 1000.0):
    """Ranked statements (Category, insights) from both effect tables."""
    number = lambda c: plain_number(F.bround(c, 0))

    def said(df: DataFrame, kind: str, order, *parts):
        return df.select(F.lit(kind).alias("Category"), order.alias("order_value"),
                         F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
                         .alias("insights"))

    label, kpi = F.col("treatment_label"), F.col("KPI")
    top = top_insights(segments, k)
    per_group = top_per_group(segments, ["treatment_label", "Segment", "KPI"], ATE, above)
    counts = impact_counts(overall)
    zero = F.lit(0.0)
    parts = [
        said(top, "best_segment", F.col(ATE), label, " has its best significant effect in ",
             F.col("Segment"), " ", F.col("Segment_Name"), ": ", plain_number(F.col(ATE)), " on ",
             kpi),
        said(per_group, "largest_in_segment", F.col(ATE), "For ", label, " the effect on ", kpi,
             " is largest in ", F.col("Segment"), " ", F.col("Segment_Name"), " (",
             plain_number(F.col(ATE)), ")"),
        said(best_treatment(overall), "best_treatment", F.col(ATE), label,
             " has the best average effect on ", kpi, ": ", number(F.col(ATE)), " (",
             F.col("Significance"), ")"),
        said(counts, "no_impact", zero, F.col("no_impact").cast("string"),
             " treatments had no impact on ", kpi, ": ", F.col("no_impact_treatments")),
        said(counts, "significant", zero, F.col("significant").cast("string"),
             " treatments had a significant effect on ", kpi, ": ",
             F.col("significant_treatments")),
    ]
    return reduce(DataFrame.unionByName, parts)


def model_report(
    scored: DataFrame, treat: str, f1: float | None, r2_table: DataFrame, importances: DataFrame
) -> DataFrame:
    """Model facts in long form (section, item, value): confusion in %, accuracy, F1, R2 by
    horizon and KPI, and the three most important features."""
    table = confusion_pct(scored, treat, "predictions")
    cells = table.select(F.lit("confusion_pct").alias("section"), F.inline(F.array(*[
        F.struct(F.concat(F.lit("actual "), F.col("actual").cast("string"),
                          F.lit(f" predicted {v}")).alias("item"),
                 F.col(f"predicted_{v}").alias("value")) for v in (0, 1)])))
    acc = class_scores(scored, treat, "predictions").select(
        F.lit("accuracy").alias("section"), F.lit("all rows").alias("item"),
        F.bround("accuracy", 2).alias("value"))
    f1_row = scored.sparkSession.createDataFrame(
        [("f1", "holdout", None if f1 is None else round(f1, 2))],
        "section string, item string, value double")
    fits = r2_table.select(
        F.lit("r2").alias("section"),
        F.concat(F.col("days").cast("string"), F.lit(" days "), F.col("KPI")).alias("item"),
        F.bround("r2", 2).alias("value"))
    top = importances.orderBy(F.desc("importance"), "feature").limit(3).select(
        F.lit("top_feature").alias("section"), F.col("feature").alias("item"),
        F.col("importance").alias("value"))
    return reduce(DataFrame.unionByName, [cells, acc, f1_row, fits, top])


def r2_table(scored: DataFrame, kpis: Sequence[str]) -> DataFrame:
    """R2 per horizon, one column per KPI; KPIs without a model are left out."""
    have = [r["KPI"] for r in scored.where(F.col("r2").isNotNull()).select("KPI").distinct()
            .collect()]
    kept = [k for k in kpis if k in have]
    return scored.groupBy("days").pivot("KPI", kept).agg(F.first("r2"))


def coded_names(names: DataFrame, codes: DataFrame) -> DataFrame:
    """(treatment_id, treatment_label) with the codes of the ids, for effects by encoded ids.
    `codes` is (treatment_id, mapped_value)."""
    return lookup_join(names, codes, ["treatment_id"]).select(
        F.col("mapped_value").alias("treatment_id"), "treatment_label").dropna()


CATEGORIES = {
    "data": "Data_Quality_Insights", "classification": "Classification_Model_insights",
    "regression": "Regression_Model_insights", "importance": "Feature_importance_insights",
    "matching": "Matching_insights",
}  # fixed values: the published names of the categories


def insight_table(profile: DataFrame, model: DataFrame, importances: DataFrame, overall: DataFrame,
                  segments: DataFrame, k: int = 10, above: float = 1000.0) -> DataFrame:
    """All insights in words, (Category, insights): flagged metrics of the quality profile, how
    well treated people are told apart and KPIs predicted (from `model_report`), which inputs
    matter, and what the treatments did."""

    def said(df: DataFrame, category: str, *parts):
        return df.select(F.lit(CATEGORIES[category]).alias("Category"), F.concat(
            *[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("insights"))

    value = plain_number(F.col("value"))
    section, metric = F.col("section"), F.col("metric")
    what = (F.when(metric == "null_pct", "missing values").when(metric == "duplicate_pct", "duplicate rows")
            .otherwise("outliers"))
    return reduce(DataFrame.unionByName, [
        said(profile.where("flagged = 1"), "data", value, "% ", what, " in ", F.col("table_name"),
             F.when(F.col("column_name") == "*", "").otherwise(F.concat(F.lit(" "), F.col("column_name")))),
        said(model.where("section = 'confusion_pct'"), "classification", value, "% of all rows are ",
             F.col("item")),
        said(model.where(section.isin("accuracy", "f1")), "classification",
             F.when(section == "f1", "F1").otherwise("accuracy"), " (", F.col("item"), "): ",
             F.coalesce(value, F.lit("not known"))),
        said(model.where("section = 'r2'"), "regression", "R2 at ", F.col("item"), ": ",
             F.coalesce(value, F.lit("not known"))),
        said(importances, "importance", F.col("feature"), " has an importance of ",
             plain_number(F.col("importance"))),
        insights(overall, segments, k, above).select(
            F.lit(CATEGORIES["matching"]).alias("Category"), "insights"),
    ])
