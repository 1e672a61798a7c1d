"""The study from raw tables to effects: each step is lazy unless it says otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.config import StudyConfig
from liftlens.functions.columns import q
from liftlens.operators import clean, effects, features, matching, models, periods, quality
from liftlens.operators import report, shape, stats
from liftlens.operators.scale import HotKeys, cut_lineage, find_hot_keys
from liftlens.sources.tables import write_csv, write_parquet

GROUP = shape.GROUP


@dataclass
class Tables:
    """The three inputs, renamed and typed; `treatment` holds treated and controls."""

    population: DataFrame
    treatment: DataFrame
    segment: DataFrame
    windows: DataFrame
    grain: str = "agg"


@dataclass
class Shaped:
    """Cleaned rows before and after the treatment, and who was treated."""

    pre: DataFrame
    post: DataFrame
    eligibility: DataFrame
    treatment: DataFrame
    population: DataFrame
    hot: HotKeys

ROW = "__row"  # tells rows of one person apart
EFFECT_KEYS = ["KPI", "treatment_id", "Segment_Name", "Segment"]


def grain_of(cfg: StudyConfig, population: DataFrame) -> str:
    """Whether a raw population holds days or periods: by its date columns, and where it has
    both kinds, by the rows of a person and treatment."""
    renamed = shape.rename_columns(population, cfg.population_columns)
    if "date" not in renamed.columns:
        return "agg"
    return periods.detect_grain(renamed) if "start_date" in renamed.columns else "daily"


def ingest(
    cfg: StudyConfig, population: DataFrame, treatment: DataFrame, segment: DataFrame,
    grain: str = "agg",
) -> Tables:
    """Rename and type the raw tables, and add the controls."""
    spark = population.sparkSession
    population = shape.rename_columns(population, cfg.population_columns)
    treatment = shape.rename_columns(treatment, cfg.treatment_columns)
    segment = shape.rename_columns(segment, cfg.segment_columns)
    dates = ["date"] if grain == "daily" else ["start_date", "end_date"]
    population = shape.enforce_types(
        population, {"emp_id": "string", "treatment_id": "string",
                     **{d: "timestamp" for d in dates}})
    treatment = shape.enforce_types(
        treatment, {c: "timestamp" if "date" in c else "string" for c in shape.TREATMENT_COLUMNS})
    segment = shape.project(shape.enforce_types(segment, {"emp_id": "string"}),
                            ["emp_id", *cfg.segments])
    windows = shape.treatment_windows(spark, cfg.treatments)
    universe = shape.treatment_universe(treatment, population, windows)
    return Tables(population, universe, segment, windows, grain)


def replace_segments(cfg: StudyConfig, segments: tuple[str, ...]) -> StudyConfig:
    """The same study, reported by other segment columns."""
    return replace(cfg, segments=segments)


def cleaned_population(cfg: StudyConfig, tables: Tables) -> DataFrame:
    """Required columns, rows without nulls, whole-number KPIs."""
    wanted = shape.population_columns(cfg.kpi_names, cfg.covariates, tables.grain)
    dates = ["date"] if tables.grain == "daily" else ["start_date", "end_date"]
    rows = clean.drop_null_rows(
        shape.project(tables.population, wanted), [*cfg.kpi_names, "emp_id", *dates])
    return shape.enforce_types(rows, {k: "int" for k in cfg.kpi_names})


def cleaned_treatment(cfg: StudyConfig, tables: Tables) -> DataFrame:
    kept = clean.keep_treatments(tables.treatment, cfg.treatment_ids)
    return clean.drop_null_rows(
        kept, ["treatment_allocated_date", "treatment_allocated_end_date", "treatment_id"])


def shaped(cfg: StudyConfig, tables: Tables, exact: bool = True) -> Shaped:
    """Clean, clip outliers and split into before and after. Two small aggregates run here for
    the clip bounds, and one over the key columns for hot employees."""
    hot = find_hot_keys(tables.population, ["emp_id", "treatment_id"], ["emp_id"])
    treatment = cut_lineage(cleaned_treatment(cfg, tables))
    population = clean.winsorize(cleaned_population(cfg, tables), cfg.kpi_names, exact=exact)
    if tables.grain == "daily":
        pre, post = periods.daily_windows(
            population, treatment, cfg.kpis, cfg.pre_days, cfg.post_days, hot)
    else:
        pre, post = periods.pre_post(population, treatment, hot)
    return Shaped(pre, post, shape.eligibility(treatment), treatment, population, hot)


def feature_rows(cfg: StudyConfig, tables: Tables, s: Shaped) -> DataFrame:
    present = [c for c in cfg.covariates if c in s.pre.columns]
    return features.feature_frame(
        s.pre, s.eligibility, tables.segment, cfg.kpi_names, present, s.hot)


def outcome_rows(cfg: StudyConfig, tables: Tables, s: Shaped, days: int | None = None):
    return features.outcome_frame(
        feature_rows(cfg, tables, s), s.post, days or cfg.horizon, cfg.kpi_names, s.hot)


def matching_covariates(cfg: StudyConfig, rows: DataFrame) -> list[str]:
    return shape.covariates(rows, ["emp_id", "treatment_id", GROUP])


def best_design(rows: DataFrame, covariates: list[str]) -> tuple[matching.Design, DataFrame]:
    """The design with the highest match share, and the table of all candidates."""
    search = matching.designs(rows, covariates)
    candidates = cut_lineage(matching.candidate_balance(rows, GROUP, covariates, search))
    best = matching.select_match(candidates).first()["candidate_no"]
    return next(d for d in search if d.number == best), candidates


def matched_effects(
    cfg: StudyConfig, rows: DataFrame, covariates: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Search the designs once for all KPIs, match by the best one, and measure effects per
    treatment and segment. Returns (effects, candidate table)."""
    covariates = covariates or matching_covariates(cfg, rows)
    design, candidates = best_design(rows, covariates)
    found = effects.cem_effects(
        rows, cfg.kpi_names, GROUP, covariates, design.rules, cfg.segments)
    return effects.as_effect_table(found, "reason"), candidates


def arbitrated_effects(
    cfg: StudyConfig, rows: DataFrame, scores: DataFrame, design: Mapping,
    covariates: list[str], how: str = "inner",
) -> DataFrame:
    """Per treatment and segment: the fit on matched rows, or the propensity-weighted fit on
    all rows, whichever tells treated from control better. With `how` "full" a group that has
    only one fit stays."""
    a, b = both_fits(cfg, rows, scores, design, covariates)
    known = F.col("reason").isNull()
    return effects.arbitrate(a.where(known), b.where(known), EFFECT_KEYS, how)


def both_fits(
    cfg: StudyConfig, rows: DataFrame, scores: DataFrame | None, design: Mapping, covariates: list[str],
) -> tuple[DataFrame, DataFrame]:
    """The fit on matched rows and the propensity-weighted fit on all rows, each with the groups
    that have no effect, and why. Without `scores` the rows have their `weights` already."""
    weighted = rows if scores is None else features.attach_weights(rows, scores)
    return effects.both_effects(
        weighted, cfg.kpi_names, GROUP, covariates, design, cfg.segments, "weights")


def skipped_groups(a: DataFrame, b: DataFrame, chosen: DataFrame) -> DataFrame:
    """The groups of both fits that have no effect in `chosen`, with the rows and the reason of
    each fit; a group without matched rows has only those of the weighted fit."""
    facts = lambda df, name: df.select(
        *EFFECT_KEYS, F.col("n_rows").alias(f"n_rows_{name}"),
        F.col("reason").alias(f"reason_{name}"))
    both = facts(a, "matched").join(facts(b, "weighted"), EFFECT_KEYS, "full")
    left = both.join(chosen.select(*EFFECT_KEYS), EFFECT_KEYS, "left_anti")
    return left.withColumn(
        "reason_matched", F.coalesce("reason_matched", F.lit("no matched rows"))).withColumn(
        "reason", F.coalesce("reason_weighted", "reason_matched"))


def forest_effects(
    cfg: StudyConfig, rows: DataFrame, design: Mapping, covariates: list[str],
    kpis: list[str] | None = None, **forest,
) -> DataFrame:
    """Effects per treatment with out-of-bag forests as the nuisance part, and the mean and the
    spread of the effects that the causal forest expects for the group's rows."""
    kpis = kpis or cfg.kpi_names
    matched = cut_lineage(matching.cem_match(rows, GROUP, covariates, design))
    found = cut_lineage(models.forest_residuals(matched, kpis, GROUP, covariates, **forest))
    long = found.select(
        "treatment_id", "subclass", "weights", "dw",
        F.inline(F.array(*[F.struct(F.lit(k).alias("KPI"), q(f"dy {k}").alias("dy"),
                                    q(f"effect {k}").alias("effect")) for k in kpis])))
    by = ["treatment_id", "KPI"]
    expected = long.groupBy(*by).agg(F.avg("effect").alias("mean_expected_effect"),
                                     F.stddev_pop("effect").alias("spread_of_expected_effects"))
    return effects.residual_effect(long, by, "dy", "dw", "weights", "subclass").join(expected, by, "left")


def model_inputs(frame: DataFrame, kpis: Sequence[str]) -> list[str]:
    """The model inputs of a frame, without numeric ones that the others determine."""
    inputs = models.kpi_features(frame.columns, kpis, GROUP)
    numeric, _ = matching.split_covariates(frame, inputs)
    kept = set(stats.vif_prune(frame, numeric)) if numeric else set()
    return [c for c in inputs if c in kept or c not in numeric]


def run(
    cfg: StudyConfig, population: DataFrame, treatment: DataFrame, segment: DataFrame, out: str,
    grain: str | None = None, **search,
) -> dict[str, str]:
    """The whole study: writes every result table below `out` and returns their paths.

    The grain of the population is found from its columns unless given. Inputs with inflated
    variance leave before the fits. With `cfg.tune` the models come from a search, whose settings
    are `search`, and its results are written too."""
    tables = ingest(cfg, population, treatment, segment, grain or grain_of(cfg, population))
    s = shaped(cfg, tables)
    paths: dict[str, str] = {}

    def save(name: str, df: DataFrame, by: tuple = ()) -> None:
        paths[name] = f"{out}/{name}"
        write_parquet(df, paths[name], by)

    feature_table = cut_lineage(feature_rows(cfg, tables, s))
    inputs = model_inputs(feature_table, [])
    searches = []
    if cfg.tune:
        results, treated = models.tuned_propensity(feature_table, inputs, **search)
        searches.append(results.withColumn("model", F.lit("propensity")))
    else:
        treated = models.propensity(feature_table, inputs)
    save("classification_output", treated.predictions, ("treatment_id",))
    save("treatment_names", shape.treatment_names(s.treatment))
    save("eligibility", s.eligibility)
    save("segment_codes", shape.label_codes(tables.segment, cfg.segments))
    save("validation_report", quality.validation_report(
        cfg, shape.rename_columns(treatment, cfg.treatment_columns), s.treatment,
        tables.population, s.pre, s.post, tables.windows, s.eligibility))
    fits, skipped, importances = [], [], []
    for days in cfg.post_days:
        rows = cut_lineage(outcome_rows(cfg, tables, s, days))
        if rows.isEmpty():
            skipped.append((f"regression {days} days", "no outcome rows"))
            continue
        # people may have several rows, so predictions come back by row
        wide = rows = cut_lineage(rows.withColumn(ROW, F.monotonically_increasing_id()))
        inputs = [c for c in model_inputs(rows, cfg.kpi_names) if c != ROW]
        found = {}
        for kpi in cfg.kpi_names:
            if cfg.tune:
                results, found[kpi] = models.tuned_kpi_model(rows, kpi, inputs, **search)
                searches.append(results.withColumn("model", F.lit(f"{kpi} {days} days")))
                wide = wide.join(found[kpi].predictions.select(ROW, q(f"{kpi} predictions")), ROW)
            else:
                found[kpi] = models.kpi_model(rows, kpi, inputs)
            fits.append((days, kpi, found[kpi].score))
        if not cfg.tune:
            wide = models.with_predictions(rows, inputs, found)
        importances += [fit.importance.withColumns({"days": F.lit(days), "KPI": F.lit(kpi)})
                        for kpi, fit in found.items()]
        save(f"regression_output_{days}days", features.drop_all_null(wide.drop(ROW)),
             ("treatment_id",))
    spark = population.sparkSession
    rows = cut_lineage(outcome_rows(cfg, tables, s))
    if rows.isEmpty():
        skipped.append(("matching", "no outcome rows at the longest horizon"))
    save("skipped", spark.createDataFrame(skipped, "step string, reason string"))
    if searches:
        save("tuning", reduce(DataFrame.unionByName, searches))
    if importances:
        save("kpi_importances", reduce(DataFrame.unionByName, importances))
    if rows.isEmpty():
        return paths
    covariates = matching_covariates(cfg, rows)
    design, candidates = best_design(rows, covariates)
    save("match_info", candidates)
    save("matched_rows", matching.cem_match(rows, GROUP, covariates, design.rules))
    # one score per person and treatment, who may have several rows
    scores = treated.predictions.groupBy("emp_id", "treatment_id").agg(
        F.avg("probability").alias("probability"))
    a, b = map(cut_lineage, both_fits(cfg, rows, scores, design.rules, covariates))
    known = F.col("reason").isNull()
    chosen = cut_lineage(effects.arbitrate(a.where(known), b.where(known), EFFECT_KEYS, "full"))
    save("arbitration", chosen)
    save("skipped_effects", skipped_groups(a, b, chosen))
    found = effects.as_effect_table(chosen)
    save("effects", found)
    names = shape.treatment_names(s.treatment).withColumnRenamed(
        "treatment_label_taken", "treatment_label")
    final = cut_lineage(report.finalize_effects(found, names, cfg.project))
    overall, by_segment = report.overall_effects(final), report.segment_effects(final)
    save("overall_effects", overall)
    save("segment_effects", by_segment)
    r2_rows = spark.createDataFrame(fits, "days int, KPI string, r2 double")
    facts = cut_lineage(report.model_report(
        treated.predictions, GROUP, treated.score, r2_rows, treated.importance))
    save("model_report", facts)
    profiles = [quality.quality_profile(df, name) for name, df in (
        ("population", population), ("treatment", treatment), ("segment", segment))]
    profile = cut_lineage(reduce(DataFrame.unionByName, profiles))
    save("quality_profile", profile)
    save("insight_table", report.insight_table(
        profile, facts, treated.importance, overall, by_segment))
    paths["insights"] = f"{out}/insights"
    write_csv(report.insights(overall, by_segment), paths["insights"])
    return paths
