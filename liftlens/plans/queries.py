"""The registered queries. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.functions.columns import day_diff, period_status, q, quoted, snap_days
from liftlens.operators import clean, effects, features, linear, matching, models, periods
from liftlens.operators import quality, report, scale, shape, stats
from liftlens.operators.scale import cut_lineage, lookup_join, shared_dir
from liftlens.plans import study
from liftlens.sources import customer_study as source
from liftlens.sources import tables as io

CFG = source.CONFIG
KPIS = CFG.kpi_names
GROUP = shape.GROUP
DAILY_KPIS = {"Units": "sum", "Line Cents": "max"}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to fixed digits, so that results compare across engines."""
    return df.selectExpr(*[
        f"round({quoted(c)}, {digits}) AS {quoted(c)}" if t == "double" else quoted(c)
        for c, t in df.dtypes])


def _raw(spark, sf):
    return (source.raw_population(spark, sf), source.raw_treatments(spark, sf),
            source.raw_segments(spark, sf))


def _tables(spark, sf, written: bool = True) -> study.Tables:
    """The study's inputs. The derived population is written out once, as in a real study it
    is a stored table."""
    population, treatment, segment = _raw(spark, sf)
    return study.ingest(CFG, cut_lineage(population) if written else population, treatment,
                        segment)


def _shaped(spark, sf) -> tuple[study.Tables, study.Shaped]:
    tables = _tables(spark, sf)
    return tables, study.shaped(CFG, tables)


def _rows(spark, sf, tables: study.Tables | None = None) -> DataFrame:
    """Features and outcomes at the longest horizon, written out for the passes over it."""
    tables = tables or _tables(spark, sf)
    return cut_lineage(study.outcome_rows(CFG, tables, study.shaped(CFG, tables)))


def _design(rows: DataFrame) -> tuple[list[str], dict]:
    """All covariates of the frame, and the rule of the queries with one fixed design: halves."""
    covariates = study.matching_covariates(CFG, rows)
    return covariates, {c: "q2" for c in matching.split_covariates(rows, covariates)[0]}


# --- flagship ---------------------------------------------------------------------------


def base_frame(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer with orders before and after: treated flag, order value before
    and after 1998H1, market and region."""
    orders = source.table(spark, sf, "orders").select(
        "o_custkey", "o_orderdate", "o_orderpriority",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1998-01-01", "1998-07-01"))
    day = F.col("o_orderdate")
    per_customer = orders.groupBy(F.col("o_custkey").cast("string").alias("EMP_ID")).agg(
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT",
                     ((day >= start) & (day < end)).cast("int")).otherwise(0)).alias("w"),
        (F.sum(F.when(day < start, F.col("cents"))) / 100).alias("pre_kpi"),
        (F.sum(F.when(day >= end, F.col("cents"))) / 100).alias("post_kpi"),
    ).where(F.col("pre_kpi").isNotNull() & F.col("post_kpi").isNotNull())
    return per_customer.join(source.raw_segments(spark, sf), "EMP_ID").withColumn(
        "treatment_id", F.lit("URGENT_1998H1"))


def cem_flagship(spark, sf):
    """Exact matching on order value fifths, market and region; effects overall and by market."""
    rows = cut_lineage(base_frame(spark, sf))
    found = effects.cem_effects(rows, ["post_kpi"], "w", ["pre_kpi", "MARKET", "REGION"],
                                {"pre_kpi": "q5"}, ["MARKET"])
    return rounded(effects.as_effect_table(found, "reason"), 3)


def cem_weights(spark, sf):
    rows = cut_lineage(base_frame(spark, sf))
    matched = matching.cem_match(rows, "w", ["pre_kpi", "MARKET", "REGION"], {"pre_kpi": "q5"})
    return rounded(matched.select("EMP_ID", "w", "subclass", "weights"), 9)


def balance_smd(spark, sf):
    rows = cut_lineage(base_frame(spark, sf))
    matched = matching.cem_match(rows, "w", ["pre_kpi", "MARKET", "REGION"], {"pre_kpi": "q5"})
    return rounded(matching.balance(rows, matched, "w", ["pre_kpi"]), 4)


# --- ingest and shaping -----------------------------------------------------------------


def treatment_universe(spark, sf):
    return _tables(spark, sf, written=False).treatment


def control_flag(spark, sf):
    flagged = shape.with_treated_flag(_tables(spark, sf, written=False).treatment)
    return flagged.groupBy("treatment_id", q(GROUP).alias("flag")).agg(
        F.count("*").alias("n"), F.countDistinct("emp_id").alias("employees"))


def kpi_rename_project(spark, sf):
    raw, _, _ = _raw(spark, sf)
    renamed = shape.rename_columns(raw, {**CFG.population_columns, "No Such Column": "x"})
    return shape.project(
        renamed, shape.population_columns(KPIS, [*CFG.covariates, " "], "agg"))


def type_mismatch(spark, sf):
    """Text columns checked against types that some of their values do not fit."""
    orders = source.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("key_text"),
        F.col("o_orderpriority").alias("priority_as_date"),
        F.concat_ws("-", F.date_format("o_orderdate", "MM"), F.date_format("o_orderdate", "dd"),
                    F.date_format("o_orderdate", "yyyy")).alias("us_date"),
        F.col("o_orderstatus").alias("status_as_int"))
    return shape.type_mismatches(orders, {
        "key_text": "int", "priority_as_date": "timestamp", "us_date": "timestamp",
        "status_as_int": "int"})


def drop_nulls_report(spark, sf):
    """Rows lost, step by step, where each order's KPIs are missing when not open."""
    orders = _with_nulls(spark, sf)
    lost = clean.null_row_report(orders, {
        "KPI values": ["price", "priority"], "keys and dates": ["o_custkey", "shipped"]})
    kept = clean.drop_null_rows(orders, ["price", "priority", "o_custkey", "shipped"])
    left = kept.agg(F.lit("rows kept").alias("step"), F.count("*").alias("rows_lost"))
    return lost.unionByName(left)


def _with_nulls(spark, sf):
    return source.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("shipped"))


def treatment_filter(spark, sf):
    """Rows of the wanted treatments, and wanted treatments without any."""
    universe = _tables(spark, sf, written=False).treatment
    wanted = ["URGENT_1998H1", "HIGH_1998H1", "NEVER_OFFERED"]
    kept = clean.keep_treatments(universe, wanted).groupBy("treatment_id").agg(
        F.count("*").alias("n"))
    none = clean.treatments_without_rows(universe, wanted).withColumn(
        "n", F.lit(0).cast("bigint"))
    return kept.unionByName(none)


def dedupe_first(spark, sf):
    orders = source.table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey", "o_orderstatus")
    return clean.first_by(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


def winsorize(spark, sf):
    lines = source.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    clipped = clean.winsorize(lines, ["l_extendedprice", "l_quantity"])
    return rounded(clipped, 4)


def grain_detect(spark, sf):
    daily = periods.grain_counts(source.daily_population(spark, sf))
    agg = periods.grain_counts(shape.rename_columns(
        source.raw_population(spark, sf), CFG.population_columns))
    tag = lambda df, name: df.select(F.lit(name).alias("table_name"), "*")
    return tag(daily, "lines").unionByName(tag(agg, "windows"))


def kpi_daily_agg(spark, sf):
    kpis = {"Units": "median", "Line Cents": "sum"}
    daily = source.daily_population(spark, sf)
    return periods.aggregate_kpis(daily, ["emp_id", "treatment_id"], kpis, "date")


def daily_medians(spark, sf):
    """Two medians per group, counted and ranked together."""
    kpis = {"Units": "median", "Line Cents": "median"}
    daily = source.daily_population(spark, sf)
    return periods.aggregate_kpis(daily, ["emp_id", "treatment_id"], kpis, "date")


def window_snap(spark, sf):
    """Snapped offset and status of every order line to the start of 1998H1."""
    daily = source.daily_population(spark, sf)
    start = F.lit("1998-01-01 12:00:00").cast("timestamp_ntz")
    days = daily.select(snap_days(day_diff(start, F.col("date"))).alias("date_diff"))
    return days.select("date_diff", period_status(F.col("date_diff")).alias("status")).groupBy(
        "date_diff", "status").agg(F.count("*").alias("n"))


def pre_post_split(spark, sf):
    _, s = _shaped(spark, sf)
    columns = ["emp_id", "treatment_id", "start_date", "end_date", *KPIS, "date_diff"]
    tag = lambda df, name: df.select(F.lit(name).alias("status"), *[q(c) for c in columns])
    return rounded(tag(s.pre, "pre").unionByName(tag(s.post, "post")), 3)


def daily_windows(spark, sf):
    tables = _tables(spark, sf, written=False)
    treatment = cut_lineage(study.cleaned_treatment(CFG, tables))
    daily = cut_lineage(source.daily_population(spark, sf))
    return periods.daily_periods(daily, treatment, DAILY_KPIS, (90, 360), (30, 60, 90))


def sufficiency(spark, sf):
    tables, s = _shaped(spark, sf)
    return periods.sufficiency(s.pre, s.post, tables.windows, (90, 720), (30, 32, 720))


def label_encode(spark, sf):
    segment = shape.rename_columns(source.raw_segments(spark, sf), CFG.segment_columns)
    return shape.label_codes(segment, CFG.segments)


def segment_encode(spark, sf):
    segment = shape.rename_columns(source.raw_segments(spark, sf), CFG.segment_columns)
    encoded, _ = features.label_encode(segment, list(CFG.segments))
    return encoded.select("emp_id", *CFG.segments)


def encode_ids(spark, sf):
    tables = _tables(spark, sf)
    codes = cut_lineage(shape.label_codes(tables.treatment, ["treatment_id"]).select(
        F.col("Segments").alias("treatment_id"), F.col("Segment").alias("mapped_value")))
    return features.encode_ids(tables.population, codes).select(
        "emp_id", "treatment_id", "start_date", "end_date", *[q(k) for k in KPIS])


def feature_frame(spark, sf):
    tables, s = _shaped(spark, sf)
    return rounded(study.feature_rows(CFG, tables, s), 3)


def outcome_frame(spark, sf):
    tables, s = _shaped(spark, sf)
    return rounded(study.outcome_rows(CFG, tables, s), 3)


def drop_constant(spark, sf):
    daily = source.daily_population(spark, sf).withColumn("nothing", F.lit(None).cast("int"))
    return features.drop_constant(daily)


def drop_all_null(spark, sf):
    orders = _with_nulls(spark, sf).select(
        "o_orderkey", "price", F.lit(1).alias("A"), F.lit(2).alias("A_pre"),
        F.lit(None).cast("double").alias("A predictions"), F.col("price").alias("B predictions"))
    return features.drop_all_null(orders)


def one_hot(spark, sf):
    segment = source.raw_segments(spark, sf)
    return features.one_hot(segment, ["MARKET", "NATION", "REGION"])


def union_distinct(spark, sf):
    """Union by name of customers and suppliers, missing columns null, duplicates merged."""
    a = source.table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("market"))
    b = source.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"))
    return a.unionByName(b, allowMissingColumns=True).distinct()


# --- quality ----------------------------------------------------------------------------


def null_pct(spark, sf):
    return rounded(quality.null_pct(_tables(spark, sf, written=False).treatment), 6)


def duplicate_pct(spark, sf):
    parts = [
        ("orders", source.table(spark, sf, "orders").select(
            "o_custkey", "o_orderstatus", "o_orderpriority")),
        ("lineitem", source.table(spark, sf, "lineitem").select(
            "l_partkey", "l_quantity", "l_returnflag")),
        ("events", source.table(spark, sf, "events").select("user_id", "event_type")),
    ]
    tagged = [quality.duplicate_pct(df).select(F.lit(n).alias("table_name"), "*")
              for n, df in parts]
    return rounded(reduce(DataFrame.unionByName, tagged), 6)


def iqr_outliers(spark, sf):
    return quality.iqr_outliers(source.table(spark, sf, "lineitem"))


def quality_profile(spark, sf):
    population, treatment, segment = _raw(spark, sf)
    return _profile(cut_lineage(population), treatment, segment)


def _profile(population, treatment, segment):
    parts = [("population", population), ("treatment", treatment), ("segment", segment)]
    return rounded(reduce(DataFrame.unionByName,
                          [quality.quality_profile(df, n) for n, df in parts]), 6)


def validation_report(spark, sf):
    population, treatment, segment = _raw(spark, sf)
    tables = study.ingest(CFG, cut_lineage(population), treatment, segment)
    s = study.shaped(CFG, tables)
    raw = shape.rename_columns(treatment, CFG.treatment_columns)
    return quality.validation_report(
        CFG, raw, s.treatment, tables.population, s.pre, s.post, tables.windows, s.eligibility)


# --- matching ---------------------------------------------------------------------------


def coarsen_quantile(spark, sf):
    lines = source.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    binned = matching.coarsen(lines, {"l_extendedprice": "q5", "l_quantity": "q3"})
    return binned.groupBy("l_extendedprice_bin", "l_quantity_bin").agg(F.count("*").alias("n"))


def coarsen_width(spark, sf):
    orders = source.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    binned = matching.coarsen(orders, {"o_totalprice": "w4", "o_custkey": "sturges"})
    return binned.groupBy("o_totalprice_bin", "o_custkey_bin").agg(F.count("*").alias("n"))


def quantile_brackets(spark, sf):
    """Quantiles of three columns by sketched and proven brackets."""
    lines = source.table(spark, sf, "lineitem").select(
        "l_extendedprice", "l_partkey", (F.col("l_extendedprice") * F.col("l_quantity")).alias("volume"))
    probs = [0.01, 0.25, 0.5, 0.99]
    found = scale.exact_quantiles(lines, {c: probs for c in lines.columns}, limit=100)
    return rounded(spark.createDataFrame(
        [(c, p, float(v)) for c, vs in found.items() for p, v in zip(probs, vs)],
        "name string, p double, value double"), 4)


def log_cutpoints(spark, sf):
    prices = source.table(spark, sf, "lineitem").select("l_extendedprice", "l_discount")
    prices = prices.withColumn("reduced", F.col("l_extendedprice") * F.ceil("l_discount"))
    return rounded(matching.log_cutpoints(prices, ["l_extendedprice", "reduced"], 0.6), 3)


def match_candidates(spark, sf):
    """All designs of the search, with the number of strata that hold both arms."""
    rows = _rows(spark, sf)
    covariates, _ = _design(rows)
    search = matching.designs(rows, covariates)
    parts = matching.design_strata(rows, GROUP, covariates, {d.number: d.rules for d in search})
    both = (F.col("__t") > 0) & (F.col("__c") > 0)
    return parts.groupBy(F.col("__design").alias("candidate_no")).agg(
        F.count("*").alias("strata"), F.count_if(both).alias("usable_strata"),
        F.coalesce(F.sum(F.when(both, F.col("__t"))), F.lit(0)).alias("treated"),
        F.coalesce(F.sum(F.when(both, F.col("__c"))), F.lit(0)).alias("controls"))


def candidate_balance(spark, sf):
    rows = _rows(spark, sf)
    return rounded(matching.candidate_balance(rows, GROUP, _design(rows)[0]), 6)


def balance_nulls(spark, sf):
    """The balance of all designs where negative account balances count as unknown."""
    rows = _rows(spark, sf).withColumn("ACCTBAL", F.when(F.col("ACCTBAL") >= 0, F.col("ACCTBAL")))
    return rounded(matching.candidate_balance(cut_lineage(rows), GROUP, _design(rows)[0]), 6)


def select_match(spark, sf):
    rows = _rows(spark, sf)
    return rounded(matching.select_match(
        matching.candidate_balance(rows, GROUP, _design(rows)[0])), 6)


# --- effects ----------------------------------------------------------------------------


def effect_overall(spark, sf):
    """One effect per KPI over all treatments, from matched rows."""
    rows = _rows(spark, sf)
    matched = matching.cem_match(rows, GROUP, *_design(rows))
    return rounded(effects.overlap_effect(matched, KPIS, GROUP, "subclass"), 3)


def effect_by_treatment(spark, sf):
    rows = _rows(spark, sf)
    matched = matching.cem_match(rows, GROUP, *_design(rows), match_within="treatment_id")
    return rounded(effects.effect_by_treatment(
        matched, KPIS, GROUP, "subclass", keep_skipped=True), 3)


def effect_by_segment(spark, sf):
    rows = _rows(spark, sf)
    return rounded(effects.cem_effects(rows, KPIS, GROUP, *_design(rows), CFG.segments), 3)


def effect_ci(spark, sf):
    return rounded(_effect_table(_rows(spark, sf)), 3)


def _effect_table(rows):
    """All groups; those without an effect have a reason."""
    return effects.as_effect_table(effects.cem_effects(
        rows, KPIS, GROUP, *_design(rows), CFG.segments), "reason")


def effect_arbitrate(spark, sf):
    """Matched fit against the fit weighted by a fixed score, per treatment and segment; groups
    that neither fits are kept with the reason."""
    rows = _rows(spark, sf)
    covariates, rules = _design(rows)
    rows = rows.withColumn("weights", _score())
    a, b = map(cut_lineage, study.both_fits(CFG, rows, None, rules, covariates))
    known = F.col("reason").isNull()
    chosen = cut_lineage(effects.arbitrate(a.where(known), b.where(known), study.EFFECT_KEYS, "full"))
    skipped = study.skipped_groups(a, b, chosen).select(*study.EFFECT_KEYS, "reason")
    return rounded(chosen.unionByName(skipped, allowMissingColumns=True), 3)


def effect_forest(spark, sf):
    """Effects per treatment from honest forests, over all covariates of the frame."""
    rows = _rows(spark, sf)
    covariates, rules = _design(rows)
    return study.forest_effects(CFG, rows, rules, covariates)


TREE_CUTS = {"ACCTBAL": (0.0, 2500.0, 5000.0, 7500.0), "LIFETIME": (4.0, 8.0, 12.0, 16.0),
             "Order Count_pre": (2.0, 4.0, 6.0, 8.0)}


def causal_tree(spark, sf):
    """One honest causal tree of depth 1 per KPI, on residuals about the treatment's means."""
    rows = _rows(spark, sf)
    names = [GROUP, *KPIS]
    means = rows.groupBy("treatment_id").agg(*[F.avg(q(c)).alias(f"__m{i}") for i, c in enumerate(names)])
    rows = lookup_join(rows, means, ["treatment_id"]).select(
        "emp_id", *TREE_CUTS, *[(q(c) - F.col(f"__m{i}")).alias(f"__r{i}") for i, c in enumerate(names)])
    rows = cut_lineage(rows)
    return rounded(reduce(DataFrame.unionByName, [
        models.causal_tree(rows, "__r0", f"__r{i + 1}", TREE_CUTS, "emp_id").withColumn("KPI", F.lit(k))
        for i, k in enumerate(KPIS)]), 4)


# --- models -----------------------------------------------------------------------------


def _score():
    """A fixed score for the metric queries; it needs no fitted model."""
    return (F.col("LIFETIME") + 1) / (F.col("LIFETIME") + q("Order Count_pre") + 10)


def _scored(rows):
    return (rows.withColumn("probability", _score())
            .withColumn("predictions", (F.col("probability") > 0.45).cast("int")))


def vif(spark, sf):
    lines = source.table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount")
    return rounded(stats.vif(lines, ["l_quantity", "l_extendedprice", "l_discount"]), 6)


def vif_prune(spark, sf):
    """The columns that stay when the most inflated one leaves until all are below the limit."""
    lines = source.table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount")
    kept = stats.vif_prune(lines, lines.columns)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


def holdout_split(spark, sf):
    customers = source.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return stats.holdout_split(customers, "c_custkey")


def holdout_stratified(spark, sf):
    orders = source.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    split = stats.holdout_split(orders, "o_orderkey", stratify="o_orderstatus")
    return split.groupBy("o_orderstatus", "is_test").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


def confusion_pct(spark, sf):
    return stats.confusion_pct(_scored(_rows(spark, sf)), GROUP, "predictions")


def f1_accuracy(spark, sf):
    return rounded(stats.class_scores(
        _scored(_rows(spark, sf)), GROUP, "predictions", ["treatment_id"]), 9)


def r2_by_kpi(spark, sf):
    """R2 per horizon and KPI of a fixed prediction (half the earlier value)."""
    tables, s = _shaped(spark, sf)
    parts = []
    for days in CFG.post_days:
        rows = study.outcome_rows(CFG, tables, s, days)
        long = rows.select(F.inline(F.array(*[
            F.struct(F.lit(days).alias("days"), F.lit(k).alias("KPI"), q(k).alias("y"),
                     (q(f"{k}_pre") / 2).alias("yhat")) for k in KPIS])))
        parts.append(stats.r2(long, "y", "yhat", ["days", "KPI"]))
    table = report.r2_table(cut_lineage(reduce(DataFrame.unionByName, parts)), KPIS)
    return rounded(table, 6)


def auc_rank_sum(spark, sf):
    return rounded(stats.auc(_scored(_rows(spark, sf)), GROUP, "probability", ["treatment_id"]), 9)


def outcome_fit_corr(spark, sf):
    return rounded(stats.fit_corr(
        _scored(_rows(spark, sf)), "Order Value", "Order Value_pre", ["treatment_id"]), 4)


def _features(spark, sf):
    tables, s = _shaped(spark, sf)
    return cut_lineage(study.feature_rows(CFG, tables, s))


def _inputs(rows):
    return models.kpi_features(rows.columns, KPIS)


def propensity_scores(spark, sf):
    rows = _features(spark, sf)
    return models.propensity(rows, [*KPIS, *_inputs(rows)]).predictions


def _kpi_fits(spark, sf):
    """(days, KPI, fit) of every KPI at every horizon; without outcome rows the fit is empty. The
    KPIs of a horizon are fitted side by side: boosting is a long chain of short jobs."""
    tables, s = _shaped(spark, sf)
    with ThreadPoolExecutor(len(KPIS)) as pool:
        for days in CFG.post_days:
            rows = cut_lineage(study.outcome_rows(CFG, tables, s, days))
            inputs = _inputs(rows)
            fits = pool.map(lambda kpi: models.kpi_model(rows, kpi, inputs), KPIS)  # noqa: B023
            yield from ((days, kpi, fit) for kpi, fit in zip(KPIS, list(fits)))


def kpi_predictions(spark, sf):
    return reduce(DataFrame.unionByName, [
        fit.predictions.withColumns({"days": F.lit(days), "KPI": F.lit(kpi)}).withColumnRenamed(
            f"{kpi} predictions", "predictions")
        for days, kpi, fit in _kpi_fits(spark, sf)])


def feature_importance(spark, sf):
    return reduce(DataFrame.unionByName, [
        fit.importance.withColumns({"days": F.lit(days), "KPI": F.lit(kpi)})
        for days, kpi, fit in _kpi_fits(spark, sf)])


def _cell_rows(rows):
    """With a whole-number key, whose split any engine can repeat."""
    return rows.withColumn("emp_no", F.col("emp_id").cast("long"))


def propensity_cells(spark, sf):
    """The logistic propensity by earlier orders, with its own curve per treatment."""
    rows = _cell_rows(_features(spark, sf))
    terms = linear.design(rows, ["LIFETIME"], within="treatment_id")
    scored, f1, _ = linear.cell_propensity(rows, terms, key="emp_no")
    return rounded(scored.select("emp_id", "treatment_id", "is_test", "probability", "predictions",
                                 F.lit(f1).cast("double").alias("f1")))


def _cell_kpis(spark, sf):
    rows = cut_lineage(_cell_rows(_rows(spark, sf)))
    terms = linear.design(rows, ["LIFETIME"], within="treatment_id")
    return [(kpi, *linear.cell_kpi(rows, kpi, terms, key="emp_no")) for kpi in KPIS]


def kpi_cells(spark, sf):
    """Expected KPIs by least squares on the treated, a line per treatment."""
    return rounded(reduce(DataFrame.unionByName, [
        scored.select("emp_id", "treatment_id", "is_test", F.lit(kpi).alias("KPI"), "predictions",
                      F.lit(score).cast("double").alias("r2"))
        for kpi, scored, score, _ in _cell_kpis(spark, sf)]), 4)


def importance_cells(spark, sf):
    """How much treatment and earlier orders move the expected KPI of the training rows."""
    return rounded(reduce(DataFrame.unionByName, [
        model.importance(scored.where((q(GROUP) == 1) & (F.col("is_test") == 0) & q(kpi).isNotNull()))
        .withColumn("KPI", F.lit(kpi)) for kpi, scored, _, model in _cell_kpis(spark, sf)]))


def tuned_propensity(spark, sf):
    rows = _features(spark, sf)
    return models.tune(rows, GROUP, [*KPIS, *_inputs(rows)], "f1")[0]


# --- reports ----------------------------------------------------------------------------


def _names(tables):
    return shape.treatment_names(tables.treatment
                                 ).withColumnRenamed("treatment_label_taken", "treatment_label")


def _final(spark, sf):
    """From one set of written inputs, as all steps of a study."""
    tables = _tables(spark, sf)
    return _finalized(tables, _rows(spark, sf, tables))


def _finalized(tables, rows):
    return cut_lineage(report.finalize_effects(
        _effect_table(rows).where("reason IS NULL"), _names(tables), CFG.project))


def final_effects(spark, sf):
    final = _final(spark, sf).drop("raw_effect")
    return report.overall_effects(final).unionByName(
        report.segment_effects(final), allowMissingColumns=True)


def rank_segments(spark, sf):
    segments = report.segment_effects(_final(spark, sf))
    ranked = report.rank_avg(segments, ["treatment_label", "Segment_Name"], report.ATE)
    return ranked.select("treatment_label", "Segment", "Segment_Name", "KPI", report.ATE, "Rank")


def top_insights(spark, sf):
    segments = report.segment_effects(_final(spark, sf)).drop("raw_effect")
    return report.top_insights(segments)


def top_per_group(spark, sf):
    segments = report.segment_effects(_final(spark, sf)).drop("raw_effect")
    return report.top_per_group(
        segments, ["treatment_label", "Segment", "KPI"], report.ATE, significant=False)


def best_treatment_per_kpi(spark, sf):
    return report.best_treatment(report.overall_effects(_final(spark, sf)))


def no_impact_counts(spark, sf):
    return report.impact_counts(report.overall_effects(_final(spark, sf)))


def _coded_final(spark, sf):
    """Final effects worked out on encoded treatments and segments, and the code tables."""
    tables = _tables(spark, sf)
    rows = _rows(spark, sf, tables)
    ids = cut_lineage(shape.label_codes(rows, ["treatment_id"]).select(
        F.col("Segments").alias("treatment_id"), F.col("Segment").alias("mapped_value")))
    coded, labels = features.label_encode(features.encode_ids(rows, ids), CFG.segments)
    # codes are names, not numbers: matched exactly
    coded = cut_lineage(coded.withColumns({c: F.col(c).cast("string") for c in CFG.segments}))
    covariates, rules = _design(coded)
    table = effects.as_effect_table(
        effects.cem_effects(coded, KPIS, GROUP, covariates, rules, CFG.segments), "reason")
    names = report.coded_names(_names(tables), ids)
    return report.finalize_effects(table.where("reason IS NULL"), names, CFG.project), labels


def named_codes(spark, sf):
    """Overall effects of encoded treatments under the names of the codes."""
    final, _ = _coded_final(spark, sf)
    return report.overall_effects(final.drop("raw_effect"))


def segment_labels(spark, sf):
    """Effects by encoded segment values under the names of the codes."""
    final, labels = _coded_final(spark, sf)
    return report.segment_effects(final.drop("raw_effect"), labels)


def _model_facts(rows):
    rows = cut_lineage(_cell_rows(_scored(rows)))
    f1 = stats.class_scores(rows, GROUP, "predictions").first()["f1"]
    long = rows.select(F.inline(F.array(*[
        F.struct(F.lit(CFG.horizon).alias("days"), F.lit(k).alias("KPI"), q(k).alias("y"),
                 (q(f"{k}_pre") / 2).alias("yhat")) for k in KPIS])))
    scores = stats.r2(long, "y", "yhat", ["days", "KPI"])
    _, _, model = linear.cell_kpi(rows, KPIS[0], linear.design(rows, ["LIFETIME"], within="treatment_id"),
                                  key="emp_no")
    used = rows.where((q(GROUP) == 1) & q(KPIS[0]).isNotNull())
    importances = model.importance(used).withColumn("importance", F.bround("importance", 2))
    return report.model_report(rows, GROUP, f1, scores, importances), importances


def model_report(spark, sf):
    """Confusion, accuracy, F1, R2 and the inputs that matter, of fixed scores and cell fits."""
    return _model_facts(_rows(spark, sf))[0]


def insights(spark, sf):
    """All five categories of insights in words, from inputs and rows that are written once. Profile,
    model facts and effects do not need each other, so they are worked out side by side."""
    population, treatment, segment = _raw(spark, sf)
    population = cut_lineage(population)
    with ThreadPoolExecutor(3) as pool:
        profile = pool.submit(lambda: cut_lineage(_profile(population, treatment, segment)))
        tables = study.ingest(CFG, population, treatment, segment)
        rows = _rows(spark, sf, tables)
        facts = pool.submit(_model_facts, rows)
        final = pool.submit(_finalized, tables, rows).result().drop("raw_effect")
        model, importances = facts.result()
        return report.insight_table(profile.result(), model, importances,
                                    report.overall_effects(final), report.segment_effects(final))


def csv_roundtrip(spark, sf):
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    io.write_csv(source.raw_treatments(spark, sf), path)
    names = ["EMP_ID", "DATE_START_TREATMENT_TAKEN", "DATE_END_TREATMENT_TAKEN",
             "OFFERING_LABEL", "OFFERING_ID", "START_DATE", "END_DATE"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    back = io.read_csv(spark, path, schema).where(F.col(io.CORRUPT).isNull())
    typed = shape.enforce_types(shape.rename_columns(back, CFG.treatment_columns), {
        c: "timestamp" for c in shape.TREATMENT_COLUMNS if "date" in c})
    return typed.drop(io.CORRUPT)


def batch_outputs(spark, sf):
    """Effects published by batches of treatments; the rerun of one replaces it alone."""
    path = f"{shared_dir(spark)}/batches-{uuid.uuid4().hex}"
    rows = _rows(spark, sf)
    matched = cut_lineage(matching.cem_match(
        rows, GROUP, *_design(rows), match_within="treatment_id"))

    def found(**more):
        return effects.effect_by_treatment(matched, KPIS, GROUP, "subclass", keep_skipped=True, **more)

    first, *rest = [t.treatment_id for t in CFG.treatments]
    io.write_batch(found(clustered=False), path, "treatment_id", [first, *rest])
    io.write_batch(found(), path, "treatment_id", rest)
    io.write_batch(found(), path, "treatment_id", [first])
    return rounded(io.read_batches(spark, path, found().schema, "treatment_id"), 3)


def parquet_roundtrip(spark, sf):
    """A partitioned output and the outputs of two runs, read back as one table."""
    path = f"{shared_dir(spark)}/parquet-{uuid.uuid4().hex}"
    segment = source.raw_segments(spark, sf)
    part = F.pmod(F.xxhash64("EMP_ID"), F.lit(3))  # null has a hash too
    io.write_parquet(segment.where(part == 0), f"{path}/by_market", ["MARKET"])
    io.write_parquet(segment.where(part == 1), f"{path}/run1")
    io.write_parquet(segment.where(part == 2), f"{path}/run2")
    runs = io.read_parquet(spark, f"{path}/run1", f"{path}/run2")
    return runs.unionByName(io.read_parquet(spark, f"{path}/by_market"))


QUERIES = {
    f.__name__: f
    for f in (
        cem_flagship, cem_weights, balance_smd,
        treatment_universe, control_flag, kpi_rename_project, type_mismatch, drop_nulls_report,
        treatment_filter, dedupe_first, winsorize, grain_detect, kpi_daily_agg, daily_medians,
        window_snap, pre_post_split, daily_windows, sufficiency, label_encode, segment_encode, encode_ids,
        feature_frame, outcome_frame, drop_constant, drop_all_null, one_hot, union_distinct,
        null_pct, duplicate_pct, iqr_outliers, quality_profile, validation_report,
        coarsen_quantile, coarsen_width, quantile_brackets, log_cutpoints, match_candidates, candidate_balance,
        balance_nulls, select_match,
        effect_overall, effect_by_treatment, effect_by_segment, effect_ci, effect_arbitrate,
        effect_forest, causal_tree,
        vif, vif_prune, holdout_split, holdout_stratified, confusion_pct, f1_accuracy, r2_by_kpi,
        auc_rank_sum, outcome_fit_corr, propensity_scores, kpi_predictions, feature_importance,
        tuned_propensity, propensity_cells, kpi_cells, importance_cells,
        final_effects, rank_segments, top_insights, top_per_group, best_treatment_per_kpi,
        no_impact_counts, named_codes, segment_labels, model_report, insights, csv_roundtrip, parquet_roundtrip, batch_outputs,
    )
}
