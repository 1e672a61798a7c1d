"""Small fixtures with nulls, duplicates and misfits, and the whole study end to end."""

from __future__ import annotations

import datetime as dt
import inspect
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from liftlens.operators import clean, effects, features, matching, models, periods, quality
from liftlens.operators import shape, stats
from liftlens.operators.scale import cut_lineage
from liftlens.plans import queries, study
from liftlens.sources import customer_study as source
from liftlens.sources import tables as io

SF = "/root/testdata/sf0.001"


def test_types_are_checked_on_every_row(spark):
    df = spark.createDataFrame(
        [("1", "2023-09-01", "12.7"), ("x", "09-01-2023", "-3"), (None, "no date", "zz")],
        "id string, day string, n string")
    got = {r["column_name"]: r["mismatches"] for r in
           shape.type_mismatches(df, {"id": "int", "day": "timestamp", "n": "int"}).collect()}
    assert got == {"id": 1, "day": 1, "n": 1}
    typed = shape.enforce_types(df, {"day": "timestamp", "n": "int"}).collect()
    assert [r["n"] for r in typed] == [12, -3, None]
    assert typed[0]["day"] == typed[1]["day"] == dt.datetime(2023, 9, 1)


def test_universe_keeps_duplicates_of_treated_and_adds_controls(spark):
    treated = spark.createDataFrame(
        [("1", "T", "Label", "s", "e", "a", "b"), ("1", "T", "Label", "s", "e", "a", "b")],
        "emp_id string, treatment_id string, treatment_label_taken string, "
        "start_date_of_treatment_taken string, end_date_of_treatment_taken string, "
        "treatment_allocated_date string, treatment_allocated_end_date string")
    population = spark.createDataFrame([("1", "T"), ("2", "T"), ("2", "T"), ("3", "U")],
                                       "emp_id string, treatment_id string")
    windows = shape.treatment_windows(spark, source.CONFIG.treatments).withColumn(
        "treatment_id", F.lit("T")).limit(1)
    rows = shape.with_treated_flag(shape.treatment_universe(treated, population, windows))
    got = sorted((r["emp_id"], r[shape.GROUP], r["treatment_allocated_date"] is None)
                 for r in rows.collect())
    assert got == [("1", 1, False), ("1", 1, False), ("2", 0, False), ("3", 0, True)]


def test_label_codes_follow_sorted_order(spark):
    df = spark.createDataFrame([("b", "x"), ("B", None), ("a", "x"), ("é", "y")],
                               "s string, t string")
    got = sorted((r["Segment_Name"], r["Segments"], r["Segment"])
                 for r in shape.label_codes(df, ["s", "t"]).collect())
    assert got == [("s", "B", 0), ("s", "a", 1), ("s", "b", 2), ("s", "é", 3),
                   ("t", "x", 0), ("t", "y", 1)]
    encoded, _ = features.label_encode(df, ["t"])
    assert sorted((r["s"], r["t"]) for r in encoded.collect()) == [
        ("B", None), ("a", 0), ("b", 0), ("é", 1)]


def test_horizon_keeps_its_rows_however_few(spark):
    df = spark.range(11).select(F.lit(30).alias("date_diff"), "id")
    assert periods.at_horizon(df, 30).count() == 11
    assert periods.at_horizon(df.limit(10), 30).count() == 10


def test_daily_median_agrees_with_plain_median(spark):
    day = F.expr("timestamp_ntz'2023-01-01' + make_dt_interval(CAST(id % 60 AS INT))")
    df = spark.range(600).select(F.lit("1").alias("emp_id"), F.lit("T").alias("treatment_id"),
                                 day.alias("date"), (F.col("id") * 37 % 101).alias("v"))
    allocation = spark.createDataFrame([("1", "T", "2023-02-01", "2023-02-01")],
                                       "emp_id string, treatment_id string, a string, b string")
    allocation = allocation.select(
        "emp_id", "treatment_id", F.col("a").cast("timestamp_ntz").alias("treatment_allocated_date"),
        F.col("b").cast("timestamp_ntz").alias("treatment_allocated_end_date"))
    pre, post = periods.daily_windows(df, allocation, {"v": "median"}, (10,), (20,))
    for got, cond in ((pre, "date >= '2023-01-22' AND date < '2023-02-01'"),
                      (post, "date >= '2023-02-01' AND date <= '2023-02-21'")):
        assert got.first()["v"] == df.where(cond).agg(F.median("v")).first()[0]
    assert pre.first()["date_diff"] == 10


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1, None, 5.0, None), (1, None, 6.0, 2.0)],
                               "a int, b int, c double, d double")
    assert features.drop_constant(df).columns == ["c"]
    assert features.drop_all_null(df).columns == ["a", "c", "d"]


def test_one_hot_checks_the_number_of_levels(spark):
    df = spark.range(20).select("id", F.col("id").cast("string").alias("f"))
    with pytest.raises(ValueError):
        features.one_hot(df, ["f"], max_levels=10)
    vector = features.one_hot_vector(df, ["f"], "hot").first()["hot_f"]
    assert vector.toArray().sum() == 1


def test_one_hot_vectors_of_a_million_levels(spark):
    n = 1_000_000
    df = spark.range(n + 1).select("id", F.when(F.col("id") < n, F.format_string("%07d", F.col("id"))).alias("f"),
                                   (F.col("id") % 3).alias("g"))
    hot = cut_lineage(features.one_hot_vector(df, ["f", "g"], "hot"))
    rows = {r["id"]: (r["hot_f"], r["hot_g"]) for r in hot.where("id IN (0, 5, 999999, 1000000)").collect()}
    assert hot.count() == n + 1
    for i in (0, 5, 999_999):
        assert rows[i][0].size == n and rows[i][0].indices.tolist() == [i]
        assert rows[i][1].size == 3 and rows[i][1].indices.tolist() == [i % 3]
    assert rows[n][0].size == n and len(rows[n][0].indices) == 0


def test_least_width_of_grids_is_an_argument(spark):
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(1, 200)], "t int, x double")
    cuts = matching.cutpoints(df, {"x": ["log0.6", "log0.6:0"]})
    assert len(cuts["x", "log0.6"]) == 1 and len(cuts["x", "log0.6:0"]) > 8
    rules = [d.rules["x"] for d in matching.designs(df, ["x"], least_width=10)]
    assert "log0.6:10" in rules and "log0.5:10" in rules


def test_many_classes_are_split_alike(spark):
    df = spark.range(30_000).select("id", (F.col("id") % 300).alias("c"))
    split = stats.holdout_split(df, "id", 0.33, "c")
    assert split.columns == ["id", "c", "is_test"]
    shares = [r[0] for r in split.groupBy("c").agg(F.avg("is_test")).select("avg(is_test)").collect()]
    assert len(shares) == 300 and all(abs(x - 0.33) < 0.02 for x in shares)


def test_split_is_stable_and_keeps_keys_together(spark):
    df = spark.range(3000).select((F.col("id") % 1000).alias("k"), "id",
                                  (F.col("id") % 1000 < 100).cast("int").alias("y"))
    split = stats.holdout_split(df, "k")
    again = stats.holdout_split(df.repartition(7), "k")
    assert split.exceptAll(again).isEmpty()
    assert split.groupBy("k").agg(F.countDistinct("is_test").alias("n")).where("n > 1").isEmpty()
    shares = stats.holdout_split(df, "k", stratify="y").groupBy("y").agg(
        F.avg("is_test").alias("s")).collect()
    assert all(abs(r["s"] - 0.33) < 0.01 for r in shares)


def test_profile_skips_index_columns_and_flags(spark):
    df = spark.createDataFrame([(1, None, 1.0), (1, None, 1.0), (2, "x", 1.0), (3, "y", 99.0)],
                               "`Unnamed: 0` int, s string, v double")
    rows = {(r["column_name"], r["metric"]): (r["value"], r["flagged"])
            for r in quality.quality_profile(df, "t").collect()}
    assert rows["s", "null_pct"] == (50.0, 1) and rows["*", "duplicate_pct"] == (25.0, 1)
    assert not any(c.startswith("Unnamed") for c, _ in rows)


def test_csv_keeps_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\nbad,y\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    rows = io.read_csv(spark, str(tmp_path / "t.csv"), schema).collect()
    assert [(r["a"], r[io.CORRUPT]) for r in rows] == [(1, None), (None, "bad,y")]


def test_kpi_model_trains_on_treated_rows_only(spark):
    df = cut_lineage(spark.range(400).select(
        F.col("id").alias("emp_id"), F.lit("T").alias("treatment_id"),
        (F.col("id") % 2).cast("int").alias(shape.GROUP), (F.col("id") % 50).alias("x"),
        F.when(F.col("id") % 2 == 1, F.col("id") % 50).otherwise(-1000).alias("y")))
    fit = models.kpi_model(df, "y", ["x"], maxIter=5)
    assert fit.score > 0.9 and fit.predictions.count() == 400
    assert fit.predictions.agg(F.min("y predictions")).first()[0] > -10
    none = models.kpi_model(df.where(f"`{shape.GROUP}` = 0"), "y", ["x"])
    assert none.score is None
    assert features.drop_all_null(none.predictions).columns == [
        "emp_id", "treatment_id", shape.GROUP, "x", "is_test"]


def test_whole_study(spark, tmp_path):
    raw = [cut_lineage(f(spark, SF)) for f in (
        source.raw_population, source.raw_treatments, source.raw_segments)]
    paths = study.run(source.CONFIG, *raw, str(tmp_path))
    read = lambda n: spark.read.parquet(paths[n])
    assert read("classification_output").where("probability IS NULL").isEmpty()
    assert "Order Value predictions" in read("regression_output_720days").columns
    overall = read("overall_effects")
    assert overall.where("Average_treatment_effect < 0").isEmpty()
    assert {r[0] for r in overall.select("KPI").distinct().collect()} <= set(source.CONFIG.kpis)
    assert read("segment_effects").where("Segment = 'Overall'").isEmpty()
    chosen = read("arbitration")
    assert chosen.groupBy("KPI", "treatment_id", "Segment_Name", "Segment").count().where(
        "count > 1").isEmpty()
    assert chosen.where("fit NOT IN ('matched', 'weighted') OR Average_treatment_effect IS NULL"
                        ).isEmpty()
    assert read("effects").count() == chosen.count() > 0
    assert read("matched_rows").where("weights IS NULL").isEmpty()
    assert {r[0] for r in read("validation_report").select("check_id").distinct().collect()} >= {
        "kpis_configured", "sufficiency", "two_groups"}
    assert {r[0] for r in read("segment_codes").select("Segment_Name").distinct().collect()
            } == set(source.CONFIG.segments)
    assert read("match_info").count() == len(study.matching.designs(
        read("regression_output_720days"),
        [c for c in study.matching_covariates(source.CONFIG, read("regression_output_720days"))
         if not c.endswith("predictions")]))
    sections = {r[0] for r in read("model_report").select("section").distinct().collect()}
    assert {"confusion_pct", "accuracy", "f1", "top_feature"} <= sections
    kinds = {r[0] for r in spark.read.option("header", True).csv(paths["insights"])
             .select("Category").distinct().collect()}
    assert {"best_treatment", "no_impact", "significant"} <= kinds


def test_study_publishes_skipped_groups(spark, tmp_path):
    """A segment value of three people has no effect, but rows and a reason."""
    population, treatment, segment = (cut_lineage(f(spark, SF)) for f in (
        source.raw_population, source.raw_treatments, source.raw_segments))
    few = [r[0] for r in treatment.join(population.select("EMP_ID"), "EMP_ID").join(
        segment.select("EMP_ID"), "EMP_ID").select("EMP_ID").distinct().orderBy(
        "EMP_ID").limit(3).collect()]
    segment = segment.withColumn(
        "MARKET", F.when(F.col("EMP_ID").isin(few), "FEW").otherwise(F.col("MARKET")))
    paths = study.run(source.CONFIG, population, treatment, segment, str(tmp_path))
    keys = ["KPI", "treatment_id", "Segment_Name", "Segment"]
    skipped = spark.read.parquet(paths["skipped_effects"])
    chosen = spark.read.parquet(paths["arbitration"])
    own = skipped.where("Segment = 'FEW'")
    assert own.count() > 0 and own.where("reason IS NULL").isEmpty()
    assert skipped.where("reason IS NULL").isEmpty()
    assert skipped.join(chosen, keys).isEmpty()
    rows = spark.read.parquet(paths["regression_output_720days"])
    groups = rows.select("treatment_id", "MARKET").where("MARKET IS NOT NULL").distinct().count()
    markets = chosen.select(*keys).union(skipped.select(*keys)).where("Segment_Name = 'MARKET'")
    assert markets.count() == groups * len(source.CONFIG.kpis)


def test_kpi_queries_cover_all_kpis_and_horizons(spark, monkeypatch):
    real = models.kpi_model
    monkeypatch.setattr(models, "kpi_model", lambda *args: real(*args, maxIter=1))
    tables, s = queries._shaped(spark, SF)
    want = {(days, kpi) for days in source.CONFIG.post_days for kpi in source.CONFIG.kpis
            if not study.outcome_rows(source.CONFIG, tables, s, days).isEmpty()}
    for query in (queries.kpi_predictions, queries.feature_importance):
        rows = query(spark, SF).select("days", "KPI").distinct().collect()
        assert {(r["days"], r["KPI"]) for r in rows} == want and len(want) > 1


def test_tuned_propensity_searches_in_full(spark, monkeypatch):
    asked = {}
    real = models.tune

    def tune(*args, **more):
        asked.update(inspect.signature(real).bind(*args, **more).arguments)
        return None, None

    monkeypatch.setattr(models, "tune", tune)
    queries.tuned_propensity(spark, SF)
    assert not {"draws", "folds", "at_most"} & set(asked)


def test_insights_write_inputs_and_rows_once(spark, monkeypatch):
    """All insights come from one derived population and one table of rows, published effects too."""
    calls = []
    for module, name in ((source, "raw_population"), (study, "shaped"), (study, "outcome_rows")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, f=real, n=name, **k: calls.append(n) or f(*a, **k))
    for query in (queries.insights, queries.final_effects, queries.named_codes):
        calls.clear()
        assert query(spark, SF).count() > 0
        assert sorted(calls) == ["outcome_rows", "raw_population", "shaped"]


def test_group_with_one_fit_stays_if_asked(spark):
    schema = ("g string, Average_treatment_effect double, Standard_Error double, auc double, "
              "n_rows long")
    a = spark.createDataFrame([("x", 1.0, 0.1, 0.9, 5), ("y", 2.0, 0.1, 0.5, 5)], schema)
    b = spark.createDataFrame([("x", 3.0, 0.1, 0.6, 5), ("z", 4.0, 0.1, None, 5)], schema)
    fits = lambda how: {r["g"]: (r["fit"], r["Average_treatment_effect"])
                        for r in effects.arbitrate(a, b, ["g"], how).collect()}
    assert fits("inner") == {"x": ("matched", 1.0)}
    assert fits("full") == {"x": ("matched", 1.0), "y": ("matched", 2.0), "z": ("weighted", 4.0)}


def test_report_of_missing_treatment_and_null_rows(spark):
    df = spark.createDataFrame([(1, None, 3), (None, 2, 3), (1, 2, None), (1, 2, 3)],
                               "a int, b int, c int")
    got = {r["step"]: r["rows_lost"] for r in
           clean.null_row_report(df, {"one": ["a"], "two": ["b", "c"]}).collect()}
    assert got == {"one": 1, "two": 2}


def test_daily_study_with_search(spark, tmp_path):
    """A daily population is recognised, models come from a search, and all tables are written."""
    daily = cut_lineage(source.daily_population(spark, SF))
    raw = [cut_lineage(f(spark, SF)) for f in (source.raw_treatments, source.raw_segments)]
    cfg = replace(source.CONFIG, kpis={"Units": "sum", "Line Cents": "max"}, covariates=(),
                  population_columns={}, pre_days=(720,), post_days=(720,), tune=True)
    assert study.grain_of(cfg, daily) == "daily"
    assert study.grain_of(source.CONFIG, source.raw_population(spark, SF)) == "agg"
    paths = study.run(cfg, daily, *raw, str(tmp_path), draws=1,
                      at_most={"maxIter": 10, "maxDepth": 4, "numTrees": 10})
    read = lambda n: spark.read.parquet(paths[n])
    checks = {r["check_id"] for r in read("validation_report").collect()}
    assert "null_rows" in checks
    families = read("tuning").groupBy("model").count().collect()
    assert {r["model"] for r in families} >= {"propensity", "Units 720 days"}
    assert all(r["count"] == 3 for r in families)
    rows = read("regression_output_720days")
    assert rows.where("`Units predictions` IS NULL").isEmpty() and rows.count() > 0
    assert {r[0] for r in read("kpi_importances").select("KPI").distinct().collect()} == set(cfg.kpis)
    assert {r[0] for r in read("insight_table").select("Category").distinct().collect()} >= {
        "Classification_Model_insights", "Regression_Model_insights", "Matching_insights"}


def test_chained_predictions_equal_those_of_each_fit(spark):
    df = cut_lineage(spark.range(300).select(
        F.col("id").cast("string").alias("emp_id"), (F.col("id") % 2).cast("int").alias(shape.GROUP),
        (F.col("id") % 30).alias("x"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("s"),
        (F.col("id") % 30 + 1.0).alias("y.1"), (F.col("id") % 7 + 1.0).alias("z")))
    fits = {k: models.kpi_model(df, k, ["x", "s"], maxIter=3) for k in ("y.1", "z")}
    wide = models.with_predictions(df, ["x", "s"], {**fits, "none": models.Fit(df, None, df, None)})
    assert wide.columns == [*df.columns, "y.1 predictions", "z predictions", "none predictions"]
    got = {r["emp_id"]: r for r in wide.collect()}
    for k, fit in fits.items():
        for r in fit.predictions.collect():
            assert abs(r[f"{k} predictions"] - got[r["emp_id"]][f"{k} predictions"]) < 1e-9
    text = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text


def test_designs_repeat_combinations_of_bins_not_rows(spark, monkeypatch):
    written = []
    real = matching.cut_lineage
    monkeypatch.setattr(matching, "cut_lineage", lambda df: written.append(real(df)) or written[-1])
    df = cut_lineage(spark.range(5000).select(
        (F.col("id") % 2).cast("int").alias("t"), (F.col("id") % 3).cast("double").alias("x"),
        F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("c")))
    search = matching.designs(df, ["x", "c"])
    parts = matching.design_strata(df, "t", ["x", "c"], {d.number: d.rules for d in search})
    assert parts.agg(F.sum("__t")).first()[0] == 2500 * len(search)
    assert written[-1].count() == 6  # three values of x with two of c
