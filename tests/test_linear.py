"""Cell sums against direct fits; missing values in the balance; the treatment as an input."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from liftlens.operators import linear, matching, models
from liftlens.operators.shape import GROUP


def people(spark, n=4000):
    rng = np.random.default_rng(2)
    d = pd.DataFrame({"emp_id": np.arange(n), "x": rng.integers(0, 9, n).astype(float),
                      "f": rng.choice(["a", "b", "c"], n), "treatment_id": rng.choice(["T", "U"], n)})
    z = 0.4 * d.x - 2 + (d.f == "b") * 0.8 + (d.treatment_id == "U") * 1.5
    d[GROUP] = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    d["y"] = 2 * d.x + (d.f == "c") * 3 + (d.treatment_id == "U") * 10 + rng.normal(size=n)
    return d, spark.createDataFrame(d)


def matrix(d):
    return np.stack([np.ones(len(d)), d.x, d.f == "b", d.f == "c"], axis=1).astype(float)


def test_least_squares_equals_a_direct_fit(spark):
    d, df = people(spark)
    model = linear.fit(df, linear.design(df, ["x"], ["f"]), "y", False)
    want = np.linalg.lstsq(matrix(d), d.y, rcond=None)[0]
    assert [t.feature for t in model.terms] == ["intercept", "x", "f", "f"]
    assert np.allclose(model.coefficients, want, atol=1e-8)
    got = df.select(model.predicted().alias("p"), "emp_id").toPandas().sort_values("emp_id").p
    assert np.allclose(got, matrix(d) @ want)


def test_logistic_fit_solves_the_score_equations(spark):
    d, df = people(spark)
    model = linear.fit(df, linear.design(df, ["x"], ["f"]), GROUP, True)
    p = 1 / (1 + np.exp(-matrix(d) @ model.coefficients))
    assert np.abs(matrix(d).T @ (d[GROUP] - p)).max() < 1e-6


def test_levels_within_have_their_own_lines(spark):
    d, df = people(spark)
    model = linear.fit(df, linear.design(df, ["x"], within="treatment_id"), "y", False)
    for level, at in (("T", 0), ("U", 2)):
        own = d[d.treatment_id == level]
        slope, intercept = np.polyfit(own.x, own.y, 1)
        assert np.allclose(model.coefficients[at:at + 2], [intercept, slope])
    shares = {r["feature"]: r["importance"] for r in model.importance(df).collect()}
    assert set(shares) == {"treatment_id", "x"} and abs(sum(shares.values()) - 1) < 1e-12


def test_missing_inputs_collinear_terms_and_separated_labels(spark):
    df = spark.createDataFrame([(float(i), None if i % 4 == 0 else float(i % 4), int(i > 10)) for i in range(40)],
                               "x double, z double, y int")
    terms = [*linear.design(df, ["x", "z"]), linear.Term("x", "CAST(x AS DOUBLE) * 2D")]
    model = linear.fit(df, terms, "x", False)
    rows = df.select("x", "z", model.predicted().alias("p")).collect()
    assert all((r["p"] is None) == (r["z"] is None) for r in rows)
    assert all(abs(r["p"] - r["x"]) < 1e-6 for r in rows if r["z"] is not None)
    sharp = linear.fit(df, linear.design(df, ["x"]), "y", True)
    assert np.isfinite(sharp.coefficients).all()
    assert df.where((F.col("y") == 1) != (sharp.predicted() > 0.5)).isEmpty()
    assert linear.fit(df.limit(0), linear.design(df, ["x"]), "y", True).coefficients.tolist() == [0, 0]


def test_splits_scores_and_filters(spark):
    d, df = people(spark)
    terms = linear.design(df, ["x"], ["f"], within="treatment_id")
    scored, f1, _ = linear.cell_propensity(df, terms)
    assert f1 > 0.6 and scored.where("probability IS NULL").isEmpty()
    shifted = df.withColumn("y", F.when(F.col(GROUP) == 1, F.col("y")).otherwise(-1000.0))
    scored, score, _ = linear.cell_kpi(shifted, "y", terms)
    assert score > 0.9 and scored.agg(F.min("predictions")).first()[0] > -50


def test_designs_skip_null_covariates(spark):
    """Half the rows have no value: the difference is that of the rows with one."""
    rows = [(i % 2, float(i % 7) + 3 * (i % 2) if i % 4 < 2 else None, "m") for i in range(80)]
    df = spark.createDataFrame(rows, "t int, x double, c string")
    found = matching.candidate_balance(df, "t", ["x", "c"]).collect()
    for d in matching.designs(df, ["x", "c"]):
        matched = matching.cem_match(df, "t", ["x", "c"], d.rules)
        want = matching.balance(df, matched, "t", ["x"]).first()["smd"]
        got = next(r for r in found if r["candidate_no"] == d.number)["std_mean_diff_max_matched"]
        assert got is None and want is None or abs(got - want) < 1e-9


def test_the_treatment_is_a_model_input(spark):
    """Two treatments of different rates: scores differ only if the treatment is an input."""
    n = 1200
    df = spark.range(n).select(
        F.col("id").cast("string").alias("emp_id"), F.when(F.col("id") % 2 == 0, "T").otherwise("U").alias("treatment_id"),
        (F.col("id") % 5).cast("double").alias("x"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 10 < 8).otherwise(F.col("id") % 10 < 2).cast("int").alias(GROUP))
    inputs = models.kpi_features(df.columns, [])
    assert "treatment_id" in inputs
    with_id = models.propensity(df, inputs, algo="logistic").predictions
    without = models.propensity(df, ["x"], algo="logistic").predictions
    gap = lambda p: [abs(r[1] - r[2]) for r in p.groupBy("x").pivot("treatment_id", ["T", "U"]).avg("probability").collect()]
    assert max(gap(with_id)) > 0.4 and max(gap(without)) < 1e-9
