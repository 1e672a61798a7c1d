"""Matching, balance and effects against direct computation."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from liftlens.operators import effects, matching, models, report, stats
from liftlens.operators.scale import cut_lineage


@pytest.fixture(scope="module")
def study(spark):
    """4,000 units with a confounder x, a category c and a planted effect of 5 on y."""
    u = lambda seed: F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(100_003)) / 100_003.0
    df = spark.range(4000, numPartitions=4).select(
        F.col("id"), (u(1) * 10).alias("x"), (u(2) * 10 - 2).alias("z"),
        F.when(u(3) < 0.4, "red|a").when(u(3) < 0.7, "blue").otherwise("red\\").alias("c"),
        u(4).alias("e"), u(5).alias("n"))
    df = df.withColumn("w", (F.col("e") < 0.1 + 0.07 * F.col("x")).cast("int"))
    df = df.withColumn("y", 3 * F.col("x") + F.col("z") + 5 * F.col("w") + F.col("n"))
    return cut_lineage(df.withColumn("treatment_id", F.lit("T")))


RULES = {"x": "q5", "z": "w3"}


@pytest.fixture(scope="module")
def matched(study):
    return cut_lineage(matching.cem_match(study, "w", ["x", "z", "c"], RULES))


def strata_by_hand(pdf):
    def bins(v, cuts):
        return sum((v >= c).astype(int) for c in sorted(set(cuts)))

    lo, hi = pdf.z.min(), pdf.z.max()
    zb = bins(pdf.z, [lo + (hi - lo) * j / 3 for j in (1, 2)])
    xb = bins(pdf.x, np.quantile(pdf.x, [0.2, 0.4, 0.6, 0.8]))
    return list(zip(xb, zb, pdf.c))


def test_weights_and_strata(study, matched):
    pdf, m = study.toPandas().sort_values("id"), matched.toPandas().set_index("id")
    pdf["s"] = strata_by_hand(pdf)
    arms = pdf.groupby("s").w.agg(["sum", "count"])
    kept = arms[(arms["sum"] > 0) & (arms["sum"] < arms["count"])]
    assert set(m.index) == set(pdf[pdf.s.isin(kept.index)].id)
    assert (m[m.w == 1].weights == 1).all()
    assert np.isclose(m[m.w == 0].weights.sum(), (m.w == 0).sum())
    assert m.groupby("subclass").w.nunique().eq(2).all()
    assert m.subclass.nunique() == len(kept)


def test_candidate_table_against_rows(study, matched):
    search = [matching.Design(1, "match_result1", "q5", {"x": "q5", "z": "w3"}),
              matching.Design(2, "match_result5", "again", {"x": "q5", "z": "w3"})]
    rows = {r["candidate_no"]: r for r in matching.candidate_balance(
        study, "w", ["x", "z", "c"], search).collect()}
    m = matched.toPandas()
    w0 = m[m.w == 0].weights
    ess = (m.w == 1).sum() + w0.sum() ** 2 / (w0 ** 2).sum()
    assert rows[1]["NumMatched"] == len(m) == rows[2]["rows_matched"]
    assert np.isclose(rows[2]["NumMatched"], ess)
    sd = study.where("w = 1").toPandas()[["x", "z"]].std()
    smd = {v: (m[m.w == 1][v].mean() - np.average(m[m.w == 0][v], weights=w0)) / sd[v]
           for v in ("x", "z")}
    worst = max(smd, key=lambda v: abs(smd[v]))
    assert rows[1]["max_covariate"] == worst
    assert np.isclose(rows[1]["std_mean_diff_max_matched"], smd[worst])
    table = {r["covariate"]: r["smd"] for r in
             matching.balance(study, matched, "w", ["x", "z", "c"]).collect()}
    assert np.isclose(table["x"], smd["x"]) and np.isclose(table["z"], smd["z"])


def test_search_has_9_plus_3p_designs(study):
    assert len(matching.designs(study, ["x", "z", "c"])) == 9 + 3 * 3


def test_finer_bins_never_match_more(study):
    counts = [matching.cem_match(study, "w", ["x", "c"], {"x": f"w{k}"}).count()
              for k in (2, 4, 8)]
    assert counts[0] >= counts[1] >= counts[2]


def test_one_exchange_for_the_search(study):
    search = matching.designs(study, ["x", "z", "c"])
    plan = matching.design_strata(study, "w", ["x", "z", "c"],
                                  {d.number: d.rules for d in search})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in text


def by_hand(m: pd.DataFrame, clustered=True):
    g = m.assign(wt=m.weights)
    tot = g.groupby("subclass").apply(
        lambda s: pd.Series({"p": np.average(s.w, weights=s.wt),
                             "yb": np.average(s.y, weights=s.wt)}), include_groups=False)
    g = g.join(tot, on="subclass")
    dw, dy = g.w - g.p, g.y - g.yb
    tau = (g.wt * dw * dy).sum() / (g.wt * dw * dw).sum()
    score = g.wt * dw * (dy - tau * dw)
    if clustered:
        score = score.groupby(g.subclass).sum()
    n = len(score)
    return tau, np.sqrt((score ** 2).sum() * n / (n - 1)) / (g.wt * dw * dw).sum()


@pytest.mark.parametrize("clustered", [True, False])
def test_effect_equals_matrix_regression(matched, clustered):
    got = effects.overlap_effect(matched, ["y"], "w", "subclass", clustered=clustered).first()
    tau, se = by_hand(matched.toPandas(), clustered)
    assert np.isclose(got["Average_treatment_effect"], tau)
    assert np.isclose(got["Standard_Error"], se, rtol=1e-6)


def test_planted_effect_is_recovered(study, matched):
    got = effects.confidence_interval(
        effects.overlap_effect(matched, ["y"], "w", "subclass")).first()
    assert got["ci_low"] - 0.6 < 5 < got["ci_high"] + 0.6
    naive = study.groupBy("w").agg(F.avg("y").alias("m")).orderBy("w").collect()
    assert naive[1]["m"] - naive[0]["m"] > 8  # confounded


def test_effect_scales_with_the_outcome(matched):
    twice = matched.withColumn("y2", F.col("y") * -3)
    rows = {r["KPI"]: r for r in
            effects.overlap_effect(twice, ["y", "y2"], "w", "subclass").collect()}
    assert np.isclose(rows["y2"]["Average_treatment_effect"],
                      -3 * rows["y"]["Average_treatment_effect"])
    assert np.isclose(rows["y2"]["Standard_Error"], 3 * rows["y"]["Standard_Error"])


def test_cell_effects_equal_row_effects(study, matched):
    keys = ["Segment_Name", "Segment"]
    a = effects.effect_by_segment(matched, ["y"], "w", "subclass", ["c"]).toPandas()
    b = effects.cem_effects(study, ["y"], "w", ["x", "z", "c"], RULES, ["c"]).toPandas()
    a, b = (d.sort_values(keys).reset_index(drop=True) for d in (a, b))
    assert len(a) == 4 and (a[keys] == b[keys]).all().all()
    for c in ("n_rows", "n_clusters", "Average_treatment_effect", "Standard_Error"):
        assert np.allclose(a[c], b[c])


def test_given_residuals_reproduce_the_effect(matched):
    m = matched.toPandas()
    tau, se = by_hand(m)
    w = F.sum("weights")
    means = matched.groupBy("subclass").agg(
        (F.sum(F.col("weights") * F.col("w")) / w).alias("p"),
        (F.sum(F.col("weights") * F.col("y")) / w).alias("m"))
    df = matched.join(means, "subclass").withColumns(
        {"dw": F.col("w") - F.col("p"), "dy": F.col("y") - F.col("m")})
    got = effects.residual_effect(df, ["treatment_id"], "dy", "dw", "weights", "subclass").first()
    assert np.isclose(got["Average_treatment_effect"], tau)
    assert np.isclose(got["Standard_Error"], se, rtol=1e-6)


def test_small_and_one_armed_groups_are_reported(spark):
    rows = [("a", 1, 1.0), ("a", 0, 2.0)] + [("b", 1, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, w int, y double").withColumn("s", F.lit(1))
    got = {r["g"]: r["reason"] for r in effects.overlap_effect(
        df, ["y"], "w", "s", ["g"], weight=None, keep_skipped=True).collect()}
    assert got == {"a": "fewer than 5 rows", "b": "no overlap"}
    assert effects.overlap_effect(df, ["y"], "w", "s", ["g"], weight=None).isEmpty()


def test_segments_without_effect_stay_by_default(spark):
    rows = [("T", "a", 1, 1.0), ("T", "a", 0, 2.0)] + [("T", "b", i % 2, float(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "treatment_id string, g string, w int, y double").withColumn(
        "subclass", F.lit(1)).withColumns({"dy": F.col("y"), "dw": F.col("w") - 0.5,
                                           "weights": F.lit(1.0)})
    want = {"a": "fewer than 5 rows", "b": None, effects.OVERALL: None}
    got = effects.effect_by_segment(df, ["y"], "w", "subclass", ["g"])
    assert {r["Segment"]: r["reason"] for r in got.collect()} == want
    got = effects.cem_effects(df, ["y"], "w", ["g"], {}, ["g"])
    assert {r["Segment"]: r["reason"] for r in got.collect()} == want
    got = effects.residual_effect(df, ["g"], "dy", "dw", "weights", "subclass")
    assert {r["g"]: r["reason"] for r in got.collect()} == {"a": want["a"], "b": None}


def test_forest_residuals_cover_each_row_once_and_recover_the_effect(matched):
    r = models.cross_fit_residuals(matched, ["y"], "w", ["x", "z", "c"], numTrees=10)
    assert r.count() == matched.count() == r.select("id").distinct().count()
    got = effects.residual_effect(
        r.withColumn("dy1", F.col("dy y")), ["treatment_id"], "dy1", "dw", "weights",
        "subclass").first()
    assert 3 < got["Average_treatment_effect"] < 7


def test_arbitration_prefers_the_higher_auc_and_b_on_ties(spark):
    schema = "k string, Average_treatment_effect double, Standard_Error double, auc double, n_rows long"
    a = spark.createDataFrame([("x", 1.0, 0.1, 0.7, 9), ("y", 1.0, 0.1, 0.6, 9)], schema)
    b = spark.createDataFrame([("x", 2.0, 0.1, 0.6, 9), ("y", 2.0, 0.1, 0.6, 9)], schema)
    got = {r["k"]: r["fit"] for r in effects.arbitrate(a, b, ["k"]).collect()}
    assert got == {"x": "matched", "y": "weighted"}


@pytest.mark.parametrize("values", [[0.0, 5.0, 5000.0, 90_000.0], [3.0, 800.0, 20_000.0]])
def test_log_grid(spark, values):
    x = np.array(values)
    step = np.log(1.6)
    shift = 1 - x.min() if (x == 0).any() else 0.0
    raw = np.log(x + shift)
    grid = np.exp(np.arange(raw.min(), raw.max() + step + 1e-10, step)) - shift
    want = [g for i, g in enumerate(grid) if i == 0 or g >= 1000]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["cut"] for r in matching.log_cutpoints(df, ["x"], 0.6).orderBy("cut_no").collect()]
    assert np.allclose(got, want)
    assert np.allclose(matching.cutpoints(df, {"x": ["log0.6"]})["x", "log0.6"], want)


def test_vif_and_pruning(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=400), rng.normal(size=400)
    x = np.column_stack([a, b, a + 0.1 * rng.normal(size=400), b + a])
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")))
    got = [r["vif"] for r in stats.vif(df, list("abcd")).collect()]
    for i in range(4):
        rest = np.delete(x, i, 1)
        fit = rest @ np.linalg.lstsq(rest, x[:, i], rcond=None)[0]
        r2 = 1 - ((x[:, i] - fit) ** 2).sum() / (x[:, i] ** 2).sum()
        assert np.isclose(got[i], 1 / (1 - r2), rtol=1e-6)
    keep = stats.vif_prune(df, list("abcd"))
    assert len(keep) == 2


def test_rank_of_ties_is_their_mean(spark):
    df = spark.createDataFrame([("g", v) for v in (5.0, 7.0, 7.0, 1.0)], "g string, v double")
    got = sorted((r["v"], r["Rank"]) for r in report.rank_avg(df, ["g"], "v").collect())
    assert got == [(1.0, 4.0), (5.0, 3.0), (7.0, 1.5), (7.0, 1.5)]
