"""The large-data paths give the same results as plain ones, also with hot keys."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from liftlens.operators import clean, scale, stats


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows, a third of them of one key; values with many ties and a heavy tail."""
    return scale.cut_lineage(spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97))
        .alias("k"),
        F.when(F.col("id") % 5 == 0, F.lit(7.0))
        .otherwise(F.pow(F.pmod(F.col("id") * 7919, F.lit(10_007)).cast("double"), F.lit(1.5)))
        .alias("x")))


def test_quantiles_by_bracketing_are_exact(skewed):
    probs = [0.0, 0.01, 0.1, 0.2, 1 / 3, 0.5, 0.777, 0.99, 1.0]
    x = np.array([r["x"] for r in skewed.collect()])
    small = scale.exact_quantiles(skewed, {"x": probs})["x"]
    large = scale.exact_quantiles(skewed, {"x": probs}, limit=50)["x"]
    assert np.allclose(small, np.quantile(x, probs), rtol=1e-12)
    assert np.allclose(large, np.quantile(x, probs), rtol=1e-12)


def test_passes_do_not_depend_on_the_number_of_columns(spark, skewed):
    """As many jobs for eight columns with many values as for one."""
    df = scale.cut_lineage(skewed.select(*[(F.col("x") * (i + 1) + F.rand(i)).alias(f"c{i}") for i in range(8)]))
    probs = [0.01, 0.25, 0.5, 0.99]
    jobs = []
    for columns in (df.columns[:1], df.columns):
        spark.sparkContext.setJobGroup(f"quantiles{len(columns)}", "count")
        got = scale.exact_quantiles(df, {c: probs for c in columns}, limit=100)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"quantiles{len(columns)}")))
        spark.sparkContext._jsc.clearJobGroup()
        want = df.toPandas()
        assert all(np.allclose(got[c], np.quantile(want[c], probs), rtol=1e-12) for c in columns)
    assert jobs[1] <= jobs[0] + 2 and jobs[0] > 3  # a round more at most


def test_bracketing_of_ties_nulls_and_infinities(spark):
    rows = [(float(i % 3) if i % 2 else float(i),) for i in range(4000)] + [(None,), (float("inf"),), (float("-inf"),)]
    df = spark.createDataFrame(rows, "x double")
    probs = [0.0, 0.3, 0.5, 0.6, 1.0]
    small = scale.exact_quantiles(df, {"x": probs})["x"]
    assert scale.exact_quantiles(df, {"x": probs}, limit=10)["x"] == small


def test_grouped_quantile_of_a_hot_group(skewed):
    pdf = skewed.toPandas()
    for kw in ({}, {"limit": 100, "buckets": 8}):
        got = {r["k"]: r["m"] for r in
               scale.grouped_quantile(skewed, ["k"], "x", 0.5, "m", **kw).collect()}
        want = pdf.groupby("k")["x"].median().to_dict()
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_running_sum_in_buckets_equals_one_window(spark):
    rows = [(g, f"v{i * 37 % 211:03d}", i + 1) for g in "ab" for i in range(211)]
    df = spark.createDataFrame(rows, "g string, v string, n long")
    plain = scale.running_sum(df, ["g"], "v", ["n"]).collect()
    bucketed = scale.running_sum(df, ["g"], "v", ["n"], limit=10, buckets=16).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, bucketed))


def test_auc_of_many_scores_in_buckets(skewed):
    df = skewed.withColumn("y", (F.pmod(F.xxhash64("x", "k"), F.lit(3)) == 0).cast("int"))
    a = stats.auc(df, "y", "x").first()["auc"]
    b = stats.auc(df, "y", "x", limit=100, buckets=16).first()["auc"]
    assert abs(a - b) < 1e-12


def test_hot_keys_are_found_and_salted(skewed):
    hot = scale.find_hot_keys(skewed, ["k"], min_rows=1000)
    hashes, salts = hot.get(["k"])
    assert len(hashes) == 1 and salts > 1
    side = skewed.select("k").distinct().withColumn("name", F.upper("k")).where("k <> 'k5'")
    for how in ("inner", "left"):
        plain = skewed.join(side, ["k"], how)
        salted = scale.skew_join(skewed, side, ["k"], how, hot)
        assert salted.columns == plain.columns
        assert salted.groupBy("k", "x", "name").count().exceptAll(
            plain.groupBy("k", "x", "name").count()).isEmpty()
        assert salted.count() == plain.count()
    spread = scale.skew_join(skewed, side, ["k"], "inner", hot).where("k = 'hot'")
    text = spread._jdf.queryExecution().toString()
    assert "__salt" in text


def test_first_by_is_idempotent_and_ordered(skewed):
    once = clean.first_by(skewed, ["k"], ["x"])
    twice = clean.first_by(once, ["k"], ["x"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    low = skewed.groupBy("k").agg(F.min("x").alias("x"))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, low.collect()))


def test_winsorize_clips_to_both_bounds(skewed):
    x = skewed.toPandas()["x"]
    lo, hi = np.quantile(x, [0.01, 0.99])
    got = clean.winsorize(skewed, ["x"]).toPandas()["x"]
    assert np.isclose(got.min(), lo) and np.isclose(got.max(), hi)
    assert np.isclose(got.sum(), np.clip(x, lo, hi).sum())


def test_spread_gives_each_core_its_rows(spark):
    """A small file with much work per row is not left to one task; a few rows are."""
    one = scale.cut_lineage(spark.range(50_000).coalesce(1))
    cores = spark.sparkContext.defaultParallelism
    assert one.rdd.getNumPartitions() == 1
    out = scale.spread(one, 1000)
    assert out.rdd.getNumPartitions() == cores and out.distinct().count() == 50_000
    assert scale.cut_lineage(out).rdd.getNumPartitions() >= cores // 2
    assert scale.spread(one, 50_000).rdd.getNumPartitions() == 1
    assert scale.spread(one.limit(0), 1000).count() == 0
