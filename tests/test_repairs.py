"""Inputs that once gave wrong results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from liftlens.operators import matching, periods, report, scale, stats
from liftlens.sources import tables


def test_csv_keeps_quotes_commas_and_line_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n1,"say ""hi"", now"\n2,"two\nlines"\n')
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows = tables.read_csv(spark, str(path), schema, multiline=True).collect()
    assert [(r["a"], r["b"], r[tables.CORRUPT]) for r in rows] == [
        (1, 'say "hi", now', None), (2, "two\nlines", None)]
    tables.write_csv(spark.createDataFrame([(1, 'a "b", c')], schema), str(tmp_path / "y"))
    assert tables.read_csv(spark, str(tmp_path / "y"), schema).first()["b"] == 'a "b", c'


def test_balance_skips_null_covariates(spark):
    rows = [(1, 11.0, 1.0), (1, None, 1.0), (0, 4.0, 1.0), (0, None, 1.0), (0, 6.0, 1.0)]
    df = spark.createDataFrame(rows, "t int, x double, weights double")
    row = matching.balance(df, df, "t", ["x"]).first()
    assert row["mean_treated"] == 11.0 and row["mean_control"] == 5.0


def test_one_label_per_treatment_and_unknown_effects(spark):
    effects = spark.createDataFrame(
        [(1, "k", "All", "Overall", None, None, None, "No"), (2, "k", "All", "Overall", -1.0, 0.1, "[-2,0]", "No")],
        "treatment_id int, KPI string, Segment_Name string, Segment string, "
        f"{report.ATE} double, Standard_Error double, CI string, Significance string")
    names = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")],
                                  "treatment_id int, treatment_label string")
    rows = {r["treatment_label"]: r for r in report.finalize_effects(effects, names, "p").collect()}
    assert set(rows) == {"a", "c"}
    assert rows["a"][report.ATE] is None and rows["c"][report.ATE] == 0 and rows["c"]["CI"] == "[0,0]"


def test_null_class_is_split_too(spark):
    df = spark.range(600).select("id", F.when(F.col("id") % 2 == 0, F.lit("a")).alias("c"))
    split = stats.holdout_split(df, "id", 0.33, "c")
    share = {r["c"]: r["s"] for r in split.groupBy("c").agg(F.avg("is_test").alias("s")).collect()}
    assert abs(share[None] - 0.33) < 0.05 and abs(share["a"] - 0.33) < 0.05


def test_cluster_without_shared_folder_is_an_error(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError):
        scale.shared_dir(Session())


def test_batches_replace_their_own_values_and_hide_unfinished_runs(spark, tmp_path):
    path, schema = str(tmp_path / "out"), "k string, v int"
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    read = lambda: sorted(map(tuple, tables.read_batches(spark, path, frame().schema, "k").collect()))
    assert read() == []
    tables.write_batch(frame(("a", 1), ("b", 2), ("b", 3), ("c/d e", 4)), path, "k", ["a", "b", "c/d e"])
    assert read() == [("a", 1), ("b", 2), ("b", 3), ("c/d e", 4)]
    # rows of other values than the batch's are not written; the others stay
    tables.write_batch(frame(("b", 9), ("a", 100)), path, "k", ["b"])
    assert read() == [("a", 1), ("b", 9), ("c/d e", 4)]
    # a run that broke before its lines were listed
    frame(("a", -1)).write.partitionBy("k").parquet(f"{path}/run-broken")
    assert read() == [("a", 1), ("b", 9), ("c/d e", 4)]
    # a rerun without rows empties its value
    tables.write_batch(frame(), path, "k", ["a"])
    assert read() == [("b", 9), ("c/d e", 4)]
    lines = {r["value"]: (r["number"], r["rows"]) for r in tables.finished(spark, path).collect()}
    assert lines == {"a": (3, 0), "b": (2, 1), "c/d e": (1, 1)}


def test_several_medians_of_groups_with_null_keys(spark):
    rows = [(k, float(i * 7 % 13), None if k is None else float(i)) for i in range(60) for k in ("a", None)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {r["k"]: (r["x"], r["y"], r["n"]) for r in periods.aggregate_kpis(
        df.withColumn("n", F.lit(1)), ["k"], {"x": "median", "y": "median", "n": "sum"}).collect()}
    want = df.groupBy("k").agg(F.median("x"), F.median("y"), F.count("*")).collect()
    assert got == {r[0]: tuple(r[1:]) for r in want}
    assert scale.grouped_quantile(df, ["k"], "y", 0.25, "m").collect() == [("a", 14.75)]
